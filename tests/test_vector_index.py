import numpy as np
import pytest

from lexrev.operators import retrieval as R
from lexrev.operators import vector_index as VI


def table(spark, vecs, extra=()):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def queries(df, step=20):
    return df.where(f"vec_id % {step} = 0").selectExpr("vec_id AS query_id", "embedding AS query_vec")


@pytest.fixture
def clustered(spark):
    rng = np.random.default_rng(3)
    vecs = np.concatenate([rng.normal(size=(60, 16)) * 0.4 + rng.normal(size=16) * 2 for _ in range(12)] + [np.ones((300, 16))])
    return table(spark, vecs.astype("float32"), [(9000, None), (9001, [1.0]), (9020, None)])


def test_all_cells_probed_give_the_exact_rows_whatever_the_split(spark, clustered, tmp_path, monkeypatch):
    exact = sorted(map(tuple, R.knn(queries(clustered), clustered, k=5).drop("relevance").collect()))
    for rows in (VI.PART_ROWS, 16):  # the cell of 300 equal vectors falls into many parts, its queries into many slots
        monkeypatch.setattr(VI, "PART_ROWS", rows)
        monkeypatch.setattr(VI, "SLOT_ROWS", rows)
        index = VI.build_index(clustered, str(tmp_path / str(rows)), cells=9)
        assert index.table.count() == 1020 and (max(index.parts) > 10) == (rows == 16)
        got = VI.search(queries(clustered), index, k=5, probes=9)
        assert sorted(map(tuple, got.collect())) == exact


def test_recall_on_the_given_vectors(spark, tmp_path):
    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = VI.build_index(emb, str(tmp_path / "i"))
    exact = R.knn(queries(emb), emb, k=10)
    r = VI.recall(VI.search(queries(emb), index, k=10), exact)
    print("recall", r, "probes", index.probes, "of", len(index.centres))
    assert r >= 0.9


def test_clustered_vectors_need_few_cells(spark, clustered, tmp_path):
    index = VI.build_index(clustered, str(tmp_path / "i"), cells=13)
    assert index.probes <= 4
    exact = R.knn(queries(clustered), clustered, k=5)
    assert VI.recall(VI.search(queries(clustered), index, k=5), exact) >= 0.9


def test_empty_table(spark, clustered, tmp_path):
    index = VI.build_index(clustered.limit(0), str(tmp_path / "i"))
    assert VI.search(queries(clustered), index).count() == 0
    index = VI.build_index(clustered, str(tmp_path / "j"), cells=4)
    assert VI.search(queries(clustered).limit(0), index).count() == 0
