import __spark_entry__ as E
from lexrev.plans.catalog import QUERIES
from lexrev.plans.oracle import ORACLE_SQL


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["source", "severity", "issues"]
    assert len(rows) == 3 * df.select("source").distinct().count()
    assert sum(r.issues for r in rows) > 0


def test_registry_names():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) - set(ORACLE_SQL) == {"text_model", "file_metadata", "knn_index", "split_chunks"}
