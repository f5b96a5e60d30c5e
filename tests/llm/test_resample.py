import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexrev.llm import resample as resample_module
from lexrev.llm.common import WordCache
from lexrev.llm.resample import buckets, draw, gumbel, keep_drawn, kth_largest, label_sample, ratios, regression, resample


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    good = [f"word{i}" for i in range(300)]
    bad = [f"curse{i}" for i in range(8)]
    rows = []
    for i in range(n):
        kind = rng.choice(["good"] * 6 + ["toxic", "junk"])
        w = [rng.choice(good) for _ in range(rng.randint(30, 200))]
        if kind == "toxic":
            for _ in range(5):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        if kind == "junk":
            w = [x + rng.choice(["***", "%%%"]) for x in w]
        rows.append((i, " ".join(w), kind))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, _, k in rows if i % 5 < 3], "doc_id long, quality int, toxic int")
    got = {r.doc_id for r in resample(docs, labels).collect()}
    unseen = [(i, k) for i, _, k in rows if i % 5 >= 3]
    assert np.mean([i in got for i, k in unseen if k == "good"]) > 0.95
    assert np.mean([i not in got for i, k in unseen if k != "good"]) > 0.9
    kept = keep_drawn(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == got


def test_counts_cover_the_corpus(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "a"), (3, None), (4, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1, 0), (1, 0, 0), (1, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    s = label_sample(labels)
    assert s.target | {i for i, g in s.held_out.items() if g} == {2}
    r = ratios(docs, type(s)({2}, {}))
    size = r.shape[1]
    assert np.isclose(r[0].max(), np.log((2 / (1 + size)) / (4 / (4 + size))) if 2 / (1 + size) > 4 / (4 + size) else np.log((1 / (1 + size)) / (1 / (4 + size))), atol=1e-4)
    assert np.isclose(r[0].min(), min(np.log((2 / (1 + size)) / (4 / (4 + size))), np.log((1 / (1 + size)) / (2 / (4 + size)))), atol=1e-4)


@pytest.mark.parametrize("k", [0, 1, 2, 57, 199, 200, 300])
def test_kth_largest(spark, k):
    rng = np.random.default_rng(k)
    v = np.round(rng.normal(size=200), 1 if k == 57 else 9).tolist()
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v double")
    got = kth_largest(df, "v", k, bins=5)
    assert got == (float("inf") if k == 0 else sorted(v, reverse=True)[min(k, 200) - 1])


def test_gumbel_and_edges(spark):
    g = spark.range(20000).select(F.col("id").alias("k_id"), F.lit(0).alias("k_hash")).select(gumbel(1).alias("g")).toPandas()["g"]
    assert abs(g.mean() - 0.5772) < 0.04 and abs(g.std() - 1.2825) < 0.04
    none = spark.createDataFrame([], "doc_id long, text string")
    nolabels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert resample(none, nolabels).count() == 0
    df = spark.createDataFrame([(None, "x y"), (1, None), (2, ""), (3, "x y z"), (3, "x y z"), (4, "w " * 100_000)], "doc_id long, text string")
    d = draw(df, nolabels, k=10)
    assert sorted(str(r.doc_id) for r in resample(df, nolabels, k=10).collect()) == ["3", "3", "4", "None"] and d.weights is None


def test_weights_and_draw_against_plain_python(spark):
    """Both models, the ratios, every document's weight and noise, and the drawn set, recomputed with dictionaries."""
    rows = corpus(240, seed=4) + [(1000, None, "good"), (1001, "", "good"), (1002, "word1", "good")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, _, k in rows if i % 5 < 3], "doc_id long, quality int, toxic int")
    d = draw(docs, labels, k=60)
    sample = label_sample(labels)
    counts = [[{}, {}], [{}, {}]]
    known = WordCache(1 << 20)
    grams = {i: buckets(t or "", known) for i, t, _ in rows}
    for i, (words, pairs) in grams.items():
        for order, own in enumerate((words, pairs)):
            for g in own.tolist():
                for model in (0, 1) if i in sample.target else (0,):
                    counts[model][order][g] = counts[model][order].get(g, 0) + 1

    def ratio(order, g):
        return np.float32(np.log((counts[1][order].get(g, 0) + 1) / (sum(counts[1][order].values()) + resample_module._SIZE))
                          - np.log((counts[0][order].get(g, 0) + 1) / (sum(counts[0][order].values()) + resample_module._SIZE)))

    feats = {}
    for i, (words, pairs) in grams.items():
        if len(words):
            u, b = [float(ratio(0, g)) for g in words], [float(ratio(1, g)) for g in pairs]
            low = sum(sorted(float(ratio(0, g)) for g in set(words.tolist()))[:resample_module.LOWEST])
            log_n = np.log1p(len(u))
            feats[i] = (np.mean(u), np.mean(b) if b else 0.0, low, sum(sorted(u)[:3]), log_n, low / (1 + log_n))
    held = [i for i in sample.held_out if i in feats]
    w = regression(np.array([feats[i] for i in held]), np.array([sample.held_out[i] for i in held], float))
    weight = {i: float(np.clip(w[0] + np.dot(w[1:], f), -30, 30)) for i, f in feats.items()}
    got = {r["k_id"]: (r["log_weight"], r["score"] - r["log_weight"]) for r in d.table.where("score IS NOT NULL").collect()}
    assert set(got) == set(weight) and all(abs(got[i][0] - weight[i]) < 0.05 for i in got)
    drawn = {r.doc_id for r in resample(docs, labels, k=60).collect()}
    order = sorted(got, key=lambda i: -(weight[i] + got[i][1]))
    assert len(drawn) == 60 and len(drawn & set(order[:60])) >= 58  # the models' ratios are kept as 32-bit floats
