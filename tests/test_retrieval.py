import math
import re

import numpy as np
from pyspark.sql import functions as F

from lexrev.operators import retrieval as R


def test_chunks_reassemble(docs):
    texts = ["a" * 10, "b" * 1000, "".join(chr(65 + i % 26) for i in range(2500)), ""]
    c = R.chunk_text(docs(*texts)).orderBy("doc_id", "chunk_no").collect()
    by = {}
    for r in c:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        if not t:
            assert i not in by
            continue
        rebuilt = ""
        for r in by[i]:
            assert r.start == r.chunk_no * 800 and len(r.text) <= 1000
            rebuilt = rebuilt[: r.start] + r.text
        assert rebuilt == t
    assert [r.start for r in by[2]] == [0, 800, 1600]


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(60, 8)).astype("float32")
    qs = rng.normal(size=(3, 8))
    vdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>")
    qdf = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(qs)], "query_id long, query_vec array<double>")
    got = {(r.query_id, r.rank): r.vec_id for r in R.knn(qdf, vdf, k=3).collect()}
    for qi, q in enumerate(qs):
        d = ((vecs.astype("float64") - q) ** 2).sum(axis=1)
        order = sorted(range(len(d)), key=lambda j: (d[j], j))[:3]
        assert [got[(qi, k + 1)] for k in range(3)] == order


def test_related_passages_brute_force(spark, docs):
    passages = ["the board of directors meets", "capital and shares of the company", "weather report for today"]
    texts = ["the directors of the board", "shares capital capital", "nothing matches here"]
    p = spark.createDataFrame(list(enumerate(passages)), "chunk_id long, text string")
    got = {(r.doc_id, r.rank): (r.chunk_id, r.score) for r in R.related_passages(docs(*texts), p, k=2).collect()}
    tok = lambda s: re.findall(r"[^\W_]+|\d+", s.lower())
    ptf = [{t: tok(s).count(t) for t in set(tok(s))} for s in passages]
    df = {}
    for tf in ptf:
        for t in tf:
            df[t] = df.get(t, 0) + 1
    idf = {t: 1 + math.log((1 + len(passages)) / (1 + n)) for t, n in df.items()}
    for di, s in enumerate(texts):
        dtf = {t: tok(s).count(t) for t in set(tok(s)) if t in idf}
        dv = {t: c * idf[t] for t, c in dtf.items()}
        scores = []
        for pi, tf in enumerate(ptf):
            pv = {t: c * idf[t] for t, c in tf.items()}
            dot = sum(dv[t] * pv.get(t, 0.0) for t in dv)
            if dot:
                scores.append((-round(dot / (math.sqrt(sum(v * v for v in dv.values())) *
                                             math.sqrt(sum(v * v for v in pv.values()))), 6), pi))
        for k, (neg, pi) in enumerate(sorted(scores)[:2]):
            assert got[(di, k + 1)][0] == pi and abs(got[(di, k + 1)][1] + neg) < 1e-6


def test_label_centroids(spark):
    v = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [3.0, 4.0], 1), (2, [5.0, 5.0], 2)],
                              "vec_id long, embedding array<float>, label int")
    c = {r.query_id: r.query_vec for r in R.label_centroids(v).collect()}
    assert c == {1: [2.0, 3.0], 2: [5.0, 5.0]}


def test_chunks_equal_slices_of_the_text(spark):
    texts = ["", None, "a", "\U0001F600b" * 120, "line\r\nnext\u2028" * 30, "x" * 100, "y" * 101]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size, overlap in ((100, 20), (7, 3), (50, 0)):
        got = {(r.doc_id, r.chunk_no): (r.start, r.text) for r in R.chunk_text(df, size, overlap).collect()}
        want = {(d, i): (s, t[s:s + size]) for d, t in enumerate(texts) if t
                for i, s in enumerate(range(0, max(len(t) - overlap, 1), size - overlap))}
        assert got == want


def test_knn_in_blocks_with_ties_and_gaps(spark):
    vecs = [(5, [0.0, 0.0]), (3, [0.0, 0.0]), (4, [1.0, 0.0]), (6, None), (7, [1.0])]
    vdf = spark.createDataFrame(vecs, "vec_id long, embedding array<float>")
    qdf = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "query_id long, query_vec array<double>")
    rows = [R.knn(qdf, vdf, k=2, block=n).orderBy("query_id", "rank").collect() for n in (2, 100)]
    assert rows[0] == rows[1] and len(rows[0]) == 10
    assert [(r.query_id, r.vec_id, r.distance) for r in rows[0][:4]] == [(0, 3, 0.0), (0, 5, 0.0), (1, 4, 0.0), (1, 3, 1.0)]
    assert R.knn(qdf.limit(0), vdf, k=2).count() == R.knn(qdf, vdf.limit(0), k=2).count() == 0


def test_related_passages_in_blocks(spark, docs):
    passages = spark.createDataFrame(
        [(i, f"common word{i % 4} " + "x " * (i % 3)) for i in range(9)] + [(9, None), (None, "common")], "chunk_id long, text string")
    d = docs("common word1 x", "word2 word2 common", None, "", "nothing here")
    one, many = (R.related_passages(d, passages, k=3, max_postings=n).orderBy("doc_id", "rank").collect() for n in (1000, 4))
    assert one == many and {r.doc_id for r in one} == {0, 1}
    assert R.related_passages(d, passages.limit(0), k=3).count() == R.related_passages(d.limit(0), passages, k=3).count() == 0
