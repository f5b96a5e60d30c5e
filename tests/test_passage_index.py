import math
import random

import numpy as np
import pytest

from lexrev.operators import passage_index as PI
from lexrev.operators import retrieval as R
from lexrev.plans import review as RV


def corpus(spark, n_docs=40, n_passages=120, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    weights = [1 / (1 + i) for i in range(80)]
    passages = [(f"p{i:03}", " ".join(rnd.choices(words, weights, k=rnd.randint(1, 60)))) for i in range(n_passages)]
    passages += [("q1", passages[3][1]), ("q0", passages[3][1]), ("e", ""), ("n", None), (None, "w1")]
    docs = [(i, " ".join(rnd.choices(words + ["zz"], [*weights, 0.1], k=rnd.randint(0, 200)))) for i in range(n_docs)] + [(900, None), (901, "zz zz")]
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(passages, "chunk_id string, text string"), docs, passages)


def brute(docs, passages, k):
    lib = {i: (t or "").split() for i, t in passages if i is not None}
    df = {}
    for ws in lib.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    idf = {w: 1 + math.log((1 + len(lib)) / (1 + n)) for w, n in df.items()}
    vec = {i: {w: ws.count(w) * idf[w] for w in set(ws)} for i, ws in lib.items()}
    out = []
    for d, t in docs:
        ws = (t or "").split()
        own = {w: ws.count(w) * idf[w] for w in set(ws) if w in idf}
        norm = math.sqrt(sum(x * x for x in own.values()))
        scored = []
        for i, v in vec.items():
            dot = sum(x * v.get(w, 0) for w, x in own.items())
            if dot:
                scored.append((-math.floor(dot / (norm * math.sqrt(sum(x * x for x in v.values()))) * 1e6 + 0.5) / 1e6, i))
        out += [(d, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("plain,postings,terms", [(PI.PLAIN, 10**6, 10**6), (0, 10**6, 10**6), (0, 400, 15), (PI.PLAIN, 300, 30)])
def test_rows_are_those_of_scoring_everything(spark, tmp_path, monkeypatch, plain, postings, terms):
    docs, passages, d, p = corpus(spark)
    monkeypatch.setattr(PI, "PLAIN", plain)
    index = PI.build_index(passages, str(tmp_path / "i"), max_postings=postings, max_terms=terms)
    assert (index.blocks > 1) == (postings < 1000)
    got = sorted(tuple(r) for r in PI.related(docs, PI.open_index(spark, str(tmp_path / "i")), 3).select("doc_id", "rank", "chunk_id", "score").collect())
    want = brute(d, p, 3)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(got, want, strict=True))


def block(rnd, n_passages, n_terms, per):
    import pyarrow as pa

    rows = []
    for p in range(n_passages):
        for t in rnd.sample(range(n_terms), per):
            rows.append((p, f"t{t}", 1 + t / n_terms, rnd.expovariate(1) ** 3 + 0.01))
    norm = {}
    for p, _, _, w in rows:
        norm[p] = norm.get(p, 0) + w * w
    cols = list(zip(*rows, strict=True))
    return PI._block(pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3]),
                               pa.array([math.sqrt(norm[p]) for p in cols[0]])], names=["k", "t", "i", "w", "n"]))


def test_bounds_skip_postings_and_lose_nothing(monkeypatch):
    rnd = random.Random(4)
    b = block(rnd, 5000, 60, 12)
    skipped = 0
    for _ in range(20):
        codes = np.array(rnd.choices(range(60), k=rnd.randint(5, 40)))
        monkeypatch.setattr(PI, "PLAIN", 0)
        hit, score, touched, total = b.best(codes, 5, None)
        monkeypatch.setattr(PI, "PLAIN", 10**9)
        plain_hit, plain_score, _, _ = b.best(codes, 5, None)
        assert (hit == plain_hit).all() and np.allclose(score, plain_score, atol=2e-6)
        skipped += touched < total
    assert skipped >= 10


def test_touched_postings_are_reported(spark, tmp_path):
    docs, passages, *_ = corpus(spark)
    rows = PI.related(docs, PI.build_index(passages, str(tmp_path / "i")), 2, touched=True).collect()
    assert rows and all(0 < r.touched <= r.postings + 10**4 for r in rows)


def test_references_and_versions(spark, tmp_path):
    docs, passages, d, p = corpus(spark)
    path = str(tmp_path / "i")
    index = PI.build_index(passages, path)
    refs = {r.doc_id: r.related_references for r in PI.references(docs, index).collect()}
    want = {}
    for doc, _, i, _ in brute(d, p, 3):
        want.setdefault(doc, []).append((i, dict(p)[i]))
    assert {k: [(r.passage, r.content) for r in v] for k, v in refs.items()} == want and all(r.relevance == "high" for v in refs.values() for r in v)
    spark.createDataFrame([(99, "chunk_id", 1, 1, 1, 1)], PI._META).write.mode("overwrite").json(f"{path}/meta")
    with pytest.raises(ValueError, match="version"):
        PI.open_index(spark, path)


def test_empty_library(spark, tmp_path):
    docs, passages, *_ = corpus(spark)
    index = PI.build_index(passages.limit(0), str(tmp_path / "i"))
    assert PI.related(docs, index).count() == 0 and PI.references(docs, index).count() == 0


# --------------------------------------------------------------- splitting at separators
def pieces(text, sep):
    if not sep:
        return list(text)
    head, *rest = text.split(sep)
    return [x for x in [head, *(sep + r for r in rest)] if x]


def merge(parts, size, overlap):
    out, now = [], []
    for p in parts:
        if now and sum(map(len, now)) + len(p) > size:
            out.append("".join(now))
            while now and (sum(map(len, now)) > overlap or sum(map(len, now)) + len(p) > size):
                now.pop(0)
        now.append(p)
    return out + (["".join(now)] if now else [])


def split(text, size, overlap, seps):
    at = next((i for i, s in enumerate(seps) if not s or s in text), len(seps) - 1)
    out, small = [], []
    for p in pieces(text, seps[at]):
        if len(p) < size:
            small.append(p)
            continue
        out += merge(small, size, overlap)
        small = []
        out += split(p, size, overlap, seps[at + 1:]) if seps[at + 1:] else [p]
    return out + merge(small, size, overlap)


def test_split_text_against_brute_force(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("ab \n\n é") for _ in range(rnd.randint(0, 90))) for _ in range(150)] + ["", None, " \n ", "x" * 50, "\n\n\n", "a" * 9 + " b"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    for size, overlap in ((10, 3), (7, 0), (30, 30), (1, 0)):
        got = {}
        for r in R.split_text(df, size, overlap).orderBy("doc_id", "chunk_no").collect():
            got.setdefault(r.doc_id, []).append(r.text)
            assert texts[r.doc_id][r.start:r.start + len(r.text)] == r.text and r.chunk_no == len(got[r.doc_id]) - 1
        want = {i: [c.strip() for c in split(t, size, overlap, R.SEPARATORS) if c.strip()] for i, t in enumerate(texts) if t}
        assert got == {i: c for i, c in want.items() if c}


def test_split_text_is_linear():
    import time

    text = ("word " * 7 + "\n") * 40_000
    began = time.time()
    spans = list(R.split_spans(text))
    assert time.time() - began < 10 and all(hi - lo <= 1000 for lo, hi in spans) and spans[0][0] == 0 and spans[-1][1] == len(text)


def test_references_are_not_broadcast(spark, tmp_path):
    """The written references are far smaller than their rows (contents repeat), so their file size says nothing."""
    passages = spark.createDataFrame([("a", "board of directors " * 50), ("b", "share capital " * 50)], "chunk_id string, text string")
    index = PI.build_index(passages, str(tmp_path / "index"))
    docs = spark.createDataFrame([(i, "the board of directors and the capital") for i in range(20)] + [(None, "board"), (3, "capital"), (99, "x")],
                                 "doc_id long, text string")
    out = RV.with_references(docs, index)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert len(rows) == 23
    assert {r.doc_id for r in rows if r.related_references is None} == {None, 99}
    assert [x.passage for x in next(r for r in rows if r.doc_id == 5).related_references] == ["a", "b"]
