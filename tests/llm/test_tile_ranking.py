import math
import random
import re
from collections import Counter

import numpy as np

from lexrev.llm import tile_ranking as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in own:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, -(2**63) if i is None else i))
        out += [(item, r, None if i == -(2**63) else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def corpus(n=300, seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "ÄPFEL", "日本", "x", "X1"]
    docs = [(i, " ".join(rnd.choices(words, [1 / (1 + j) for j in range(len(words))], k=rnd.randint(1, 40)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "...\x7f`"), (None, "w1 w2 w50"), (None, "w1 w2 w50"), (7, docs[7][1]), (n + 3, "w1 " * 50_000),
             *((n + 10 + i, "tie tie other") for i in range(30))]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 15)))) for i in range(40)] + [
        (100, None), (101, "!?"), (102, "unknownword"), (103, "tie"), (103, "tie"), (103, "w3 w4"), (None, "w5")]
    rnd.shuffle(docs)
    return docs, items


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, rank int").repartition(5)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    return sorted(map(str, (tuple(r) for r in R.rank(d, q, **kw).select("item_id", "rank", "doc_id", "score").collect())))


def test_against_brute_force(spark, monkeypatch):
    docs, items = corpus()
    assert got(spark, docs, items) == sorted(map(str, brute(docs, items, 10)))
    # In blocks of few queries.
    assert got(spark, docs, items, block_bytes=200) == sorted(map(str, brute(docs, items, 10)))
    assert got(spark, docs, items, k=1) == sorted(map(str, brute(docs, items, 1)))


def test_tiles_of_any_size_agree():
    rnd = np.random.default_rng(1)
    n_terms, n_queries, n_docs = 50, 30, 40
    lists = [np.sort(rnd.choice(n_terms, rnd.integers(1, 20), replace=False)) for _ in range(n_queries)]
    q = R.Queries(list(range(n_queries)), np.cumsum([0, *map(len, lists)]), np.concatenate(lists),
                  rnd.integers(0, 20_000, n_terms), 1000, 90_000)
    n = rnd.integers(1, 500, n_docs)
    row = np.repeat(np.arange(n_docs), 10)
    codes = np.concatenate([np.sort(rnd.choice(n_terms, 10, replace=False)) for _ in range(n_docs)])
    tf = rnd.integers(1, 9, len(row))
    value = R.impacts(tf, n[row], q)
    plain = np.zeros((n_docs, n_queries), np.int64)
    for i, own in enumerate(lists):
        inside = np.isin(codes, own)
        np.add.at(plain[:, i], row[inside], q.weights[codes[inside]] * value[inside])
    whole = R.scores(q, n, row, codes, tf, slice(0, n_queries))
    assert (whole == plain).all()
    q.term_tile = lambda: 7
    assert (np.hstack([R.scores(q, n, row, codes, tf, slice(a, min(a + 4, n_queries))) for a in range(0, n_queries, 4)]) == plain).all()


def test_partial_sums_stay_exact():
    q = R.Queries([0], np.array([0, 1]), np.array([0]), np.array([2**31]), 1, 1)
    assert q.term_tile() * R.IMPACT_BOUND * 2**31 < 2**53
    assert R.Queries([0], np.array([0, 1]), np.array([0]), np.array([9000]), 1, 1).term_tile() == R.TERM_TILE
    assert int(R.impacts(np.array([10**9]), np.array([1]), q)[0]) < R.IMPACT_BOUND


def test_ties_by_smallest_id():
    ids, score = np.array([5, 3, 9, 1, 2]), np.array([4, 4, 4, 0, 9])
    assert ids[R.best(ids, score, 3)].tolist() == [2, 3, 5]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.rank(docs, items).count() == 0
    assert R.rank(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).count() == 0
