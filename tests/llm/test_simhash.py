import random

import numpy as np
import pytest
import xxhash

from lexrev.llm.components import components
from lexrev.llm.simhash import fingerprints, keep_one, links, near_duplicates, simhash


def brute_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else (" " if c in "\t\n\v\f\r" else c) for c in text or "").split(" ") if w]
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs)) if hs else 0


def brute_components(prints):
    """(id, print) -> smallest id reachable."""
    ids = list(prints)
    root = {i: i for i in ids}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in ids:
        for j in ids:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["Wort", "é", "the", "of", "tion", "x y", "\x1c", "end."] + [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            w = (rng.choice(texts) or "").split(" ")
            if w and rng.random() < 0.7:
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
        else:
            texts.append(rng.choice([" ", "\n", "\t \r"]).join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 5, 60, 200]))))
    return [*texts, None, "", " \n", "one", "ONE"]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    texts = corpus(seed, 90)
    df = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    prints = {i * 3: brute_print(t) for i, t in enumerate(texts)}
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(prints.items(), brute_components(prints).values(), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(df).collect()}
    assert got == want
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_join_what_pairs_join(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(-2**63, 2**63, 12)
    fps = set(base.tolist())
    for _ in range(80):
        x = rng.choice(list(fps)).item()
        for b in rng.integers(0, 64, rng.integers(1, 4)):
            x ^= (1 << int(b)) if b < 63 else -2**63
        fps.add(x)
    fps = sorted(fps)
    got = {r.node: r.root for r in components(links(spark.createDataFrame([(f,) for f in fps], "fp long"), radius)).collect()}
    root = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                    root[a] = root[b] = min(root[a], root[b])
    assert {f: got.get(f, f) for f in fps} == root


def test_long_chain_of_links(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    df = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "a long, b long")
    got = components(df).collect()
    assert len(got) == n and {r.root for r in got} == {0}


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, None), (3, "q r s t u v")], "doc_id long, text string")
    rows = sorted((r.fingerprint, r.doc_id is None, r.component_id) for r in near_duplicates(df).collect())
    assert len(rows) == 5
    assert {c for f, _, c in rows if f == f"{brute_print('a b c d'):016x}"} == {7}
    kept = sorted(((r.doc_id or -1), r.text) for r in keep_one(df).collect() if r.text)
    assert kept == [(3, "q r s t u v"), (7, "a b c d")]
    assert keep_one(df).count() == 3
    long = "lorem ipsum dolor " * 60_000
    assert simhash(long.encode()) & (2**64 - 1) == brute_print(long)
    assert fingerprints(df).where("fp = 0").count() == 1
