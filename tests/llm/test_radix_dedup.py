"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from lexrev.llm.radix_dedup import remove_repeats


def brute(texts, depth):
    raws = [(t or "").encode() for t in texts]
    n = Counter(r[i:i + depth] for r in raws for i in range(len(r) - depth + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - depth + 1):
            if n[r[i:i + depth]] > 1:
                gone[i:i + depth] = b"\1" * depth
        spans = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, depth=200, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, depth, **kw).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, depth)


def noise(rng, n, alphabet="abcdefghij klmné"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_copies_near_copies_and_shared_passages(spark):
    rng = random.Random(1)
    base = noise(rng, 3000)
    passage = noise(rng, 260)
    texts = [base, base, base[:1400] + "X" + base[1400:], base[37:2500], noise(rng, 500) + passage + noise(rng, 90),
             passage, noise(rng, 40) + passage[:215] + noise(rng, 400), passage[20:] + passage, "short", "", None,
             noise(rng, 199), "a" * 900, "a" * 199 + "b" + "a" * 201, "xyz ab " * 120, "xyz ab " * 70 + "Q" + "xyz ab " * 29,
             noise(rng, 700) + base[900:1105] + noise(rng, 300)]
    check(spark, texts)


@pytest.mark.parametrize("seed", range(3))
def test_random_edits_at_small_depth(spark, seed):
    rng = random.Random(seed)
    pool = [noise(rng, rng.randint(20, 300), "abc ") for _ in range(6)]
    texts = []
    for _ in range(40):
        t = "".join(rng.choice(pool)[rng.randint(0, 15):] for _ in range(rng.randint(0, 4)))
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, len(t))
            t = t[:i] + rng.choice(["", "z", "yy"]) + t[i + 1:]
        texts.append(t)
    check(spark, texts, depth=24, gram=6, block=5)


def test_passages_that_repeat_only_back_to_back(spark):
    rng = random.Random(8)
    phrase = noise(rng, 60)
    check(spark, ["a" * 900, noise(rng, 400) + "=" * 300 + noise(rng, 400), phrase * 12, noise(rng, 500) + noise(rng, 169) * 3,
                  "b" * 200, "c" * 201, noise(rng, 90) + "xy" * 100 + noise(rng, 90), noise(rng, 170) * 2])


@pytest.mark.parametrize("seed", range(3))
def test_lone_periods_at_small_depth(spark, seed):
    rng = random.Random(seed)
    check(spark, [noise(rng, rng.randint(0, 40)) + noise(rng, rng.randint(1, 25)) * rng.randint(2, 9) + noise(rng, rng.randint(0, 40))
                  for _ in range(30)], depth=24, gram=6, block=5)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).count() == 0
    t = noise(random.Random(5), 400, "abc def")
    df = spark.createDataFrame([(1, t, 5), (1, t, 6), (None, t, 7), (None, None, 8), (4, t + "x", 9)], "doc_id long, text string, lo int")
    rows = remove_repeats(df).collect()
    assert len(rows) == 5
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows) == [
        (False, 1, 400), (False, 1, 400), (False, 4, 400), (True, 0, 0), (True, 0, 400)]
