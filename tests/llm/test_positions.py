import random
import re

import pytest

from lexrev.llm.positions import build_index, contamination, drop_contaminated, phrase_blocks, search, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(texts, items, window, near):
    counts = {}
    for t in texts:
        for w in words(t):
            counts[w] = counts.get(w, 0) + 1
    out = []
    for t in texts:
        ws, hit, got, close = words(t), set(), set(), set()
        for item, q in items:
            qs = words(q)
            for i in range(max(1, len(qs) - window + 1)) if qs else ():
                p = qs[i:i + window]
                for s in range(len(ws) - len(p) + 1):
                    if ws[s:s + len(p)] == p:
                        got.add(str(item))
                        hit.update(range(s, s + len(p)))
                rare = min(p, key=lambda w: (counts.get(w, 0), w.encode()))
                if any(w == rare and all(x in ws[max(0, k - near):k + near + 1] for x in p) for k, w in enumerate(ws)):
                    close.add(str(item))
        out.append((len(ws), len(hit), sorted(got), sorted(close)))
    return out


def test_words():
    for t in ("It's 3x [a] é-ß Ünï_code x\x7f\x80 Z`{z}@A", "", "...", "日本 語", "a\x00b"):
        assert [w.decode() for w in words_of(t.encode())] == words(t)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = ["The", "of", "é", "x1"] + [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 5, 6, 9])))) for i in range(18)] + [(100, None), (7, "w1, w2")]
    texts = [None, "", "?!", "the"]
    for _ in range(60):
        t = [rng.choice(vocab) for _ in range(rng.choice([2, 10, 80]))]
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t)):0] = (rng.choice(items)[1] or "").split(" ")
        texts.append(rng.choice([" ", ", ", "\n"]).join(t))
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, items string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), list(r.near_items)) for r in contamination(df, q, 5, 6).collect()}
    want = brute(texts, items, 5, 6)
    for i, w in enumerate(want):
        assert got[i] == w, (i, texts[i])
    clean = drop_contaminated(df, q, 5)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, w in enumerate(want) if not w[1]]


def test_blocks_of_phrases(spark):
    q = spark.createDataFrame([(i, " ".join(f"t{(i * 7 + k) % 40}" for k in range(14))) for i in range(30)], "item_id long, text string")
    one = [p for b in phrase_blocks(q, 10, "item_id") for p in b]
    many = list(phrase_blocks(q, 10, "item_id", 900))
    assert len(many) > 5 and [p for b in many for p in b] == one
    docs = spark.createDataFrame([(1, " ".join(f"T{k % 40}" for k in range(100)))], "doc_id long, text string")
    index = build_index(docs, 100)
    assert sum(search(index, b, 5).where("words > 0").count() for b in many) == search(index, one, 5).where("words > 0").count() > 0


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(none, q).count() == 0
    df = spark.createDataFrame([(5, "x A b C"), (5, "x A b C"), (None, "a b c"), (9, "a b")], "doc_id long, text string")
    rows = contamination(df, q).collect()
    assert sorted((r.doc_id or -1, r.n_hit) for r in rows) == [(-1, 3), (5, 3), (5, 3), (9, 0)]
    assert {(r.doc_id, r.n_hit) for r in contamination(df, none.withColumnRenamed("doc_id", "item_id")).collect()} == {(5, 0), (None, 0), (9, 0)}
    assert sorted(r.doc_id for r in drop_contaminated(df, q).collect()) == [9]
