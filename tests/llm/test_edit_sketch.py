import hashlib
import random

import numpy as np

from lexrev.llm.edit_sketch import (_walk_table, classes, edited, fingerprint, likeness, neighbour_fingerprints, similar_texts, sketch, walk)


def noise(rng, n):
    return "".join(rng.choice("abcdefgh ijklmnopé日") for _ in range(n))


def parse(h):
    return np.frombuffer(bytes.fromhex(h), ">u2")


def test_walk_equals_step_by_step():
    table = _walk_table()
    bits = np.random.default_rng(4).integers(0, 2, (1024, 256)).astype(bool)
    bits[-1] = True
    own = classes(noise(random.Random(1), 500))
    i, j, written, states = 0, 0, [], []
    while i < len(own):
        written.append(own[i])
        if bits[j % 1024][own[i]]:
            i += 1
            states.append((j + 1) % 1024 * 256)
        j += 1
    assert walk(own) == states and len(table) == 1024 * 256
    assert 1.6 < len(written) / len(own) < 2.4


def test_few_edits_stay_near_and_others_far():
    rng = random.Random(2)
    for n in (400, 3000, 40_000):
        a = noise(rng, n)
        b = list(a)
        for _ in range(3):
            i = rng.randrange(len(b))
            b[i:i + 1] = rng.choice([[], ["z"], ["y", "x"]])
        same, near = fingerprint(a), fingerprint("".join(b))
        assert likeness(parse(same), parse(near)) > 0.5
        assert likeness(parse(same), parse(fingerprint(noise(rng, n)))) < 0.35
    half = [likeness(parse(fingerprint(t)), parse(fingerprint(edited(t, noise(rng, 2000))))) for t in (noise(rng, 1500) for _ in range(30))]
    assert 0.4 < np.mean(half) < 0.65


def test_short_texts_that_have_nothing_in_common():
    rng = random.Random(6)
    for n in range(1, 61):
        a, b = (parse(fingerprint("".join(rng.choice(letters) for _ in range(n)))) for letters in ("abcdefgh", "qrstuvwx"))
        assert likeness(a, b) < 0.2 and likeness(a, parse(fingerprint(""))) == 0 and likeness(a, a) == 1, n
    assert likeness(parse(fingerprint("")), parse(fingerprint(None))) == 1
    mean = np.mean([likeness(parse(fingerprint(noise(rng, n))), parse(fingerprint(noise(rng, n)))) for n in range(5, 61) for _ in range(10)])
    assert mean < 0.35


def test_short_texts_are_not_one_group(spark):
    rows = [(1, "ab"), (2, "xy"), (3, "longer one"), (4, "nothing so"), (5, ""), (6, "ab"), (7, "z")]
    got = {r.doc_id: r.group for r in similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 1, 7: 7}


def test_neighbours_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i * 2, noise(rng, rng.choice([0, 1, 2, 5, 50, 400])), "k") for i in range(60)] + [(1, None, "k"), (3, "", "k"), (None, "xyz", "k")]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r for r in neighbour_fingerprints(spark.createDataFrame(rows, "doc_id long, text string, part string")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    for k, (i, t, _) in enumerate(ordered):
        t, nxt = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        e = edited(t, nxt)
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (
            len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint(t), fingerprint(e))
        assert np.isclose(r.near_edited, likeness(parse(fingerprint(t)), parse(fingerprint(e))))
        assert np.isclose(r.near_next, likeness(parse(fingerprint(t)), parse(fingerprint(nxt))))


def test_similar_texts_and_edges(spark):
    rng = random.Random(5)
    a, b = noise(rng, 4000), noise(rng, 4000)
    near = a[:3900] + "Z" + a[3900:]
    df = spark.createDataFrame([(5, a), (3, a), (9, near), (4, b), (None, b), (8, None), (2, "")], "doc_id long, text string")
    got = {(r.doc_id, r.group) for r in similar_texts(df).collect()}
    assert {(5, 3), (3, 3), (9, 3), (4, 4), (None, 4), (8, 2), (2, 2)} == got
    one = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = neighbour_fingerprints(one).collect()
    assert [(x.doc_id, x.near_next) for x in r] == [(1, 1.0)]
    assert neighbour_fingerprints(one.limit(0)).count() == 0
    assert sketch(b"", []).sum() == 0
    assert fingerprint("ab " * 300_000) == fingerprint("ab " * 300_000)


def test_chains_of_edited_copies_against_brute_force(spark):
    rng = random.Random(12)
    texts = []
    for _ in range(3):
        t = noise(rng, 500)
        for _ in range(25):
            texts.append(t)
            for _ in range(2):
                i = rng.randrange(len(t))
                t = t[:i] + rng.choice(["", "z", "yx"]) + t[i + 1:]
    prints = [parse(fingerprint(t)) for t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            bands = ((a == b).reshape(-1, 2).all(axis=1) & (a != 0).reshape(-1, 2).any(axis=1)).any()
            if bands and likeness(a, b) >= 0.8 and group[i] != group[j]:
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    got = {r.doc_id: r.group for r in similar_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), band=2).collect()}
    assert [got[i] for i in range(len(texts))] == group
