import random

from lexrev.llm.packing import CAPACITIES, OVERHEAD, downsized, pack, pack_documents, pack_lengths
from lexrev.llm.records import default_tokenizer, load_tokenizer


def brute(lengths, caps, overhead):
    bins, out = [], []
    for i, n in enumerate(lengths):
        fits = [k for k, (room, _) in enumerate(bins) if room >= n]
        if fits:
            low = min(bins[k][0] for k in fits)
            out.append(low - n)
            k = next(k for k in fits if bins[k][0] == low)
        else:
            rest = lengths[i + 1:]
            c = min((c for c in caps if c >= n), key=lambda c: ((overhead + c) / (n + min(c - n, sum(x for x in rest if x <= c - n))), c))
            bins.append((c, c))
            k = len(bins) - 1
            out.append(c - n)
        bins[k] = (bins[k][0] - n, bins[k][1])
    return out, sorted(c - r for r, c in bins)


def cost(lengths, caps, overhead):
    fill = {}
    for n, (b, _) in zip(lengths, pack(lengths, caps, overhead), strict=True):
        fill[b] = fill.get(b, 0) + n
    return sum(overhead + downsized(n, caps) for n in fill.values())


def test_against_brute_force_and_room_used():
    rng = random.Random(1)
    for seed in range(30):
        caps = (8, 16, 50) if seed % 2 else (40,)
        lengths = sorted((min(max(caps), max(1, int(rng.expovariate(1 / 9)))) for _ in range(rng.randint(0, 120))), reverse=True)
        placed = pack(lengths, caps, 3)
        room, want = {}, brute(lengths, caps, 3)
        for n, (b, at) in zip(lengths, placed, strict=True):
            assert at == room.get(b, 0)
            room[b] = at + n
        assert sorted(room.values()) == want[1]
        assert all(v <= max(caps) for v in room.values())


def test_joint_choice_beats_single_sizes_and_shards_cost_little():
    rng = random.Random(2)
    lengths = sorted((min(4096, max(1, int(rng.lognormvariate(6.3, 1)))) for _ in range(16384)), reverse=True)
    joint = cost(lengths, CAPACITIES, OVERHEAD)
    assert joint <= min(cost(lengths, (4096,), OVERHEAD), sum(OVERHEAD + downsized(n, CAPACITIES) for n in lengths))
    assert joint < 1.05 * (sum(lengths) + OVERHEAD * sum(lengths) / 4096)
    halves = sum(cost(sorted(lengths[k::2], reverse=True), CAPACITIES, OVERHEAD) for k in (0, 1))
    assert halves < 1.01 * joint


def test_documents(spark):
    rng = random.Random(3)
    texts = [None, "", "a"] + [" ".join(rng.choice(["word", "ab", "x!"]) for _ in range(rng.choice([3, 40, 900, 5000]))) for _ in range(40)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "q", 1), (7, texts[7], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = pack_documents(df, default_tokenizer()).collect()
    tok = load_tokenizer(default_tokenizer())
    want = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    by_bin, by_doc = {}, {}
    for r in out:
        by_bin.setdefault((r.bin_id, r.capacity), []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
    assert sum(want) == sum(r.length for r in out)
    for i, t, _ in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids) + 1
        assert sorted(by_doc[i])[0][0] == 0 and sum(x for _, x in by_doc[i]) == n * (2 if i == 7 else 1)
    for (_, cap), own in by_bin.items():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert cap == downsized(at, CAPACITIES)
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), default_tokenizer()).count() == 0
    many = spark.createDataFrame([(1, 1, 5)] * 3000, "k_id long, k_hash long, n_tokens long")
    sizes = [r["count"] for r in pack_lengths(many, shard=300).selectExpr("bin_id >> 32 AS s").groupBy("s").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 450
