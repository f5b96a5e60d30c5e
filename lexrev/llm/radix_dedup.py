"""Repeated byte strings by a depth-limited radix partition of suffixes.

A suffix takes part up to ``depth`` bytes. Most-significant-digit passes refine groups of
suffixes by one digit after another; a suffix that is alone in its group leaves, and the groups
that are left when the digits cover all ``depth`` bytes are exactly the repeated windows. No pass
orders the groups among each other, as the result does not need it. The digits are taken in an
order that the window's own content fixes, so that equal windows take equal digits:

1. *Lead*: the ``gram`` bytes of the window with the smallest hash. Neighbouring windows mostly
   share their lead, so one row stands for the whole run of them (about one row per 90 bytes).
   A run whose bytes from the first window's start to the last one's end (its hull) occur twice is
   done: all its windows repeat. One run of each such group goes on as a partner for other runs.
   A run without a partner goes on if its lead stands at two or more places in it, as in a passage
   that repeats itself back to back.
2. *Core*: runs go on in blocks of ``BLOCK`` windows, by the distance from window start to lead.
   The digit is what all windows of the block share.
3. *Margins*: the bytes left and right of the core, which complete each window to ``depth``.

Leads and cores are compared by 64-bit hashes each (128 bits for a window with the margins
as they are). Hot groups (a line in a third of the documents) are counted with partial
aggregation and joined by plain shuffle joins that adaptive execution can split; no group is ever
gathered in a task. Lists are gathered per document only.

Nulls count as empty texts; texts shorter than ``depth`` keep every byte; repeated rows are copies
of each other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev.llm.common import doc_key, join_totals, map_batches, mix64, sha256_hex, utf8_rows
from lexrev.session import cut_lineage

DEPTH = 200
GRAM = 32
BLOCK = 16
_MULT = 0x9E3779B97F4A7C15
_BYTE = (np.random.default_rng(6).integers(0, 2**63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

_MIXED = mix64(_BYTE)

KEY = ["k_id", "k_hash"]


def rolling_hash(b: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` bytes of ``b``, joined from hashes of powers of two."""
    power, cur, n = _MULT, _BYTE[b], 1
    out, have = None, 0
    while True:
        if width & n:
            if out is None:
                out, have = cur, n
            else:
                m = min(len(out), len(cur) - have)
                out, have = out[:m] * np.uint64(power) + cur[have:have + m], have + n
        if 2 * n > width:
            return out
        cur = cur[:-n] * np.uint64(power) + cur[n:]
        power, n = power * power % 2**64, 2 * n


_INVERSE = pow(_MULT, -1, 2**64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0..n-1 of the multiplier and of its inverse, modulo 2**64, kept for the longest text so far."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_MULT, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def prefix_hash(b: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows (arithmetic modulo 2**64)."""
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_MIXED[b] * _powers(len(b) + 1)[1][:len(b)], out=sums[1:])
    return sums


def stretch_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of bytes lo..hi-1 for each pair, whatever its place in whatever text."""
    h = (sums[hi] - sums[lo]) * _powers(len(sums))[0][lo] + (hi - lo).astype(np.uint64)
    return mix64(h).view(np.int64)


def window_min(v: np.ndarray, width: int, least: np.ufunc = np.minimum) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        v, n = least(v[:-n], v[n:]), 2 * n
    rest = width - n
    return least(v[:-rest], v[rest:]) if rest else v


def lead_places(g: np.ndarray, low: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """How often the lead of each run lo..hi stands in it; ``low`` are the leads of all windows of grams ``g``."""
    width = len(g) - len(low) + 1
    pad = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(g == window_min(np.concatenate([pad, low, pad]), width, np.maximum))
    leads, rank = np.unique(low[lo], return_inverse=True)
    keys = np.sort(np.searchsorted(leads, g[at]) * len(g) + at)
    return np.searchsorted(keys, rank * len(g) + hi + width - 1, "right") - np.searchsorted(keys, rank * len(g) + lo)


def runs_of(b: np.ndarray, depth: int, gram: int):
    """Runs of window starts with one lead: first and last start, lead hash, hash of the hull, whether the lead stands in it twice."""
    g = mix64(rolling_hash(b, gram))
    low = window_min(g, depth - gram + 1)
    cut = np.flatnonzero(low[1:] != low[:-1]) + 1
    lo = np.concatenate([[0], cut])
    hi = np.concatenate([cut - 1, [len(low) - 1]])
    hull = stretch_hash(prefix_hash(b), lo, hi + depth)
    return lo, hi, low[lo].view(np.int64), hull, lead_places(g, low, lo, hi) > 1


RUN_SCHEMA = "k_id long, k_hash long, lo int, hi int, lead long, hull long, twice boolean"


def _runs(docs: DataFrame, depth: int, gram: int) -> DataFrame:
    def fn(batch: pa.RecordBatch):
        ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        parts, at = [], []
        for i, raw in enumerate(utf8_rows(batch.column(2))):
            if len(raw) >= depth:
                parts.append(runs_of(np.frombuffer(raw, np.uint8), depth, gram))
                at.append(i)
        if not parts:
            return None
        rows = np.repeat(at, [len(p[0]) for p in parts])
        lo, hi, lead, hull, twice = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (ids[rows], hashes[rows], lo.astype(np.int32), hi.astype(np.int32), lead, hull, twice)],
            names=["k_id", "k_hash", "lo", "hi", "lead", "hull", "twice"])

    return map_batches(docs, fn, RUN_SCHEMA)


def _packed(docs: DataFrame) -> DataFrame:
    """Key and compressed text, for the two shuffles that bring texts and findings together."""
    def fn(batch: pa.RecordBatch):
        c = zstandard.ZstdCompressor(level=3)
        z = pa.array([c.compress(raw) for raw in utf8_rows(batch.column(2))], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z], names=["k_id", "k_hash", "z"])

    return map_batches(docs, fn, "k_id long, k_hash long, z binary")


BLOCK_SCHEMA = "k_id long, k_hash long, lo int, hi int, lead long, off int, core long, lmargin binary, rmargin binary"


def blocks_of(raw: bytes, starts: np.ndarray, ends: np.ndarray, depth: int, gram: int, block: int):
    """Blocks of the runs starts..ends: windows with one lead position and one step of its offset."""
    b = np.frombuffer(raw, np.uint8)
    g = mix64(rolling_hash(b, gram))
    prefix = prefix_hash(b)
    out = []
    for lo, hi in zip(starts, ends, strict=True):
        own = g[lo:hi + depth - gram + 1]
        lead = window_min(g[lo:lo + depth - gram + 1], depth - gram + 1)[0]
        at = np.flatnonzero(own == lead) + lo
        s = np.arange(lo, hi + 1)
        p = at[np.searchsorted(at, s)]
        off = p - s
        step = off // block
        cut = np.flatnonzero((p[1:] != p[:-1]) | (step[1:] != step[:-1])) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut - 1, [len(s) - 1]])
        out.append((s[first], s[last], np.full(len(first), lead), p[first], step[first]))
    lo, hi, lead, p, step = (np.concatenate(x) for x in zip(*out, strict=True))
    # A block covers offsets step*block .. step*block+block-1; the core is what windows at all of them share.
    c_lo = p - step * block
    c_hi = c_lo - block + 1 + depth
    return lo, hi, lead.view(np.int64), step, stretch_hash(prefix, c_lo, c_hi), c_lo, c_hi


def _blocks(joined: DataFrame, depth: int, gram: int, block: int) -> DataFrame:
    def fn(batch: pa.RecordBatch):
        d = zstandard.ZstdDecompressor()
        ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cols: list[list] = [[] for _ in range(9)]
        for i in range(batch.num_rows):
            raw = d.decompress(batch.column(2)[i].as_py())
            iv = batch.column(3)[i].values
            los, his = iv.field(0).to_numpy(), iv.field(1).to_numpy()
            order = np.lexsort((his, los))
            lo, hi, lead, step, core, c_lo, c_hi = blocks_of(raw, los[order], his[order], depth, gram, block)
            cols[0].append(np.full(len(lo), ids[i]))
            cols[1].append(np.full(len(lo), hashes[i]))
            for k, x in ((2, lo.astype(np.int32)), (3, hi.astype(np.int32)), (4, lead), (5, step.astype(np.int32)), (6, core)):
                cols[k].append(x)
            cols[7] += [raw[a:c] for a, c in zip(lo.tolist(), c_lo.tolist(), strict=True)]
            cols[8] += [raw[c:e + depth] for c, e in zip(c_hi.tolist(), hi.tolist(), strict=True)]
        arrays = [pa.array(np.concatenate(x)) for x in cols[:7]] + [pa.array(x, pa.binary()) for x in cols[7:]]
        return pa.RecordBatch.from_arrays(arrays, names=["k_id", "k_hash", "lo", "hi", "lead", "off", "core", "lmargin", "rmargin"])

    return map_batches(joined, fn, BLOCK_SCHEMA)


def repeated_windows(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """Starts of repeated windows of ``docs(k_id, k_hash, text)`` as runs: k_id, k_hash, lo, hi (inclusive)."""
    runs = _runs(docs, depth, gram)
    by_lead = (runs.groupBy("lead").agg(F.count("*").alias("n"), F.min("hull").alias("h0"), F.max("hull").alias("h1"),
                                        F.max("twice").alias("twice"))
               .where("n > 1 OR twice").selectExpr("lead", "n = 1 OR h0 <> h1 AS mixed"))
    found = cut_lineage(join_totals(runs.drop("twice"), by_lead, ["lead"]), "radix-runs")
    mixed = found.where("mixed")
    hulls = (mixed.groupBy("lead", "hull")
             .agg(F.count("*").alias("n"), F.min(F.struct("k_id", "k_hash", "lo")).alias("rep")))
    judged = cut_lineage(
        join_totals(mixed, hulls, ["lead", "hull"])
        .select(*KEY, "lo", "hi", (F.col("n") > 1).alias("done"),
                ((F.col("n") == 1) | (F.struct("k_id", "k_hash", "lo") == F.col("rep"))).alias("go")), "radix-judged")
    whole = found.where("NOT mixed").select(*KEY, "lo", "hi").unionByName(judged.where("done").select(*KEY, "lo", "hi"))

    lists = judged.where("go").groupBy(*KEY).agg(F.collect_set(F.struct("lo", "hi")).alias("iv"))
    blocks = cut_lineage(_blocks(_packed(docs).join(lists, KEY), depth, gram, block), "radix-blocks")
    core = ["lead", "off", "core"]
    blocks = blocks.withColumn("digit", F.xxhash64("lmargin", "rmargin", F.octet_length("lmargin")))
    groups = (blocks.groupBy(*core).agg(F.count("*").alias("n"), F.min("digit").alias("d0"), F.max("digit").alias("d1"))
              .where("n > 1").select(*core, F.expr("d0 <> d1").alias("mixed")))
    live = cut_lineage(join_totals(blocks, groups, core), "radix-live")
    even = live.where("NOT mixed").select(*KEY, "lo", "hi")
    mixed = live.where("mixed")
    kinds = (mixed.groupBy(*core, "digit")
             .agg(F.count("*").alias("n"), F.min(F.struct("k_id", "k_hash", "lo")).alias("rep")))
    judged = cut_lineage(join_totals(mixed, kinds, [*core, "digit"]), "radix-judged")
    even = even.unionByName(judged.where("n > 1").select(*KEY, "lo", "hi"))
    # The last digit: each window's own part of both margins.
    go = judged.where((F.col("n") == 1) | (F.struct("k_id", "k_hash", "lo") == F.col("rep")))
    windows = _window_digits(go, core)
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    single = join_totals(windows, twice, ["w1", "w2"]).select(*KEY, F.col("s").alias("lo"), F.col("s").alias("hi"))
    return whole.unionByName(even).unionByName(single)


def _window_digits(live: DataFrame, core: list[str]) -> DataFrame:
    """One row per window of the blocks that are left: 128 bits of lead, core, offset and its part of the margins."""
    w = live.select(*KEY, *core, "lo", "hi", "lmargin", "rmargin", F.explode(F.sequence("lo", "hi")).alias("s"))
    left = F.expr("substring(lmargin, s - lo + 1)")
    right = F.expr("substring(rmargin, 1, octet_length(rmargin) - (hi - s))")
    parts = [*core, F.octet_length(left), left, right]
    return w.select(*KEY, "s", F.xxhash64(*parts).alias("w1"), F.xxhash64(F.lit(2), *reversed(parts)).alias("w2"))


def remove_repeats(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """Remove every byte of ``docs(doc_id, text)`` that lies in a ``depth``-byte string which starts more than once.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes left, concatenated)
    and kept_sha256, one row for each input row.
    """
    keyed = docs.select(*doc_key(), F.coalesce("text", F.lit("")).alias("text"))
    found = (repeated_windows(keyed, depth, gram, block).groupBy(*KEY)
             .agg(F.collect_list(F.struct("lo", "hi")).alias("iv")))
    joined = _packed(keyed).join(found, KEY, "left")

    def fn(batch: pa.RecordBatch):
        d = zstandard.ZstdDecompressor()
        rows = []
        for i in range(batch.num_rows):
            raw = d.decompress(batch.column(2)[i].as_py())
            removed, spans, kept = 0, 0, raw
            if batch.column(3)[i].is_valid:
                iv = batch.column(3)[i].values
                step = np.zeros(len(raw) + 1, np.int64)
                np.add.at(step, iv.field(0).to_numpy(), 1)
                np.add.at(step, iv.field(1).to_numpy() + depth, -1)
                gone = np.cumsum(step)[:-1] > 0
                removed = int(gone.sum())
                spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows.append((batch.column(0)[i].as_py(), len(raw), removed, spans, kept, sha256_hex(kept)))
        ids, n, gone, spans, kept, sha = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(kept, pa.binary()), pa.array(sha, pa.string())],
            names=["k_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    out = map_batches(joined, fn, "k_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.select(F.when(F.col("k_id") != -(2**63), F.col("k_id")).alias("doc_id"),
                      "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
