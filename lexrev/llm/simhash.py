"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most r bits exactly if some value lies within floor(r/2) bits of one
and within ceil(r/2) bits of the other. Every distinct fingerprint therefore emits all values within
ceil(r/2) bits; the values are shuffled, and in each group the fingerprints are linked to the smallest
one among those within floor(r/2) bits. That one is within r bits of all others, and any two
fingerprints within r bits meet so in some group: the links join exactly the texts that pairs would,
without emitting pairs within a group. A group holds distinct fingerprints within one small ball, at most
65 of them for r = 2. Links are deduplicated and their distance is verified.

Nulls and texts without words have fingerprint zero and link like any other; texts of fewer words
than a shingle have one shingle of all their words; repeated rows are members of one component; a null
doc_id is ignored where a smallest doc_id is sought; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexrev.llm.common import LOWER_TABLE, doc_key, map_batches, utf8_rows
from lexrev.llm.components import components
from lexrev.session import cut_lineage

SHINGLE = 3
MAX_BITS = 2
SEED = 42
_STEP = 1 << 15


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles (repeats count) of an A-Z-lower-cased UTF-8 text."""
    words = raw.translate(LOWER_TABLE).split()  # on \x20 and \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:len(words) - width] + 1]).tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, _STEP):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[i:i + _STEP], ends[i:i + _STEP], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """k_id, k_hash and fingerprint (fp long) of every row of ``docs(doc_id, text)``."""
    def fn(b: pa.RecordBatch):
        fp = pa.array([simhash(raw, shingle) for raw in utf8_rows(b.column(2))], pa.int64())
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], names=["k_id", "k_hash", "fp"])

    return map_batches(docs.select(*doc_key(), "text"), fn, "k_id long, k_hash long, fp long")


def _signed(v: int) -> int:
    return v - 2**64 if v >= 2**63 else v


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, with the same components as all pairs within ``max_bits``."""
    near, far = max_bits // 2, (max_bits + 1) // 2
    masks = [(_signed(sum(1 << i for i in c)), d) for d in range(far + 1) for c in combinations(range(64), d)]
    ball = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(d).alias("d")) for m, d in masks])
    variants = (fps.select("fp").select("fp", F.explode(ball).alias("b"))
                .select(F.col("fp").bitwiseXOR(F.col("b.m")).alias("v"), "fp", F.col("b.d").alias("d")))
    center = F.min(F.when(F.col("d") <= near, F.col("fp"))).over(Window.partitionBy("v"))
    met = variants.select("fp", center.alias("c")).where("c <> fp")
    return (met.select(F.least("c", "fp").alias("a"), F.greatest("c", "fp").alias("b")).distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Fingerprint and component of every row of ``docs(doc_id, text)``.

    Returns doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the component),
    k_id and k_hash (the row's key) and keep (this key stands for its component).
    """
    prints = cut_lineage(fingerprints(docs, shingle), "simhash")
    key = F.struct("k_id", "k_hash")
    # A null id is the smallest long in a key: it must stand for its component only if there is no other.
    rank = F.struct((F.col("k_id") == -(2**63)).alias("no_id"), "k_id", "k_hash")
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-distinct")
    comp = components(links(distinct, max_bits))
    rooted = distinct.join(comp, distinct.fp == comp.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    by_print = rooted.join(heads, "root").select("fp", "head")
    out = prints.join(by_print, "fp")
    return out.select(
        F.when(F.col("k_id") != -(2**63), F.col("k_id")).alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(~F.col("head.no_id"), F.col("head.k_id")).alias("component_id"),
        "k_id", "k_hash", (key == F.struct("head.k_id", "head.k_hash")).alias("keep"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without the near-duplicates: one row of each component, all columns as they came."""
    kept = near_duplicates(docs, shingle, max_bits).where("keep").select("k_id", "k_hash").distinct()
    names = [f"_c{i}" for i in range(len(docs.columns))]
    inner = docs.select(*doc_key(), *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    one = inner.join(kept, ["k_id", "k_hash"]).dropDuplicates(["k_id", "k_hash"])
    return one.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
