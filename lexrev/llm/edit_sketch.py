"""Document fingerprints by randomised edit embedding.

A walk reads the text and writes symbols: at every step it writes the class of the character it stands on, and a
random bit, which step and class fix for all texts alike, says whether it goes on to the next character. Texts a few edits
apart fall back into step soon after each edit, so that the Hamming distance of what they write grows with their edit distance,
not with their length. The bits repeat every ``PERIOD`` steps.

The written string is sampled: its steps are dealt into ``STRIPES`` stripes, and each stripe keeps 16 bits of the smallest
hash of (step, symbol), 0 if no step falls into it. Two stripes agree with the share of (step, symbol) pairs that both strings have
of all that either has, whatever the lengths; stripes that are empty in both say nothing and do not count. Likeness is that share turned into the share of equal steps. Fingerprints are the stripes in hexadecimal.

Similar texts are sought by bands of stripes. In each band bucket every text is compared to the smallest fingerprint. Then
all pairs of a bucket that these links leave in different groups are compared, so that no link between groups is lost;
large buckets are dealt in pairs of blocks. Every link is verified on the whole fingerprint.

Nulls are empty texts, whose fingerprint is all zero; repeated rows and equal texts have equal fingerprints; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexrev.llm.common import join_totals, map_batches, sha256_hex
from lexrev.llm.components import components
from lexrev.session import cut_lineage

PERIOD = 1024
STRIPES = 128
BAND = 4
ALIKE = 0.8
#: Members of a band bucket in a block; the pairs of blocks are dealt over tasks.
BUCKET_BLOCK = 1000
_CLASSES = 256


def _walk_table() -> list[int]:
    """State after writing a character of class c from step j, at [j * 256 + c]; states are steps (mod PERIOD) * 256."""
    bits = np.random.default_rng(4).integers(0, 2, (PERIOD, _CLASSES)).astype(bool)
    bits[-1] = True  # no walk stands still
    table = np.zeros((PERIOD, _CLASSES), np.int64)
    for j in range(PERIOD - 1, -1, -1):
        table[j] = np.where(bits[j], (j + 1) % PERIOD, table[(j + 1) % PERIOD])
    return (table * _CLASSES).ravel().tolist()


_TABLE: list[int] = []
_SYMBOL = np.random.default_rng(5).integers(0, 2**32, _CLASSES, dtype=np.uint32)


def classes(text: str) -> bytes:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return ((cp * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def walk(own: bytes, state: int = 0) -> list[int]:
    """States after each character."""
    if not _TABLE:
        _TABLE.extend(_walk_table())
    table, out = _TABLE, []
    add = out.append
    for c in own:
        state = table[state + c]
        add(state)
    return out


def sketch(own: bytes, states: list[int]) -> np.ndarray:
    """Stripes of the embedded string of the classes and the states after them."""
    if not own:
        return np.zeros(STRIPES, np.uint16)
    at = np.array(states, np.int64) // _CLASSES
    steps = np.diff(at, prepend=0) % PERIOD
    steps[steps == 0] = PERIOD
    symbols = np.repeat(np.frombuffer(own, np.uint8), steps)
    best = np.full(STRIPES, 2**32 - 1, np.uint32)
    size = STRIPES * 8192
    for lo in range(0, len(symbols), size):  # bounded memory for long texts
        part = symbols[lo:lo + size]
        j = np.arange(lo, lo + len(part), dtype=np.int64).astype(np.uint32)
        h = (j * np.uint32(0x85EBCA6B)) ^ _SYMBOL[part]
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x7FEB352D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x846CA68B)
        h ^= h >> np.uint32(16)
        full = len(h) // STRIPES * STRIPES
        if full:
            best = np.minimum(best, h[:full].reshape(-1, STRIPES).min(axis=0))
        rest = h[full:]
        best[:len(rest)] = np.minimum(best[:len(rest)], rest)
    out = ((best ^ (best >> np.uint32(16))) & np.uint32(0xFFFF)).astype(np.uint16)
    out[(out == 0) & (best != 2**32 - 1)] = 1  # 0 stands for an empty stripe only
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    filled = (a != 0) | (b != 0)
    share = float((a == b)[filled].mean()) if filled.any() else 1.0
    return 2 * share / (1 + share)


def packed(s: np.ndarray) -> bytes:
    return s.astype(">u2").tobytes()


def to_hex(s: np.ndarray) -> str:
    return packed(s).hex()


def fingerprint(text: str | None) -> str:
    own = classes(text or "")
    return to_hex(sketch(own, walk(own)))


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_sketch(own: bytes, states: list[int], following: bytes) -> np.ndarray:
    """Sketch of the edited text; the walk over what stays is not repeated."""
    half = len(own) // 2
    keep = len(own) - half
    new = following[:half]
    head = states[:keep]
    return sketch(own[:keep] + new, head + walk(new, head[-1] if head else 0))


ROW = ("part int, place string, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
       "edited_fingerprint binary, near_edited double, near_next double, text string")
_NAMES = [c.split()[0] for c in ROW.split(", ")]


def _result(doc_id, text: str, own: bytes, states: list[int], sk: np.ndarray, after: tuple[str, bytes, np.ndarray]) -> tuple:
    es = edited_sketch(own, states, after[1])
    return (doc_id, len(text), sha256_hex(edited(text, after[0]).encode("utf-8", "surrogatepass")), packed(sk), packed(es),
            likeness(sk, es), likeness(sk, after[2]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every row of ``docs(doc_id, text)`` and its edited text, whose second half is from the next row.

    Rows follow each other by descending doc_id (null last), after the last comes the first. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. Rows are sorted over partitions; each partition's last row meets the
    next partition's first one in a second pass over these rows alone.
    """
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("h", F.xxhash64("text")).repartitionByRange(F.desc_nulls_last("doc_id"), "h")
               .sortWithinPartitions(F.desc_nulls_last("doc_id"), "h", "text").select("doc_id", "text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, out, size = None, [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = classes(text)
                states = walk(own)
                sk = sketch(own, states)
                if before is None:
                    out.append((part, "first", None, *(None,) * 6, text))
                else:
                    out.append((part, "done", *_result(*before, (text, own, sk)), None))
                before = (doc_id, text, own, states, sk)
                size += 1
                if size % 2000 == 0:
                    yield _batch(out)
                    out = []
        if before is not None:
            out.append((part, "last", before[0], *(None,) * 6, before[1]))
        if out:
            yield _batch(out)

    table = cut_lineage(ordered.mapInArrow(run, ROW), "edit-sketches")
    # Two rows a partition. The order of the partitions is the order of the rows.
    heads = table.where("place = 'first'").select("part", "text")
    after = heads.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                            F.min("part").over(Window.partitionBy())).alias("head"))
    ends = (table.where("place = 'last'").select("part", "doc_id", "text").join(after, "part")
            .join(heads.select(F.col("part").alias("head"), F.col("text").alias("following")), "head"))

    def close(b: pa.RecordBatch):
        rows = []
        for doc_id, text, following in zip(*(c.to_pylist() for c in b.columns), strict=True):
            own, nxt = classes(text), classes(following)
            states = walk(own)
            rows.append((0, "done", *_result(doc_id, text, own, states, sketch(own, states), (following, nxt, sketch(nxt, walk(nxt)))), None))
        return _batch(rows)

    closed = map_batches(ends.select("doc_id", "text", "following"), close, ROW)
    wanted = _NAMES[2:-1]
    both = table.where("place = 'done'").select(*wanted).unionByName(closed.select(*wanted))
    return both.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def similar_texts(docs: DataFrame, alike: float = ALIKE, band: int = BAND) -> DataFrame:
    """doc_id, fingerprint and group (smallest doc_id linked) of every row, linked by banding and verification."""
    def fn(b: pa.RecordBatch):
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t) for t in b.column(1).to_pylist()])],
                                          names=["doc_id", "fingerprint"])

    rows = cut_lineage(map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fn,
                                   "doc_id long, fingerprint string"), "edit-prints")
    prints = cut_lineage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "edit-classes")
    stripes = F.transform(F.sequence(F.lit(0), F.lit(STRIPES // band - 1)), lambda i: F.struct(
        i.alias("i"), F.substring(F.col("fingerprint"), i * (4 * band) + 1, F.lit(4 * band)).alias("v")))
    left = prints.select("fingerprint", F.explode(stripes).alias("b")).select("fingerprint", "b.i", "b.v")
    left = left.where(F.col("v") != "0" * (4 * band))  # empty stripes are no likeness

    @F.pandas_udf("double")
    def near(a, b):
        import pandas as pd

        return pd.Series([likeness(np.frombuffer(bytes.fromhex(x), ">u2"), np.frombuffer(bytes.fromhex(y), ">u2"))
                          for x, y in zip(a, b, strict=True)], dtype="float64")

    left = cut_lineage(left, "edit-bands")
    leaders = left.groupBy("i", "v").agg(F.min("fingerprint").alias("leader"))
    stars = cut_lineage(join_totals(left, leaders, ["i", "v"]).where("leader <> fingerprint").select("leader", "fingerprint").distinct()
                        .where(near("fingerprint", "leader") >= alike).select(F.col("leader").alias("a"), F.col("fingerprint").alias("b")), "edit-stars")
    first = components(stars)
    grouped = left.join(first, left.fingerprint == first.node, "left").select("i", "v", "fingerprint", F.coalesce("root", "fingerprint").alias("root"))
    grouped = cut_lineage(grouped, "edit-grouped")
    # Pairs within a group change nothing; a bucket of one group is done.
    mixed = (grouped.groupBy("i", "v").agg(F.count("*").alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1"))
             .where("r0 <> r1").select("i", "v", F.ceil(F.col("n") / BUCKET_BLOCK).alias("blocks")))
    dealt = cut_lineage(join_totals(grouped, mixed, ["i", "v"]).withColumn("block", F.pmod(F.xxhash64("fingerprint"), "blocks")), "edit-dealt")
    other = dealt.select("i", "v", F.col("fingerprint").alias("a"), F.col("root").alias("root_a"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    pairs = (dealt.join(other, ["i", "v", "block"]).where("a < fingerprint AND root <> root_a")
             .select("a", F.col("fingerprint").alias("b")).distinct())
    links = stars.unionByName(pairs.where(near("a", "b") >= alike))
    ids = prints.select(F.col("fingerprint"), "rep")
    comp = components(links.distinct())
    rooted = ids.join(comp, ids.fingerprint == comp.node, "left").select("fingerprint", "rep", F.coalesce("root", "fingerprint").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("rep").alias("group"))
    return rows.join(rooted.join(heads, "root").select("fingerprint", "group"), "fingerprint").select("doc_id", "fingerprint", "group")
