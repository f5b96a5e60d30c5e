"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexrev.session import cut_lineage

ASCII_UPPER = bytes(range(65, 91))
ASCII_LOWER = bytes(range(97, 123))
LOWER_TABLE = bytes.maketrans(ASCII_UPPER, ASCII_LOWER)

#: Documents are handed to Python in batches of at most about this many bytes of text.
BATCH_BYTES = 4 << 20


def ascii_lower(s: str) -> str:
    """Lower-case A-Z only (str.lower() would also fold other scripts)."""
    return s.encode("utf-8", "surrogatepass").translate(LOWER_TABLE).decode("utf-8", "surrogatepass")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def utf8_rows(col: pa.Array) -> Iterator[bytes]:
    """The values of a string column as UTF-8 bytes, null as empty, without building Python strings."""
    col = col.cast(pa.binary()) if not pa.types.is_binary(col.type) else col
    for v in col:
        yield (v.as_buffer().to_pybytes() if v.is_valid else b"")


def bounded_batches(spark: SparkSession) -> None:
    """Have Spark cut its Arrow batches at ``BATCH_BYTES``.

    At its default (64 MB) each task holds several such buffers, in the JVM beside its heap and in Python, which texts fill.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``BATCH_BYTES`` (a longer row is a batch of its own)."""
    for b in batches:
        mean = max(1, b.nbytes // max(1, b.num_rows))
        step = max(1, BATCH_BYTES // mean)
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with one function call per Arrow batch; ``None`` yields nothing."""

    def run(batches):
        for b in slices(batches):
            out = fn(b)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


class WordCache:
    """Values of words, bounded in bytes: two generations, of which the older goes when the younger is full.

    Words in use move to the younger one, so frequent words stay and words seen once go. A task makes its own
    cache, which ends with it. ``WORD_BYTES`` is what an entry takes beside its word's letters.
    """

    WORD_BYTES = 220

    def __init__(self, limit: int):
        self.limit = limit // 2
        self.young: dict = {}
        self.old: dict = {}
        self.used = 0

    def _count(self, words) -> None:
        self.used += sum(map(len, words)) + self.WORD_BYTES * len(words)

    def values(self, words: list) -> tuple[list, list[int]]:
        """The values of distinct words (``None`` without one), and the places of those without."""
        if self.used > self.limit:
            self.old, self.young, self.used = self.young, {}, 0
        out = list(map(self.young.get, words))
        without = [i for i, v in enumerate(out) if v is None]
        if self.old and without:
            back = []
            for i in without:
                out[i] = self.old.get(words[i])
                if out[i] is not None:
                    back.append(i)
            self.add([words[i] for i in back], [out[i] for i in back])
            without = [i for i in without if out[i] is None]
        return out, without

    def missing(self, words: set) -> set:
        """The words without a value; all others are in ``young`` until the next call."""
        if self.used > self.limit:
            self.old, self.young, self.used = self.young, {}, 0
        new = words.difference(self.young)
        if self.old and new:
            back = [w for w in new if w in self.old]
            self.add(back, list(map(self.old.__getitem__, back)))
            new.difference_update(back)
        return new

    def add(self, words: list, values) -> None:
        self.young.update(zip(words, values, strict=True))
        self._count(words)


def doc_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """A key of a document row that is never null: its id (null: the smallest long) and a hash of its text.

    Rows that agree in both are repeated rows: every operator gives them equal results.
    """
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("k_id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k_hash")]


def join_totals(rows: DataFrame, totals: DataFrame, on: list[str]) -> DataFrame:
    """Join rows to what was aggregated over them, so that a hot key is not bound to one task.

    Joined directly, the aggregate's own exchange would be reused and adaptive execution could not split
    a hot key of the other side. A written table gives the join two exchanges of its own.
    """
    return rows.join(cut_lineage(totals, "totals"), on)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit integers."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))
