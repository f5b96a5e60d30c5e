"""Best-fit packing into bins of several permitted sequence lengths.

A text's tokens form pieces of at most the largest capacity. Pieces go, longest first, into the open bin that they fill
best. Where none has room, a bin is opened at the capacity with the least cost per token that it can still
be filled with: a bin of capacity c costs ``overhead`` + c, and fills with the piece and with as much of the shorter pieces
still to come as fits beside it. Finally every bin shrinks to the smallest capacity that holds its contents.

Pieces are dealt into shards of about ``shard`` pieces by a hash that also takes the row's place in the written
length table, so that copies and repeated rows spread evenly; each shard is packed by one task in bounded memory.
A shard has thousands of pieces, so that packing shards alone costs little room (tests compare it with packing in one).

Nulls and empty texts have the end id alone; repeated rows are packed once each; ties go by doc_id, then key; a null doc_id stays
null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev.llm.common import doc_key, slices
from lexrev.llm.records import WordEncoder
from lexrev.session import cut_lineage

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 64
SHARD = 8192


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> list[tuple[int, int]]:
    """Bin and offset of each of ``lengths``, which must be in descending order and fit the largest capacity."""
    caps = sorted(capacities)
    room: dict[int, list[int]] = {}  # open bins by room left
    mask = 0  # bit r is set if some bin has r tokens of room
    sizes: list[int] = []
    used: list[int] = []
    after = np.concatenate([np.cumsum(np.array(lengths[::-1], np.int64))[::-1], [0]])  # tokens from i on
    rising = lengths[::-1]
    out = []
    for i, n in enumerate(lengths):
        fit = mask >> n
        if fit:
            left = n + (fit & -fit).bit_length() - 1
            own = room[left]
            b = own.pop()
            if not own:
                mask &= ~(1 << left)
        else:
            def cost(c: int, i: int = i, n: int = n) -> float:
                # Shorter pieces still to come that fit beside this one.
                first = max(i + 1, len(lengths) - bisect_left(rising, c - n + 1))
                return (overhead + c) / (n + min(c - n, int(after[first])))

            left = min((c for c in caps if c >= n), key=lambda c: (cost(c), c))
            b = len(sizes)
            sizes.append(left)
            used.append(0)
        out.append((b, used[b]))
        used[b] += n
        if left > n:
            room.setdefault(left - n, []).append(b)
            mask |= 1 << (left - n)
    return out


def downsized(contents: int, capacities: tuple[int, ...]) -> int:
    return min(c for c in capacities if c >= contents)


def token_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """k_id, k_hash, n_tokens (with an end id) of every row of ``docs(doc_id, text)``."""
    def run(batches):
        counter = WordEncoder(tokenizer)
        for b in slices(batches):
            n = counter.count_all(b.column(2)) + 1
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["k_id", "k_hash", "n_tokens"])

    return docs.select(*doc_key(), "text").mapInArrow(run, "k_id long, k_hash long, n_tokens long")


PACKED = "k_id long, k_hash long, piece long, start long, length long, bin_id long, capacity long, offset long"


def pack_lengths(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, shard: int = SHARD) -> DataFrame:
    """Pack the pieces of ``lengths(k_id, k_hash, n_tokens)``, a written table."""
    top = max(capacities)
    pieces = (lengths.withColumn("row", F.monotonically_increasing_id())
              .withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"cast(greatest(n_tokens - 1, 0) div {top} as int)"))))
              .selectExpr("k_id", "k_hash", "row", "cast(piece as long) AS piece", f"cast(piece as long) * {top} AS start",
                          f"least(n_tokens - cast(piece as long) * {top}, {top}) AS length"))
    total = lengths.agg(F.sum(F.expr(f"greatest(n_tokens - 1, 0) div {top} + 1"))).first()[0] or 0
    shards = max(1, round(total / shard))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "k_id", "k_hash", "row", "piece"], ascending=[False, True, True, True, True])
        placed = pack(pdf["length"].tolist(), capacities, overhead)
        bins = np.array([b for b, _ in placed])
        filled = np.bincount(bins, weights=pdf["length"].to_numpy()).astype(np.int64)
        pdf["bin_id"] = (int(key[0]) << 32) + bins
        pdf["capacity"] = np.array([downsized(int(n), capacities) for n in filled])[bins]
        pdf["offset"] = [o for _, o in placed]
        return pdf[["k_id", "k_hash", "piece", "start", "length", "bin_id", "capacity", "offset"]]

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("k_id", "k_hash", "row", "piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> DataFrame:
    """Pack every row of ``docs(doc_id, text)``.

    Returns doc_id, piece, start and length (the piece's tokens in the document), bin_id, capacity (of the bin, after
    downsizing), offset (of the piece in the bin).
    """
    lengths = cut_lineage(token_lengths(docs, tokenizer), "lengths")
    return pack_lengths(lengths, capacities, overhead).select(
        F.when(F.col("k_id") != -(2**63), F.col("k_id")).alias("doc_id"), "piece", "start", "length", "bin_id", "capacity", "offset")
