"""Quality classifier by importance resampling.

Words and word pairs are hashed into ``2**BITS`` buckets each. Two generative models give every bucket a probability
(counts plus one, normalised): the target model from labelled good documents, the raw model from the whole
corpus. A document's log importance weight is built from the log ratios target / raw of its n-grams. Summed as they
are, weights of long texts would rest on length alone; so the weight is the log odds that a logistic regression, fitted
on labelled documents that the target model has not seen, gives to means and lowest values of the ratios.

Documents are drawn without replacement with these weights by Gumbel top-k: each gets its log weight plus Gumbel noise,
which a hash of its key and the seed fix, and the k highest stay. k defaults to the expected number of target
documents, the sum of the weights' probabilities. The k-th value is found by counting in ever finer bins; no row is
sorted or gathered for it.

Bounds: ``MAX_LABELS`` labelled documents (those with the smallest hashes of their ids) are used for the target model and
the regression; the models are vectors of fixed size. Counts, weights and the draw cover all documents.

Texts that are null or hold no words get no weight and are never drawn; repeated rows get one value and stay or go
together, as do other rows that tie at the k-th value; other columns are ignored; an empty table gives no rows. Without labels of
both kinds the weight is the plain mean log ratio per n-gram (zero without target documents).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev.llm.common import WordCache, doc_key, map_batches, mix64, slices
from lexrev.session import cut_lineage

BITS = 18
MAX_LABELS = 50_000
LOWEST = 8
SEED = 1
_SIZE = 1 << BITS
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")
#: Bytes of words and their hashes that a task keeps.
CACHE_BYTES = 64 << 20
FEATURES = ("mean_word", "mean_pair", "low", "lowest", "log_words", "low_share")


def _hashed(word: str) -> int:
    h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h - (h >> 63 << 64)  # signed


def buckets(text: str, known: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and word pairs of a text; ``known`` keeps the hashes of words seen before."""
    pieces = _WORD.findall(text.lower())
    new = list(known.missing(set(pieces)))
    if new:
        known.add(new, list(map(_hashed, new)))
    h = np.fromiter(map(known.young.__getitem__, pieces), np.int64, len(pieces)).view(np.uint64)
    pairs = mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    return (h & np.uint64(_SIZE - 1)).astype(np.int64), (pairs & np.uint64(_SIZE - 1)).astype(np.int64)


@dataclass
class Labels:
    """Bounded sample of labelled documents: ids of good ones for the target model, and id -> good for the regression."""

    target: set
    held_out: dict


def label_sample(labels: DataFrame, limit: int = MAX_LABELS) -> Labels:
    """``labels(doc_id, quality, toxic)``: a document is good if all its labels say quality 1 and toxic 0."""
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        ((F.min(F.coalesce("quality", F.lit(0))) > 0) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)).alias("good"))
    h = F.xxhash64("doc_id")
    rows = one.select("doc_id", "good", (F.pmod(h, F.lit(3)) == 0).alias("held")).orderBy(h, "doc_id").limit(limit).collect()
    return Labels({r["doc_id"] for r in rows if r["good"] and not r["held"]}, {r["doc_id"]: r["good"] for r in rows if r["held"]})


def ratios(docs: DataFrame, sample: Labels) -> np.ndarray:
    """Log ratios target / raw by (n-gram order, bucket). Only the summed vectors reach the driver."""
    target = docs.sparkSession.sparkContext.broadcast(sample.target)

    def count(batches):
        known = WordCache(CACHE_BYTES)
        total = np.zeros((2, 2, _SIZE), np.int64)
        for b in slices(batches):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t:
                    for order, g in enumerate(buckets(t, known)):
                        n = np.bincount(g, minlength=_SIZE) if len(g) > _SIZE // 64 else None
                        for model in ((0, 1) if i in target.value else (0,)):
                            if n is None:
                                np.add.at(total[model, order], g, 1)
                            else:
                                total[model, order] += n
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 1 << 16):
            part = at[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total.ravel()[part])], names=["cell", "n"])

    def pack(b: pa.RecordBatch):
        cells, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array([cells.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], names=["cells", "n"])

    sums = docs.select("doc_id", "text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(4 * _SIZE)
    for row in map_batches(sums, pack, "cells binary, n binary").toLocalIterator():  # 12 bytes a cell, 4 * 2**BITS cells at most
        flat[np.frombuffer(row["cells"], np.int32)] = np.frombuffer(row["n"], np.int64)
    raw, good = flat.reshape(2, 2, _SIZE)
    if not good.any():
        return np.zeros((2, _SIZE), np.float32)
    share = [np.log((m + 1) / (m.sum(axis=1, keepdims=True) + _SIZE)) for m in (good, raw)]
    return (share[0] - share[1]).astype(np.float32)


def features(text: str | None, ratio: np.ndarray, known: WordCache) -> tuple[float, ...] | None:
    words, pairs = buckets(text or "", known)
    if not len(words):
        return None
    u = ratio[0][words]
    b = ratio[1][pairs]
    distinct = ratio[0][np.unique(words)]
    low = float(np.sort(np.partition(distinct, LOWEST)[:LOWEST] if len(distinct) > LOWEST else distinct).sum())
    three = float(np.sort(np.partition(u, 3)[:3] if len(u) > 3 else u).sum())
    log_n = float(np.log1p(len(words)))
    return float(u.mean()), float(b.mean()) if len(b) else 0.0, low, three, log_n, low / (1 + log_n)


def regression(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Coefficients (intercept first) of a ridge logistic regression by Newton steps, features as they are."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w)), z.T @ (good - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([[w[0] - (w[1:] * mean / scale).sum()], w[1:] / scale])


def scored(docs: DataFrame, ratio: np.ndarray, carry: list[str]) -> DataFrame:
    """``carry`` columns (which must not clash with FEATURES) and the features of every row; null without words."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)  # fixed size: 2 * 2**BITS floats

    @F.pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = WordCache(CACHE_BYTES)
        for s in parts:
            rows = [features(t, sent.value, known) or (None,) * len(FEATURES) for t in s]
            yield pd.DataFrame(rows, columns=list(FEATURES), dtype="float64")

    return docs.select(*carry, udf("text").alias("f")).select(*carry, "f.*")


def log_weight(weights: np.ndarray | None):
    if weights is None:
        return F.col("mean_word") + F.col("mean_pair")
    total = F.lit(float(weights[0]))
    for w, f in zip(weights[1:], FEATURES, strict=True):
        total = total + F.lit(float(w)) * F.col(f)
    return F.when(total.isNotNull(), F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total)))  # both would pass nulls over


def gumbel(seed: int):
    """Standard Gumbel noise fixed by the row's key."""
    u = (F.shiftrightunsigned(F.xxhash64("k_id", "k_hash", F.lit(seed)), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, col: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value of a column, by counting in bins of the range that still holds it."""
    lo, hi, n = values.agg(F.min(col), F.max(col), F.count(col)).first()
    if not n or k <= 0:
        return float("inf")
    if k >= n:
        return lo
    while True:
        width = (hi - lo) / bins
        inside = values.where((F.col(col) >= lo) & (F.col(col) <= hi))
        if not width or lo + width == lo:
            return hi  # neighbouring doubles: k falls among ties
        slot = F.least(F.lit(bins - 1), F.floor((F.col(col) - lo) / width)).cast("int")
        counts = inside.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
        for row in sorted(counts.collect(), key=lambda r: -r["slot"]):  # at most ``bins`` rows
            if k <= row["n"]:
                if k == 1:
                    return row["hi"]
                if row["lo"] == row["hi"]:
                    return row["lo"]
                lo, hi = row["lo"], row["hi"]
                break
            k -= row["n"]


@dataclass
class Draw:
    ratio: np.ndarray
    weights: np.ndarray | None
    threshold: float
    seed: int
    table: DataFrame  # k_id, k_hash, log_weight, score of every row


def draw(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED, max_labels: int = MAX_LABELS) -> Draw:
    """Fit the models on ``docs(doc_id, text)`` and ``labels(doc_id, quality, toxic)`` and draw k documents."""
    spark = docs.sparkSession
    sample = label_sample(labels, max_labels)
    ratio = ratios(docs, sample)
    keyed = docs.select(*doc_key(), F.coalesce("text", F.lit("")).alias("text"))
    table = cut_lineage(scored(keyed, ratio, ["k_id", "k_hash"]), "resample-features")
    weights = None
    if len(set(sample.held_out.values())) == 2:
        held = spark.createDataFrame([(i,) for i in sample.held_out], "k_id long")  # at most max_labels ids
        rows = table.dropna().join(F.broadcast(held), "k_id").dropDuplicates(["k_id"]).toPandas()
        good = np.array([sample.held_out[i] for i in rows["k_id"]], float)
        if len(set(good)) == 2:
            weights = regression(rows[list(FEATURES)].to_numpy(), good)
    table = table.select("k_id", "k_hash", log_weight(weights).alias("log_weight"))
    table = table.withColumn("score", F.col("log_weight") + gumbel(seed))
    if k is None:
        k = round(table.agg(F.sum(1 / (1 + F.exp(-F.col("log_weight"))))).first()[0] or 0)
    return Draw(ratio, weights, kth_largest(table, "score", k), seed, table)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """The drawn rows: doc_id, log_weight, score (with the noise), selected (true)."""
    d = draw(docs, labels, k, seed)
    return d.table.where(F.col("score") >= d.threshold).select(
        F.when(F.col("k_id") != -(2**63), F.col("k_id")).alias("doc_id"), "log_weight", "score", F.lit(True).alias("selected"))


def keep_drawn(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` without the rows that were not drawn; texts are scored again instead of being shuffled."""
    d = draw(docs, labels, k, seed)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    inner = docs.select(*doc_key(), F.coalesce("text", F.lit("")).alias("text"),
                        *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    again = scored(inner, d.ratio, ["k_id", "k_hash", *names]).withColumn("_s", log_weight(d.weights) + gumbel(d.seed))
    return again.where(F.col("_s") >= d.threshold).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
