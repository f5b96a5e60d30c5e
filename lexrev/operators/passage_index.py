"""Inverted index of a passage library, kept between jobs.

An index is a folder of tables: ``postings`` (a row per passage and term: the TF-IDF weight, the passage's norm, the term's idf), dealt
into blocks of about ``max_postings`` postings by a hash of the passage, ``vocabulary`` (term, idf), dealt into blocks of about ``MAX_TERMS`` terms, ``passages`` (the
library itself) and ``meta`` (version and sizes). A library of any size is built and searched; only blocks of bounded size are ever sent.

A search sends one block at a time and scores every document in the task that reads it. In a block, a term's postings stand by falling
impact (weight by norm) in runs of ``RUN``; a run's first impact bounds it. For a document, runs are taken by falling bound until the
runs left cannot lift any passage into the k best; the passages that may still be among them are then scored in full. The rows are those of
scoring every posting. Documents whose terms have few postings are scored plainly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.session import broadcast_if_small, cut_lineage

VERSION = 1
TOKEN_REGEX = "[\\p{L}\\p{N}]+"
#: Postings (about 40 bytes each) sent to the tasks at a time.
MAX_POSTINGS = 4_000_000
#: Terms of the vocabulary sent at a time, to add up the documents' norms of an index of several blocks.
MAX_TERMS = 1_000_000
#: Postings of a run.
RUN = 64
#: Documents whose terms have so few postings are scored without bounds.
PLAIN = 4096
#: Scores are rounded to six places; bounds keep this much (as a score) apart.
_MARGIN = 2e-6


def tokens(text) -> F.Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(X.py_regex(TOKEN_REGEX)), 0)


def passage_vectors(passages: DataFrame, key: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """TF-IDF weights of a passage library: idf = 1 + ln((1+N)/(1+df))."""
    n_pass = passages.select(key).distinct().count()
    terms = X.explode_rows(passages, [key], tokens(F.col(text_col)), "term")
    tf = terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("term", (F.lit(1.0) + F.log((F.lit(1.0) + F.lit(float(n_pass))) / (F.lit(1.0) + F.col("df"))))
                    .alias("idf"))
    return tf.join(idf, "term").select(key, "term", "idf", (F.col("tf") * F.col("idf")).alias("w"))


@dataclass(frozen=True)
class PassageIndex:
    spark: SparkSession
    path: str
    key: str
    blocks: int
    vocabulary_blocks: int
    n_passages: int
    n_postings: int

    @property
    def passages(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/passages")

    @property
    def postings(self) -> DataFrame:
        key = self.passages.schema[self.key]
        fields = [T.StructField(n, t) for n, t in (("term", T.StringType()), ("idf", T.DoubleType()), ("w", T.DoubleType()),
                                                   ("norm", T.DoubleType()), ("block", T.IntegerType()))]
        return self.spark.read.schema(T.StructType([T.StructField(key.name, key.dataType), *fields])).parquet(f"{self.path}/postings")

    @property
    def vocabulary(self) -> DataFrame:
        return self.spark.read.schema("term string, idf double, block int").parquet(f"{self.path}/vocabulary")


def build_index(passages: DataFrame, path: str, key: str = "chunk_id", text_col: str = "text",
                max_postings: int = MAX_POSTINGS, max_terms: int = MAX_TERMS) -> PassageIndex:
    """Write the index of ``passages`` (whose key is unique; rows without one are left out) to ``path``."""
    spark = passages.sparkSession
    library = passages.where(F.col(key).isNotNull())
    library.write.mode("overwrite").parquet(f"{path}/passages")
    library = spark.read.parquet(f"{path}/passages")
    pv = cut_lineage(passage_vectors(library, key, text_col), "passage-vectors")
    n_postings, n_terms = pv.agg(F.count("*"), F.approx_count_distinct("term")).first()
    blocks, term_blocks = max(1, math.ceil(n_postings / max_postings)), max(1, math.ceil(n_terms / max_terms))
    norms = pv.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    rows = pv.join(norms, key).withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    (rows.repartition("block", F.pmod(F.xxhash64("term"), F.lit(16))).sortWithinPartitions("block", "term", F.desc(F.col("w") / F.col("norm")))
     .write.mode("overwrite").partitionBy("block").parquet(f"{path}/postings"))
    vocabulary = pv.groupBy("term").agg(F.max("idf").alias("idf")).withColumn(
        "block", F.pmod(F.xxhash64("term"), F.lit(term_blocks)).cast("int"))
    vocabulary.repartition("block").write.mode("overwrite").partitionBy("block").parquet(f"{path}/vocabulary")
    meta = [(VERSION, key, blocks, term_blocks, library.count(), n_postings)]
    spark.createDataFrame(meta, _META).coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return open_index(spark, path)


_META = "version int, key string, blocks int, vocabulary_blocks int, passages long, postings long"


def open_index(spark: SparkSession, path: str) -> PassageIndex:
    """An index written before; one of another version is refused, as it must be built again."""
    m = spark.read.schema(_META).json(f"{path}/meta").first()
    if m is None or m["version"] != VERSION:
        raise ValueError(f"{path} holds no passage index of version {VERSION}")
    return PassageIndex(spark, path, m["key"], m["blocks"], m["vocabulary_blocks"], m["passages"], m["postings"])


@dataclass
class Block:
    """Postings of a block: those of term i are at ``start[i]:start[i + 1]``, by falling impact."""

    terms: pa.Array
    idf: np.ndarray
    start: np.ndarray
    passage: np.ndarray
    weight: np.ndarray
    keys: pa.Array
    norm: np.ndarray
    run_start: np.ndarray  # of each run its first posting, and one after the last
    run_bound: np.ndarray
    first_run: np.ndarray  # of each term, and one after the last
    pairs: np.ndarray  # (term, passage) as one number, rising
    pair_weight: np.ndarray

    def best(self, codes: np.ndarray, k: int, norm: float | None) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Passages (in key order) and scores of the k most alike ones to a document of these terms; postings touched, and all."""
        ids, tf = np.unique(codes[codes >= 0], return_counts=True)
        w = tf * self.idf[ids]
        norm = math.sqrt((w * w).sum()) if norm is None else norm
        n = self.start[ids + 1] - self.start[ids]
        total = int(n.sum())
        if total <= PLAIN:
            at = np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(total)
            dots = np.bincount(self.passage[at], weights=np.repeat(w, n) * self.weight[at], minlength=len(self.keys))
            hit = np.flatnonzero(dots)
            dots, touched = dots[hit], total
        else:
            hit, touched = self._candidates(ids, w, k, norm, total)
            dots = self._dots(ids, w, hit)
            touched += len(ids) * len(hit)
        score = np.floor(dots / (norm * self.norm[hit]) * 1e6 + 0.5) / 1e6
        top = np.lexsort((hit, -score))[:k]
        return hit[top], score[top], touched, total

    def _candidates(self, ids: np.ndarray, w: np.ndarray, k: int, norm: float, total: int) -> tuple[np.ndarray, int]:
        """Passages that may be among the k best, and the postings read to find them."""
        n = self.first_run[ids + 1] - self.first_run[ids]
        runs = np.repeat(self.first_run[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        term = np.repeat(np.arange(len(ids)), n)
        bound = w[term] * self.run_bound[runs]
        order = np.argsort(-bound, kind="stable")
        runs, term, bound = runs[order], term[order], bound[order]
        length = self.run_start[runs + 1] - self.run_start[runs]
        read = np.cumsum(length)
        got = np.zeros(len(self.keys))
        done, share = 0, total // 8
        while True:
            stop = len(runs) if share >= total else int(np.searchsorted(read, share)) + 1
            size = length[done:stop]
            at = np.repeat(self.run_start[runs[done:stop]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            p = self.passage[at]
            got += np.bincount(p, weights=np.repeat(w[term[done:stop]], size) * self.weight[at] / self.norm[p], minlength=len(got))
            done = stop
            # What the runs left can add to a passage: of each term, its next run's bound.
            _, next_run = np.unique(term[done:], return_index=True)
            rest = float(bound[done:][next_run].sum())
            kth = float(np.partition(got, len(got) - k)[len(got) - k]) if len(got) > k else 0.0
            if done == len(runs) or rest < kth - _MARGIN * norm:
                return np.flatnonzero((got > 0) & (got >= kth - rest - _MARGIN * norm)), int(read[done - 1])
            share *= 2

    def _dots(self, ids: np.ndarray, w: np.ndarray, passages: np.ndarray) -> np.ndarray:
        """Full scores of some passages, added up term by term."""
        out = np.zeros(len(passages))
        for lo in range(0, len(passages), 2048):
            own = passages[lo:lo + 2048]
            want = ids.astype(np.int64)[:, None] * len(self.keys) + own[None, :]
            at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
            value = np.where(self.pairs[at] == want, self.pair_weight[at], 0.0) * w[:, None]
            for row in value:
                out[lo:lo + 2048] += row
        return out


def _block(rows: pa.Table) -> Block:
    """A block from its rows (passage key, term, idf, weight, norm)."""
    key, term = (rows.column(i).combine_chunks() for i in (0, 1))
    idf, weight, norm = (rows.column(i).to_numpy() for i in (2, 3, 4))
    keys = pc.unique(key)
    keys = keys.take(pc.sort_indices(keys))
    terms = pc.unique(term)
    p = pc.index_in(key, value_set=keys).to_numpy()
    t = pc.index_in(term, value_set=terms).to_numpy()
    order = np.lexsort((p, -weight / norm, t))
    p, t, weight, norm, idf = p[order], t[order].astype(np.int64), weight[order], norm[order], idf[order]
    n = np.bincount(t, minlength=len(terms))
    start = np.concatenate([[0], np.cumsum(n)])
    runs = -(-n // RUN)
    first_run = np.concatenate([[0], np.cumsum(runs)])
    of = np.repeat(np.arange(len(terms)), runs)
    run_start = start[of] + (np.arange(len(of)) - first_run[of]) * RUN
    by_passage = np.zeros(len(keys))
    by_passage[p] = norm
    by_term = np.zeros(len(terms))
    by_term[t] = idf
    pairs = t * len(keys) + p
    rising = np.argsort(pairs, kind="stable")
    bound = weight[run_start] / norm[run_start] if len(of) else np.zeros(0)
    return Block(terms, by_term, start, p.astype(np.int32), weight, keys, by_passage, np.append(run_start, len(t)), bound, first_run,
                 pairs[rising], weight[rising])


def _with_norms(docs: DataFrame, index: PassageIndex) -> DataFrame:
    """(key, tokens) with the documents' norms over the whole vocabulary, a block of terms at a time."""
    spark = index.spark
    schema = T.StructType([*docs.schema.fields, T.StructField("norm2", T.DoubleType())])
    out = docs.withColumn("norm2", F.lit(0.0))
    for i in range(index.vocabulary_blocks):
        rows = index.vocabulary.where(F.col("block") == i).select("term", "idf").toArrow()
        sent = spark.sparkContext.broadcast((rows.column(0).combine_chunks(), rows.column(1).to_numpy()))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            terms, idf = sent.value
            for b in batches:
                n2 = b.column(2).to_numpy(zero_copy_only=False).copy()
                for j, codes in enumerate(_codes(b.column(1), terms)):
                    ids, tf = np.unique(codes[codes >= 0], return_counts=True)
                    n2[j] += ((tf * idf[ids]) ** 2).sum()
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n2)], names=schema.fieldNames())

        out = cut_lineage(out.mapInArrow(run, schema), "document-norms")
    return out


def _codes(lists: pa.Array, terms: pa.Array) -> list[np.ndarray]:
    """The terms of each row as places in ``terms`` (-1: not among them)."""
    if not len(lists):
        return []
    flat = lists.flatten()
    codes = pc.fill_null(pc.index_in(flat, value_set=terms), -1).to_numpy() if len(terms) else np.full(len(flat), -1)
    return np.split(codes, np.cumsum(pc.list_value_length(lists).to_numpy())[:-1])


def related(docs: DataFrame, index: PassageIndex, k: int = RP.RETRIEVE_K, key: str = "doc_id", text_col: str = "text",
            touched: bool = False) -> DataFrame:
    """The k passages most alike to every document row by TF-IDF cosine: key, rank, the passage's key, score.

    ``touched`` adds, to every row, the postings read for its document in the passage's block, and all that its terms have there.
    """
    spark = index.spark
    pkey = index.postings.schema[index.key]
    extra = [T.StructField("touched", T.LongType()), T.StructField("postings", T.LongType())] if touched else []
    schema = T.StructType([docs.schema[key], T.StructField("rank", T.LongType()), T.StructField(pkey.name, pkey.dataType),
                           T.StructField("score", T.DoubleType()), *extra])
    prepared = docs.select(key, tokens(F.col(text_col)).alias("tokens"))
    if index.blocks > 1:  # a block's vocabulary is not the whole one then
        prepared = _with_norms(prepared, index)
    found = None
    for i in range(index.blocks):
        rows = index.postings.where(F.col("block") == i).select(index.key, "term", "idf", "w", "norm").toArrow()
        sent = spark.sparkContext.broadcast(_block(rows))  # about max_postings postings

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            p = sent.value
            for b in batches:
                norms = [math.sqrt(x) for x in b.column(2).to_pylist()] if b.num_columns > 2 else [None] * b.num_rows
                best = [p.best(c, k, norm) for c, norm in zip(_codes(b.column(1), p.terms), norms, strict=True)]
                n = [len(hit) for hit, *_ in best]
                if sum(n):
                    counts = [pa.array(np.repeat([x[j] for x in best], n)) for j in (2, 3)] if touched else []
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))),
                         pa.array(np.concatenate([np.arange(1, m + 1) for m in n])),
                         p.keys.take(pa.array(np.concatenate([hit for hit, *_ in best]))),
                         pa.array(np.concatenate([x[1] for x in best])), *counts], names=schema.fieldNames())

        part = prepared.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if index.blocks > 1:
        w = Window.partitionBy(key).orderBy(F.desc("score"), index.key)
        found = found.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
    return found


def references(docs: DataFrame, index: PassageIndex, k: int = RP.RETRIEVE_K, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document with related passages: key, related_references (passage key, content, relevance, score; best first)."""
    rows = related(docs, index, k, key, text_col)
    content = index.passages.select(F.col(index.key).alias("_passage"), F.col("text").alias("content"))
    rows = rows.join(broadcast_if_small(content), F.col(index.key) == F.col("_passage"))
    one = F.struct("rank", F.col(index.key).cast("string").alias("passage"), "content", F.lit("high").alias("relevance"), "score")
    listed = F.transform(F.array_sort(F.collect_list(one)), lambda r: F.struct(
        r["passage"].alias("passage"), r["content"].alias("content"), r["relevance"].alias("relevance"), r["score"].alias("score")))
    return rows.groupBy(key).agg(listed.alias("related_references"))


REFERENCES_TYPE = "array<struct<passage:string,content:string,relevance:string,score:double>>"
