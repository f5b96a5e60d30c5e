"""Ranked lexical search by dense blocked matrix products.

The queries' distinct terms are the vocabulary. A first pass over the documents counts, of each document, its terms and
the occurrences of vocabulary terms, and writes these counts; a sum over them gives the statistics of the whole
corpus (documents with terms, all terms, documents per vocabulary term), which fix integer weights of terms and integer impacts of
terms in documents. A second pass reads the counts in tiles of documents: dense tiles (documents x vocabulary) of
impacts are multiplied with dense tiles (vocabulary x queries) of weights in float64 by BLAS. A vocabulary tile has so few terms that
no partial sum can reach 2^53, so each product is exact in any order of addition; products are added up as 64-bit integers.

Each tile of documents hands on, for every query, its k best ones by (score, smaller doc_id), held against the best k that the task has
seen; equal scores at the k-th place are decided by doc_id, never by place. Only these reach the shuffle, which merges them in two
steps (query and a slot of the document, then query), so that a query's candidates are not bound to one task.

Queries are taken in blocks of at most ``BLOCK_BYTES`` bytes of text and are the only thing that is sent; a further block takes
further passes.

Texts that are null or hold no terms match nothing and count in no statistic; a null doc_id stands before all others in
ties; repeated rows are ranked once each; queries of no terms have no rows; repeated queries count once, and queries of one id with other
texts are ranked each for itself; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lexrev.llm.common import map_batches, slices, utf8_rows
from lexrev.llm.positions import words_of
from lexrev.session import cut_lineage

TOP = 10
BLOCK_BYTES = 16 << 20
#: Sides of the tiles: documents, vocabulary, queries.
DOC_TILE, TERM_TILE, QUERY_TILE = 1024, 2048, 512
#: Slots of the first merging step.
SLOTS = 64
IMPACT_BOUND = 1_000_000
NO_ID = -(2**63)


def query_blocks(queries: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The queries (id, distinct terms) in blocks of bounded size; those without terms are left out."""
    block, size = [], 0
    for row in queries.select(id_col, text_col).distinct().toLocalIterator():
        terms = sorted(set(words_of((row[1] or "").encode("utf-8", "surrogatepass"))))
        if terms:
            block.append((row[0], terms))
            size += sum(map(len, terms)) + 64
            if size >= block_bytes:
                yield block
                block, size = [], 0
    if block:
        yield block


COUNTS = "doc_id long, n long, codes binary, occurrences binary"


def term_counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Of every row of ``docs(doc_id, text)``: its number of terms, and codes and occurrences of vocabulary terms in it."""
    sent = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})  # at most BLOCK_BYTES

    def run(batches):
        code = sent.value
        for b in slices(batches):
            n, codes, occurrences = [], [], []
            for raw in utf8_rows(b.column(1)):
                words = words_of(raw)
                n.append(len(words))
                own, tf = np.unique(np.array([c for c in map(code.get, words) if c is not None], np.uint32), return_counts=True)
                codes.append(own.astype("<u4").tobytes())
                occurrences.append(tf.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(codes, pa.binary()), pa.array(occurrences, pa.binary())],
                names=["doc_id", "n", "codes", "occurrences"])

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    return keyed.mapInArrow(run, COUNTS)


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of ``size`` vocabulary terms; no more rows than terms reach the driver."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in slices(batches):
            for codes in utf8_rows(b.column(0)):
                total[np.frombuffer(codes, "<u4")] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["code", "n"])

    out = np.zeros(size, np.int64)
    for row in counts.select("codes").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["code"]] = row["n"]
    return out


def term_weights(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2 * documents + 2) / (2 * frequency + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in frequencies], np.int64)


@dataclass
class Queries:
    """A block of queries as a sparse matrix: the vocabulary codes of query i are ``codes[start[i]:start[i + 1]]``, rising."""

    ids: list
    start: np.ndarray
    codes: np.ndarray
    weights: np.ndarray  # of every vocabulary term
    n_docs: int
    n_terms: int

    def term_tile(self) -> int:
        """Vocabulary terms of a tile: all their weighted impacts together stay below 2^53."""
        most = max(1, int(self.weights.max(initial=1)))
        return max(1, min(TERM_TILE, (2**53 - 1) // (IMPACT_BOUND * most)))

    def tile(self, queries: slice, terms: slice) -> np.ndarray | None:
        """Weights (vocabulary x queries) of a tile; None if it is empty."""
        lo, hi = self.start[queries.start], self.start[queries.stop]
        codes = self.codes[lo:hi]
        column = np.repeat(np.arange(queries.stop - queries.start), np.diff(self.start[queries.start:queries.stop + 1]))
        inside = (codes >= terms.start) & (codes < terms.stop)
        if not inside.any():
            return None
        out = np.zeros((terms.stop - terms.start, queries.stop - queries.start))
        out[codes[inside] - terms.start, column[inside]] = self.weights[codes[inside]]
        return out


def impacts(occurrences: np.ndarray, n: np.ndarray, q: Queries) -> np.ndarray:
    """Integer impacts of terms that occur so often in documents of ``n`` terms."""
    m = 10 + (90 * n * q.n_docs) // max(1, q.n_terms)
    return (1_000_000_000 * occurrences) // (1000 * occurrences + 8 * m)


def scores(q: Queries, n: np.ndarray, row: np.ndarray, codes: np.ndarray, occurrences: np.ndarray, queries: slice) -> np.ndarray:
    """Scores (documents x queries) of a tile of documents, whose terms are (row, code, occurrences)."""
    total = np.zeros((len(n), queries.stop - queries.start), np.int64)
    value = impacts(occurrences, n[row], q)
    step = q.term_tile()
    for lo in range(0, len(q.weights), step):
        terms = slice(lo, min(lo + step, len(q.weights)))
        weights = q.tile(queries, terms)
        inside = (codes >= terms.start) & (codes < terms.stop)
        if weights is None or not inside.any():
            continue
        own = np.zeros((len(n), terms.stop - terms.start))
        own[row[inside], codes[inside] - terms.start] = value[inside]
        total += (own @ weights).astype(np.int64)
    return total


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0, equal ones by rising id."""
    at = np.flatnonzero(score > 0)
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= least]  # all that tie with the k-th
    return at[np.lexsort((ids[at], -score[at]))][:k]


def rank_block(counts: DataFrame, q: Queries, id_type: T.DataType, k: int) -> DataFrame:
    """The k best documents that each task finds for every query: place of the query, its id, doc_id, score."""
    sent = counts.sparkSession.sparkContext.broadcast(q)  # the block's weights and codes

    def run(batches):
        q = sent.value
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q.ids)
        for whole in batches:
            for at in range(0, whole.num_rows, DOC_TILE):
                b = whole.slice(at, DOC_TILE)
                ids, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                own = [np.frombuffer(x, "<u4") for x in utf8_rows(b.column(2))]
                tf = np.frombuffer(b"".join(utf8_rows(b.column(3))), "<u4").astype(np.int64)
                row = np.repeat(np.arange(b.num_rows), [len(x) for x in own])
                codes = np.concatenate(own).astype(np.int64)
                for lo in range(0, len(q.ids), QUERY_TILE):
                    queries = slice(lo, min(lo + QUERY_TILE, len(q.ids)))
                    tile = scores(q, n, row, codes, tf, queries)
                    for i in range(queries.start, queries.stop):
                        seen, seen_scores = found[i]
                        column = tile[:, i - lo]
                        if len(seen) == k:
                            some = np.flatnonzero(column >= seen_scores[-1])  # a tie may have a smaller id
                            if not len(some):
                                continue
                        else:
                            some = np.flatnonzero(column)
                        both, both_scores = np.append(seen, ids[some]), np.append(seen_scores, column[some])
                        top = best(both, both_scores, k)
                        found[i] = both[top], both_scores[top]
        n = [len(x) for x, _ in found]
        place = np.repeat(np.arange(len(found)), n)
        if len(place):
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(q.ids, to_arrow_type(id_type)).take(pa.array(place)),
                 pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([x for _, x in found]))],
                names=["query", "id", "doc_id", "score"])

    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("id", id_type),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    return counts.mapInArrow(run, schema)


def rank(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of ``docs(doc_id, text)`` for each of ``queries``: the query's id, rank, doc_id, score."""
    id_type = queries.schema[id_col].dataType
    found = None
    for number, block in enumerate(query_blocks(queries, id_col, text_col, block_bytes)):
        vocabulary = sorted({t for _, terms in block for t in terms})
        code = {t: i for i, t in enumerate(vocabulary)}
        counts = cut_lineage(term_counts(docs, vocabulary).where("n > 0"), "term-counts")
        n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        q = Queries([i for i, _ in block], np.cumsum([0, *(len(t) for _, t in block)]),
                    np.array([code[t] for _, terms in block for t in terms], np.int64),
                    term_weights(document_frequencies(counts, len(vocabulary)), n_docs), n_docs, n_terms)
        part = rank_block(counts.where(F.length("codes") > 0), q, id_type, k).withColumn("block", F.lit(number))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("query", T.LongType()), T.StructField("id", id_type), T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()), T.StructField("block", T.IntegerType())]))

    def top(df: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    few = top(found.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))), "block", "query", "slot").drop("rank", "slot")
    return top(few, "block", "query").select(F.col("id").alias(id_col), "rank",
                                 F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
