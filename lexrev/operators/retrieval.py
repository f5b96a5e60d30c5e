"""Knowledge retrieval.

* ``chunk_text``: fixed windows (size 1000, step size-overlap) cut in one pass over the text.
* ``knn``: exact nearest vectors of a stated query set, which is sent in blocks; each task keeps the k nearest of
  every batch, so only those reach the shuffle that merges them.
* ``split_text``: pieces between separators (blank lines, lines, blanks), merged up to the size with overlap.
* ``related_passages``: TF-IDF cosine through the inverted index of ``passage_index``: no shuffle, no pair rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.operators import passage_index as PI
from lexrev.session import scratch_path

#: Queries sent to the tasks at a time; further blocks take further passes over the vectors.
QUERY_BLOCK = 1000
#: Vectors whose distances to a block of queries are held at a time.
VECTOR_ROWS = 1024


def chunk_text(docs: DataFrame, size: int = RP.CHUNK_SIZE, overlap: int = RP.CHUNK_OVERLAP,
               key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Windows of ``size`` characters starting every ``size - overlap``; each keeps its source key.

    The text is cut once into blocks of the greatest common divisor of size and step; a window is a run of
    adjacent blocks.  That is linear in the text, which does not travel through the explode.
    """
    step = size - overlap
    block = math.gcd(size, step)
    t = F.coalesce(F.col(text_col), F.lit(""))
    n = F.length(t)
    n_chunks = F.when(n > 0, F.ceil(F.greatest(n - F.lit(overlap), F.lit(1)) / F.lit(step)).cast("int")).otherwise(0)
    d = docs.select(key, F.regexp_extract_all(t, F.lit(f"(?s).{{1,{block}}}"), F.lit(0)).alias("_blocks"),
                    n_chunks.alias("_n"))
    blocks = F.col("_blocks")
    windows = F.when(X.pinned(blocks), F.transform(X.seq0(F.col("_n")), lambda i: F.array_join(
        F.slice(blocks, i * (step // block) + 1, size // block), "")))
    return X.explode_rows(d, [key], windows, "text", pos="chunk_no").select(
        key,
        F.col("chunk_no").cast("long").alias("chunk_no"),
        (F.col("chunk_no").cast("long") * step).alias("start"),
        "text",
    )


#: From the coarsest on; the last one parts characters.
SEPARATORS = ("\n\n", "\n", " ", "")


def _pieces(text: str, start: int, end: int, separator: str) -> Iterator[tuple[int, int]]:
    """Spans of ``text[start:end]`` that begin with the separator (but for the first), none of them empty."""
    if not separator:
        yield from ((i, i + 1) for i in range(start, end))
        return
    at = start
    while True:
        found = text.find(separator, at + len(separator) if at > start or text.startswith(separator, start) else at, end)
        if found < 0:
            break
        if found > at:
            yield at, found
        at = found
    if end > at:
        yield at, end


def _merged(pieces: list[tuple[int, int]], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Adjacent spans merged up to ``size``; the next one goes back over whole pieces of at most ``overlap`` together."""
    first = 0
    for i, (start, end) in enumerate(pieces):
        if first < i and end - pieces[first][0] > size:
            yield pieces[first][0], start
            while first < i and (start - pieces[first][0] > overlap or end - pieces[first][0] > size):
                first += 1
    if pieces:
        yield pieces[first][0], pieces[-1][1]


def split_spans(text: str, size: int = RP.CHUNK_SIZE, overlap: int = RP.CHUNK_OVERLAP,
                separators: tuple[str, ...] = SEPARATORS) -> Iterator[tuple[int, int]]:
    """Spans of the chunks of a text, before white space at their ends is left out.

    A text is cut at the coarsest separator that it holds. Pieces below ``size`` are merged; a longer one is cut
    at the next finer separators by itself. Linear in the text, as every separator is searched for once in a piece.
    """
    def spans(start: int, end: int, level: int) -> Iterator[tuple[int, int]]:
        while separators[level] and text.find(separators[level], start, end) < 0 and level + 1 < len(separators):
            level += 1
        small: list[tuple[int, int]] = []
        for piece in _pieces(text, start, end, separators[level]):
            if piece[1] - piece[0] < size:
                small.append(piece)
                continue
            yield from _merged(small, size, overlap)
            small = []
            if level + 1 < len(separators):
                yield from spans(*piece, level + 1)
            else:
                yield piece
        yield from _merged(small, size, overlap)

    if text:
        yield from spans(0, len(text), 0)


def split_text(docs: DataFrame, size: int = RP.CHUNK_SIZE, overlap: int = RP.CHUNK_OVERLAP, key: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Chunks cut at separators, coarsest first; each keeps its source key: key, chunk_no, start, text.

    White space at a chunk's ends is left out, and chunks of nothing else are; ``start`` is where the rest begins (code points).
    """
    schema = T.StructType([docs.schema[key], T.StructField("chunk_no", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, number, start, chunks = [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                n = 0
                for lo, hi in split_spans(text or "", size, overlap):
                    whole = text[lo:hi]
                    chunk = whole.strip()
                    if chunk:
                        row.append(i)
                        number.append(n)
                        start.append(lo + len(whole) - len(whole.lstrip()))
                        chunks.append(chunk)
                        n += 1
            if row:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(number), pa.array(start), pa.array(chunks, pa.string())],
                    names=[key, "chunk_no", "start", "text"])

    return docs.select(key, text_col).mapInArrow(run, schema)


def squared_l2(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Squared distances, a row per query; summed dimension by dimension, so that blocks of any shape agree."""
    total = np.zeros((len(queries), len(vectors)))
    for q, v in zip(queries.T, vectors.T, strict=True):
        total += (q[:, None] - v[None, :]) ** 2
    return total


def _nearest(vectors: DataFrame, rows: list, k: int, names: list[str], schema: T.StructType) -> DataFrame:
    """The k nearest vectors in each batch of every query of ``rows(id, vector)``."""
    ids = pa.array([r[0] for r in rows], to_arrow_type(schema[0].dataType))
    sent = vectors.sparkSession.sparkContext.broadcast(np.array([r[1] for r in rows], np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, VECTOR_ROWS):
                b = whole.slice(at, VECTOR_ROWS)
                b = b.take(pc.sort_indices(b.column(0)))  # ties go by id
                v = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                d = squared_l2(queries, v)
                best = np.argsort(d, axis=1, kind="stable")[:, :k]
                q = np.repeat(np.arange(len(queries)), best.shape[1])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(q)), b.column(0).take(pa.array(best.ravel())),
                                                  pa.array(d[q, best.ravel()])], names=names)

    return vectors.mapInArrow(run, schema)


def knn(queries: DataFrame, vectors: DataFrame, k: int = RP.RETRIEVE_K, qid: str = "query_id",
        vid: str = "vec_id", qvec: str = "query_vec", vvec: str = "embedding",
        block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` nearest vectors (squared L2, ties by id) of every query; every hit is labelled 'high'.

    Queries are sent ``block`` at a time, each block in one pass over the vectors; there is no limit to their number.
    Vectors that are null or of another length than the queries have no distance.
    """
    schema = T.StructType([queries.schema[qid], vectors.schema[vid], T.StructField("distance", T.DoubleType())])
    found = vectors.sparkSession.createDataFrame([], schema)
    for rows in batched(queries.select(qid, qvec).where(F.col(qvec).isNotNull()).toLocalIterator(), block):
        fit = vectors.select(vid, vvec).where(F.size(vvec) == len(rows[0][1]))
        found = found.unionByName(_nearest(fit, list(rows), k, [qid, vid, "distance"], schema))
    w = Window.partitionBy(qid).orderBy("distance", vid)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        qid, F.col("rank").cast("long").alias("rank"), vid, "distance", F.lit("high").alias("relevance"))


def label_centroids(vectors: DataFrame, label: str = "label", vvec: str = "embedding") -> DataFrame:
    """Mean vector per label (partial-aggregated per dimension), used as a bounded query set."""
    e = vectors.select(label, F.posexplode(vvec).alias("dim", "x"))
    m = e.groupBy(label, "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return m.groupBy(label).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("query_vec")
    ).withColumnRenamed(label, "query_id")


def related_passages(docs: DataFrame, passages: DataFrame, k: int = RP.RETRIEVE_K, key: str = "doc_id",
                     text_col: str = "text", pkey: str = "chunk_id", ptext: str = "text",
                     max_postings: int = PI.MAX_POSTINGS, max_terms: int = PI.MAX_TERMS) -> DataFrame:
    """Top-k passages of every document row by TF-IDF cosine over the passage vocabulary.

    All terms count, however frequent, in libraries of any size: the index is written as a scratch table here
    (``passage_index`` keeps one between jobs) and searched a block at a time.
    """
    library = passages.select(F.col(pkey), F.col(ptext).alias("text"))
    index = PI.build_index(library, scratch_path(docs.sparkSession, "passage-index"), pkey, "text", max_postings, max_terms)
    return PI.related(docs, index, k, key, text_col)
