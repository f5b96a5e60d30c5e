"""Cell index over vectors (R3): nearest cells by key, hot cells split, exact distances within.

Cells are the centres that k-means finds in a sample of at most ``SAMPLE_ROWS`` vectors (those with the smallest hashes of their ids); every vector
is indexed, in its nearest cell. A cell of many vectors is split into parts of about ``PART_ROWS`` by a hash of the id. A query goes to its
``probes`` nearest cells and, there, to every part; queries of a cell are dealt into slots of about ``SLOT_ROWS``, so that a group of the join (cell,
part, slot) is bounded on both sides, however hot the cell. Each group keeps its k nearest vectors by exact distance, which are merged per query.
The answer is exact among the vectors of the probed cells. How many cells to probe is measured when the index is built: the exact neighbours of
``PROBE_SAMPLE`` indexed vectors are searched for, and ``probes`` is the least number of nearest cells that holds ``RECALL`` of them. Vectors without clusters need
most cells; clustered ones few. ``recall`` measures a search against an exact one.

Vectors that are null or of another length than the sample's have no distance: they are neither indexed nor searched with. Repeated ids are rows of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexrev import rulepacks as RP
from lexrev.operators.retrieval import knn, squared_l2
from lexrev.session import cut_lineage

SAMPLE_ROWS = 50_000
PART_ROWS = 8192
SLOT_ROWS = 2048
MAX_CELLS = 4096
PROBE_SAMPLE = 256
PROBE_K = 10
RECALL = 0.95
SEED = 1


@dataclass(frozen=True)
class VectorIndex:
    spark: SparkSession
    path: str
    centres: np.ndarray  # at most MAX_CELLS rows
    parts: list[int]  # parts of each cell
    probes: int

    @property
    def table(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")


def default_cells(n: int) -> int:
    return max(1, min(MAX_CELLS, round(math.sqrt(n))))


def _nearest_cells(vectors: DataFrame, vec: str, centres: np.ndarray, n: int) -> DataFrame:
    """Rows with the places of their ``n`` nearest centres, nearest first, as ``cells``."""
    sent = vectors.sparkSession.sparkContext.broadcast(centres)
    schema = T.StructType([*vectors.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    at = vectors.columns.index(vec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b = whole.slice(lo, 1024)
                v = b.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                best = np.argsort(squared_l2(v, c), axis=1, kind="stable")[:, :n].astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * best.shape[1]), pa.array(best.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, cells], names=schema.fieldNames())

    return vectors.mapInArrow(run, schema)


def build_index(vectors: DataFrame, path: str, cells: int | None = None, vid: str = "vec_id", vvec: str = "embedding",
                seed: int = SEED) -> VectorIndex:
    """Fit the cells of ``vectors(vid, vvec)`` and write the index to ``path``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vid).alias("vec_id"), F.col(vvec).cast("array<double>").alias("vec")).where("vec IS NOT NULL AND size(vec) > 0")
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS)
    sample = cut_lineage(first, "vector-sample")
    size = sample.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        empty = rows.select(F.lit(0).alias("cell"), F.lit(0).alias("part"), "*").limit(0)
        empty.write.mode("overwrite").parquet(f"{path}/vectors")
        return VectorIndex(spark, path, np.zeros((1, 0)), [1], 1)
    fit = rows.where(F.size("vec") == size["n"])
    k = cells or default_cells(fit.count())
    model = KMeans(k=max(2, k), seed=seed, maxIter=10, featuresCol="f").fit(
        sample.where(F.size("vec") == size["n"]).select(array_to_vector("vec").alias("f")))
    centres = np.array([np.asarray(c) for c in model.clusterCenters()], np.float64)
    placed = cut_lineage(_nearest_cells(fit, "vec", centres, 1).select(F.col("cells")[0].alias("cell"), "vec_id", "vec"), "vector-cells")
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row a cell
    parts = [max(1, -(-counts.get(i, 0) // PART_ROWS)) for i in range(len(centres))]
    part = F.pmod(F.xxhash64("vec_id"), F.element_at(F.lit(parts), F.col("cell") + 1)).cast("int")
    (placed.select("cell", part.alias("part"), "vec_id", "vec").repartition("cell", "part").sortWithinPartitions("cell", "part", "vec_id")
     .write.mode("overwrite").parquet(f"{path}/vectors"))
    index = VectorIndex(spark, path, centres, parts, len(centres))
    return replace(index, probes=_measured_probes(index))


def _measured_probes(index: VectorIndex) -> int:
    """The least number of nearest cells that holds ``RECALL`` of the exact neighbours of a sample of the indexed vectors."""
    sample = index.table.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(PROBE_SAMPLE).select(
        F.monotonically_increasing_id().alias("query_id"), F.col("vec").alias("query_vec"))
    sample = cut_lineage(sample, "probe-sample")
    found = knn(sample, index.table, k=PROBE_K, vvec="vec").select("query_id", "vec_id")
    cells = index.table.join(F.broadcast(found), "vec_id").select("query_id", "cell")  # PROBE_SAMPLE * PROBE_K rows are sent
    ordered = _nearest_cells(sample, "query_vec", index.centres, len(index.centres)).select("query_id", "cells")
    places = cells.join(F.broadcast(ordered), "query_id").select(F.array_position("cells", F.col("cell")).alias("n")).collect()
    if not places:
        return len(index.centres)
    return int(np.quantile([r["n"] for r in places], RECALL, method="higher"))


def search(queries: DataFrame, index: VectorIndex, k: int = RP.RETRIEVE_K, probes: int | None = None, qid: str = "query_id",
           qvec: str = "query_vec") -> DataFrame:
    """The ``k`` nearest indexed vectors (squared L2, ties by id) in the ``probes`` nearest cells (as measured, by default) of every query:
    query id, rank, vec_id, distance."""
    n_cells = len(index.centres)
    probes = min(n_cells, probes or index.probes)
    dim = index.centres.shape[1]
    rows = queries.select(F.col(qid).alias("query_id"), F.col(qvec).cast("array<double>").alias("qvec")).where(F.size("qvec") == dim)
    probing = cut_lineage(_nearest_cells(rows, "qvec", index.centres, probes).select(
        F.explode("cells").alias("cell"), "query_id", "qvec"), "vector-queries")
    counts = {r["cell"]: r["n"] for r in probing.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row a cell
    slots = F.lit([max(1, -(-counts.get(i, 0) // SLOT_ROWS)) for i in range(n_cells)])
    parts = F.lit(index.parts)

    def upto(n):
        return F.explode(F.sequence(F.lit(0), n - 1))

    dealt = probing.withColumn("slot", F.pmod(F.xxhash64("query_id"), F.element_at(slots, F.col("cell") + 1)).cast("int")).withColumn(
        "part", upto(F.element_at(parts, F.col("cell") + 1)))
    vectors = index.table.withColumn("slot", upto(F.element_at(slots, F.col("cell") + 1)))
    qtype, vtype = rows.schema["query_id"].dataType, index.table.schema["vec_id"].dataType
    schema = T.StructType([T.StructField("query_id", qtype), T.StructField("vec_id", vtype), T.StructField("distance", T.DoubleType())])

    def matrix(t: pa.Table, name: str) -> np.ndarray:
        return t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)

    def nearest(q: pa.Table, v: pa.Table) -> pa.Table:
        out = []
        if q.num_rows and v.num_rows:
            v = v.sort_by("vec_id")  # ties go by id
            vectors = matrix(v, "vec")
            for lo in range(0, q.num_rows, 256):
                some = q.slice(lo, 256)
                d = squared_l2(matrix(some, "qvec"), vectors)
                best = np.argsort(d, axis=1, kind="stable")[:, :k]
                row = np.repeat(np.arange(some.num_rows), best.shape[1])
                out.append(pa.table([some.column("query_id").take(pa.array(row)), v.column("vec_id").take(pa.array(best.ravel())),
                                     pa.array(d[row, best.ravel()])], names=schema.fieldNames()))
        return pa.concat_tables(out) if out else pa.table(
            [q.column("query_id").slice(0, 0), v.column("vec_id").slice(0, 0), pa.array([], pa.float64())], names=schema.fieldNames())

    keys = ["cell", "part", "slot"]
    found = dealt.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInArrow(nearest, schema)
    w = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        F.col("query_id").alias(qid), F.col("rank").cast("long").alias("rank"), "vec_id", "distance")


def recall(found: DataFrame, exact: DataFrame, qid: str = "query_id", vid: str = "vec_id") -> float:
    """Share of the exact neighbours that a search found."""
    hit = found.select(qid, vid, F.lit(1.0).alias("hit"))
    return exact.join(hit, [qid, vid], "left").agg(F.avg(F.coalesce("hit", F.lit(0.0)))).first()[0] or 0.0
