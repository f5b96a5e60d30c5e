"""Spark session and cluster-safe helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound for any side we broadcast on purpose (rule packs, query sets,
# reference libraries).  Anything larger goes through a shuffle join instead.
MAX_BROADCAST_ROWS = 100_000
# Rule packs are compiled into one expression per rule; beyond this a pack is refused
# (a lexicon of this size belongs in a join-based index, not in a projection).
MAX_COMPILED_RULES = 5_000


def get_spark(master: str | None = None, app: str = "lexrev", shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster the existing session is reused."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    It must be named explicitly; only a local session (one machine, as in tests and the bench) may leave it
    unset, and gets a scratch folder that goes with the process.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="lexrev-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under this application's folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lexrev-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a parquet table under spark.checkpoint.dir and continue from it.

    One job (an eager ``checkpoint()`` computes its input twice unless it is cached), a
    durable copy on the shared folder (survives executor loss), and exact size statistics
    for the planner's broadcast decisions on the read-back table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables; a job calls it when its results are written."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{d.rstrip('/')}/lexrev-{spark.sparkContext.applicationId}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_rows(df: DataFrame, limit: int = MAX_BROADCAST_ROWS, what: str = "table") -> list:
    """Collect a small configuration table (rule pack, clause catalogue) after checking its size.

    Only tables whose size does not grow with the corpus come through here.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is not a bounded rule table")
    return rows


MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def known_size(df: DataFrame) -> int | None:
    """The optimizer's size estimate in bytes, when it has one (local relations, file scans)."""
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # noqa: BLE001 - statistics are an optimisation only
        return None
    return None if size >= 2 ** 62 else size


def broadcast_if_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a checked size; otherwise leave the join to the planner (shuffle).

    A side whose estimated size is known and small is broadcast without running a job;
    otherwise its rows are counted up to ``limit``.
    """
    size = known_size(df)
    if size is not None and size <= MAX_BROADCAST_BYTES:
        return F.broadcast(df)
    n = df.limit(limit + 1).count()
    return F.broadcast(df) if n <= limit else df
