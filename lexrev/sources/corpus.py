"""Document sources and sinks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexrev.functions.text import py_strip
from lexrev.session import broadcast_if_small, cut_lineage

DOC_COLUMNS = ["doc_id", "text", "lang", "source"]


def read_documents(spark: SparkSession, path: str, columns: list[str] | None = None,
                   spread: bool = True) -> DataFrame:
    """A corpus of documents (one row per document); only the needed columns are read."""
    df = spark.read.parquet(path)
    df = df.select(*(columns or [c for c in DOC_COLUMNS if c in df.columns]))
    return spread_documents(df) if spread else df


def spread_documents(df: DataFrame, key: str = "doc_id", per_core: int = 4, text_col: str = "text") -> DataFrame:
    """Spread documents over all cores when the scan yields fewer than ``per_core`` splits a core.

    The review is CPU-bound (regular expressions over whole texts, a few MB/s per core), so a
    file written as one row group would otherwise be reviewed by a single task.  One shuffle of
    the text costs far less than the work it balances.  Spark packs a scan's files in about a split
    a core, of which a few are left for a second wave, and splits of a row group's file hold nothing
    but in one of them: such a scan keeps part of the cores idle.  A corpus with many splits is left
    untouched (no shuffle).  The hash covers the key and the text (deterministic, so
    a retried task routes rows the same way): copies of a document under one id, or one id
    reused for many texts, do not pile up in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores * per_core:
        return df
    cols = [key] + ([text_col] if text_col in df.columns else [])
    return df.repartition(cores * per_core, *cols)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_reference_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.txt`` file (any case of the extension) in a folder, one row per file."""
    df = spark.read.text(folder, wholetext=True, pathGlobFilter="*.[tT][xX][tT]")
    return df.select(
        F.col("_metadata.file_name").alias("source_name"),
        F.col("value").alias("text"),
    )


def with_file_metadata(df: DataFrame) -> DataFrame:
    """S3: file name, size and modification time of the file each row was read from."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


#: What a record's ``file_info`` holds, where documents carry it.
FILE_INFO = ["filename", "file_size", "processing_order"]


def with_processing_order(df: DataFrame, out: str = "processing_order") -> DataFrame:
    """S3: number the rows of a scan from 1, without gaps, in the order in which it reads them.

    Two passes and no shuffle: the rows of every partition are counted (no column is read for that), then each row's
    place in its partition is added to the rows of the partitions before. ``df`` must be a scan with
    projections and filters on it, whose partitions are the same each time it is read.
    """
    here, place = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(df.select(here.alias("p")).groupBy("p").count().toLocalIterator())  # a row a partition
    before, starts = 0, []
    for p, n in counts:
        starts.append((p, before))
        before += n
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    numbered = df.withColumns({"_part": here, "_place": place})
    return numbered.join(broadcast_if_small(offsets), "_part").withColumn(
        out, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")


def read_document_files(spark: SparkSession, folder: str, pattern: str = "*.[tT][xX][tT]") -> tuple[DataFrame, DataFrame]:
    """S1 and S4 for a folder of text files, a document each: (documents, unreadable files).

    Both have doc_id (the file's name), filename, file_size and processing_order (by name, from 1); documents have their text, errors
    the reason why a file's bytes are no UTF-8 text. Every file is read by itself, so a broken one stops no other. Files of
    no bytes are not seen, as Spark's readers leave them out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("doc_id"), F.col("length").alias("file_size"), "content")
    # names alone are sorted (ranges of them by task), and numbered by the sorted table's scan
    names = cut_lineage(named.select("doc_id").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
                        .withColumn("_at", F.monotonically_increasing_id()), "file-names")
    rows = names.groupBy(F.shiftrightunsigned("_at", 33).alias("p")).count().toLocalIterator()
    before, starts = 0, []
    for p, n in sorted(rows):
        starts.append((p, before))
        before += n
    offsets = spark.createDataFrame(starts, "_part long, _before long")
    order = names.withColumn("_part", F.shiftrightunsigned("_at", 33)).join(broadcast_if_small(offsets), "_part").select(
        "doc_id", (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("processing_order"))
    schema = "doc_id string, file_size long, text string, error string"

    def decode(batches):
        for b in batches:
            texts, errors = [], []
            for raw in b.column(2):
                try:
                    texts.append(raw.as_py().decode("utf-8"))
                    errors.append(None)
                except UnicodeDecodeError as e:
                    texts.append(None)
                    errors.append(f"unreadable file: {e.reason} at byte {e.start}")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(errors, pa.string())],
                                             names=["doc_id", "file_size", "text", "error"])

    read = named.mapInArrow(decode, schema).join(broadcast_if_small(order), "doc_id").withColumn("filename", F.col("doc_id"))
    info = ["doc_id", *FILE_INFO]
    return read.where("error IS NULL").select(*info, "text"), read.where("error IS NOT NULL").select(*info, "error")


def split_quarantine(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(good documents, errors).  A row is an error when its key is null or repeated, or its
    text is null or blank; the batch goes on with the good rows.  Errors keep the row's ``FILE_INFO`` columns.

    Repeated keys are found on the key column alone (partial aggregation); the set of
    repeated keys is broadcast only when its measured size allows it.
    """
    keyed = docs.where(F.col(key).isNotNull())  # null keys stay out of the join, where they would meet in one task
    dup = keyed.groupBy(key).count().where(F.col("count") > 1).select(
        key, F.lit(True).alias("_dup")
    )
    tagged = keyed.join(broadcast_if_small(dup), key, "left")
    reason = (
        F.when(F.col("_dup"), "duplicate id")
        .when(F.col(text_col).isNull(), "missing text")
        .when(py_strip(F.col(text_col)) == "", "blank text")
    )
    tagged = tagged.withColumn("error", reason).drop("_dup")
    good = tagged.where(F.col("error").isNull()).drop("error")
    info = [c for c in FILE_INFO if c in docs.columns and c != key]
    errors = tagged.where(F.col("error").isNotNull()).select(key, "error", *info)
    unkeyed = docs.where(F.col(key).isNull()).select(key, F.lit("missing id").alias("error"), *info)
    return good, errors.unionByName(unkeyed)
