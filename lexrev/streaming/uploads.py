"""Review of uploaded batches as they arrive (Structured Streaming).

The reviewed application analyses one upload at a time.  Here every new
parquet file of documents dropped into a folder is an upload: the per-document
review (segmentation, classification, red flags) is a narrow projection, so it
runs unchanged on the stream; per-upload outputs (issues per severity,
compliance) are computed for each micro-batch with ``foreachBatch`` and
appended to tables.  Progress and file offsets live in a checkpoint folder
under the cluster's ``spark.checkpoint.dir`` so a restarted query resumes
where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexrev.operators import compliance as K
from lexrev.plans import review as RV
from lexrev.session import checkpoint_dir

UPLOAD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def review_uploads(spark: SparkSession, inbox: str, out_dir: str, name: str = "uploads",
                   schema: str = UPLOAD_SCHEMA, max_files_per_trigger: int = 1, available_now: bool = True):
    """Start the streaming review; returns the StreamingQuery.

    Each micro-batch (``max_files_per_trigger`` files) is one upload; its id is the batch id.
    Writes ``<out_dir>/documents`` (one row per document) and ``<out_dir>/severity`` and
    ``<out_dir>/compliance`` (one row per upload and severity / per upload).
    """
    docs = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(inbox))

    def per_upload(batch: DataFrame, batch_id: int) -> None:
        # foreachBatch may replay a batch after a failure: each output goes to its own
        # upload=<id> folder written with overwrite, so a replay replaces instead of duplicating.
        def sink(df: DataFrame, table: str) -> None:
            df.drop("upload").write.mode("overwrite").parquet(os.path.join(out_dir, table, f"upload={batch_id}"))

        b = batch.withColumn("upload", F.lit(batch_id).cast("long"))
        # the compact per-document result is reused by three outputs of this upload
        rev = RV.reviewed(b, keep=["upload"]).select(
            "upload", "doc_id", "predicted_type", "confidence", "flags", "flag_severities").persist()
        try:
            per_doc = rev.select("upload", "doc_id", "predicted_type", "confidence",
                                 F.size("flags").cast("long").alias("issues"))
            sink(per_doc, "documents")
            sink(RV.severity_counts(rev, "upload"), "severity")
            sink(K.compliance(per_doc, "upload"), "compliance")
        finally:
            rev.unpersist()

    writer = (docs.writeStream.foreachBatch(per_upload)
              .option("checkpointLocation", os.path.join(checkpoint_dir(spark), f"stream-{name}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
