import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq

from lexrev.streaming.uploads import review_uploads


def test_each_upload_is_reviewed(spark):
    inbox = tempfile.mkdtemp(prefix="lexrev-inbox-")
    out = tempfile.mkdtemp(prefix="lexrev-out-")
    uploads = [
        [(1, "This agreement is governed by UAE Federal Courts and shall be subject to UAE law."),
         (2, "Articles of Association for Test Company Limited. This document contains governance provisions.")],
        [(3, "Memorandum of Association\nThe registered office is in town."), (4, "plain text")],
    ]
    for i, rows in enumerate(uploads):
        t = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": ["en"] * 2,
                      "source": ["s"] * 2, "n_chars": [len(r[1]) for r in rows]})
        pq.write_table(t, os.path.join(inbox, f"upload{i}.parquet"))
    q = review_uploads(spark, inbox, out, name=os.path.basename(out))
    q.awaitTermination(300)
    docs = spark.read.parquet(os.path.join(out, "documents"))
    assert docs.count() == 4 and docs.select("upload").distinct().count() == 2
    sev = {(r.upload, r.severity): r.issues for r in spark.read.parquet(os.path.join(out, "severity")).collect()}
    first = docs.where("doc_id = 1").first().upload
    assert sev[(first, "High")] == 3 and sev[(first, "Medium")] == 0
    comp = spark.read.parquet(os.path.join(out, "compliance"))
    assert comp.count() == 2
    # replaying the uploads (a fresh checkpoint re-runs batch ids 0 and 1) replaces, never duplicates
    q = review_uploads(spark, inbox, out, name=os.path.basename(out) + "-replay")
    q.awaitTermination(300)
    assert spark.read.parquet(os.path.join(out, "documents")).count() == 4
