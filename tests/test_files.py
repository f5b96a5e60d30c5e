import os
import tempfile

import pytest

from lexrev.operators.passage_index import open_index
from lexrev.plans.run import build_knowledge, main, review_corpus
from lexrev.sources.corpus import read_document_files, with_file_metadata, with_processing_order


@pytest.fixture
def folder(tmp_path):
    files = {"b.txt": b"The company shall act. Governed by UAE law.", "a.TXT": "ADGM café board of directors".encode(), "broken.txt": b"ok \xff\xfe no",
             "empty.txt": b"\n", "z.txt": b"Board meeting of the directors.", "skip.md": b"x"}
    for name, body in files.items():
        (tmp_path / name).write_bytes(body)
    return str(tmp_path)


def test_a_broken_file_stops_no_other(spark, folder):
    docs, errors = read_document_files(spark, folder)
    got = {r.doc_id: (r.filename, r.file_size, r.processing_order, r.text) for r in docs.collect()}
    assert set(got) == {"a.TXT", "b.txt", "empty.txt", "z.txt"} and got["empty.txt"][3] == "\n" and got["a.TXT"][3] == "ADGM café board of directors"
    assert [got[n][2] for n in ("a.TXT", "b.txt", "empty.txt", "z.txt")] == [1, 2, 4, 5]
    row, = errors.collect()
    assert (row.doc_id, row.file_size, row.processing_order) == ("broken.txt", 8, 3) and "byte 3" in row.error


@pytest.mark.parametrize("parts", [1, 7])
def test_processing_order_is_dense_in_the_order_of_the_scan(spark, tmp_path, parts):
    spark.range(1000).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 as int)) AS text").repartition(parts).write.parquet(str(tmp_path / "d"))
    scan = with_file_metadata(spark.read.parquet(str(tmp_path / "d")))
    rows = with_processing_order(scan.select("doc_id", "text", "filename")).collect()
    assert sorted(r.processing_order for r in rows) == list(range(1, 1001))
    plain = [r.doc_id for r in scan.select("doc_id").collect()]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.processing_order)] == plain
    assert with_processing_order(scan.where("doc_id < 0")).count() == 0


def test_job_on_files_with_references(spark, folder):
    refs, out, index = (tempfile.mkdtemp(prefix="lexrev-job-") for _ in range(3))
    for name, body in (("law.txt", "The board of directors meets.\n\nThe company acts by its directors."), ("other.TXT", "Weather report for today.")):
        with open(os.path.join(refs, name), "w", encoding="utf-8") as f:
            f.write(body)
    assert build_knowledge(spark, refs, index).n_passages == 2
    docs, unreadable = read_document_files(spark, folder)
    from pyspark.sql import functions as F

    paths = review_corpus(spark, docs.withColumn("source", F.lit("s")), out, knowledge=index, unreadable=unreadable)
    rec = {r.doc_id: r.report for r in spark.read.parquet(paths["documents"]).collect()}
    assert set(rec) == {"a.TXT", "b.txt", "z.txt"}
    assert (rec["z.txt"].file_info.filename, rec["z.txt"].file_info.file_size, rec["z.txt"].file_info.processing_order) == ("z.txt", 31, 5)
    assert [r.passage for r in rec["z.txt"].review.related_references] == ["law.txt#0"]
    assert rec["z.txt"].review.related_references[0].content.startswith("The board of directors") and rec["z.txt"].review.related_references[0].relevance == "high"
    errors = {r.doc_id: (r.error, r.processing_order) for r in spark.read.parquet(paths["errors"]).collect()}
    assert errors["empty.txt"] == ("blank text", 4) and errors["broken.txt"][0].startswith("unreadable file") and errors["broken.txt"][1] == 3
    log = [r.log_line for r in spark.read.parquet(paths["log"]).collect()]
    assert "Knowledge base built from 2 ADGM reference documents" in log and any(line.startswith("!! Error processing broken.txt: unreadable") for line in log)


def test_command_line_on_a_table(spark, tmp_path):
    spark.createDataFrame([(1, "The company shall act.", "s"), (2, None, "s")], "doc_id long, text string, source string").coalesce(1).write.parquet(
        str(tmp_path / "docs"))
    (tmp_path / "refs").mkdir()
    (tmp_path / "refs" / "r.txt").write_text("A company acts.")
    main([str(tmp_path / "docs"), str(tmp_path / "out"), "--references", str(tmp_path / "refs"), "--knowledge", str(tmp_path / "index")])
    row = spark.read.parquet(str(tmp_path / "out/documents")).first().report
    assert row.file_info.processing_order == 1 and row.file_info.filename.startswith("part-") and len(row.review.related_references) == 1
    assert spark.read.parquet(str(tmp_path / "out/errors")).first().processing_order == 2
    assert open_index(spark, str(tmp_path / "index")).n_passages == 1
    assert not [d for d in os.listdir(spark.conf.get("spark.checkpoint.dir")) if d == f"lexrev-{spark.sparkContext.applicationId}"]
