import os
import tempfile

from lexrev.sources.corpus import read_reference_texts, split_quarantine, with_file_metadata


def test_reference_texts_glob(spark):
    d = tempfile.mkdtemp(prefix="lexrev-src-")
    for name, body in [("a.txt", "alpha\nline"), ("B.TXT", "beta"), ("c.md", "gamma")]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(body)
    rows = {r.source_name: r.text for r in read_reference_texts(spark, d).collect()}
    assert rows == {"a.txt": "alpha\nline", "B.TXT": "beta"}
    meta = with_file_metadata(spark.read.text(os.path.join(d, "a.txt"))).select("filename", "file_size").first()
    assert meta.filename == "a.txt" and meta.file_size == 10


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "   "), (3, None), (4, "x"), (4, "y"), (None, "z")],
                               "doc_id long, text string")
    good, errors = split_quarantine(df)
    assert sorted(r.doc_id for r in good.collect()) == [1]
    e = {(r.doc_id, r.error) for r in errors.collect()}
    assert e == {(2, "blank text"), (3, "missing text"), (4, "duplicate id"), (None, "missing id")}


def test_rule_pack_from_json(spark):
    import json

    from lexrev.operators import flags as FL
    from lexrev.sources.rules import read_rulepack

    d = tempfile.mkdtemp(prefix="lexrev-rules-")
    path = os.path.join(d, "flags.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps({"rule_id": 0, "pattern": r"force\s+majeure", "issue": "Check", "severity": "Low",
                            "suggestion": "Review", "reference": "", "category": "contract_terms"}) + "\n")
    rules = read_rulepack(spark, path, "flag_rules")
    docs = spark.createDataFrame([(1, "A Force  Majeure event.")], "doc_id long, text string")
    f = FL.scan_flags(docs, rules).first()
    assert (f.matched_text, f.start, f.end, f.severity) == ("Force  Majeure", 2, 16, "Low")


def test_spread_keeps_copies_apart(spark):
    from pyspark.sql import functions as F

    from lexrev.sources.corpus import spread_documents
    rows = [(1, f"copy {i}") for i in range(300)] + [(i, "same text") for i in range(2, 302)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sizes = [r["count"] for r in spread_documents(df).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < len(rows) / 4
