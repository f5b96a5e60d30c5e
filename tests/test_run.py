import json
import os
import tempfile

from lexrev.plans.packs import load_packs, read_packs
from lexrev.plans.run import review_corpus
from lexrev.sources.corpus import read_documents
from lexrev.sources.seeds import seeded_documents


def test_review_job_writes_every_output(spark):
    out = tempfile.mkdtemp(prefix="lexrev-run-")
    docs = seeded_documents(read_documents(spark, "/root/testdata/sf0.001/documents.parquet",
                                           ["doc_id", "text", "source"]))
    paths = review_corpus(spark, docs, out, "source", json=True)
    n_docs = docs.count()
    d = spark.read.parquet(paths["documents"])
    assert d.count() == n_docs
    flags = spark.read.parquet(paths["flags"])
    assert flags.count() == d.selectExpr("sum(size(report.review.red_flags))").first()[0] > 0
    b = spark.read.parquet(paths["batches"])
    assert b.count() == docs.select("source").distinct().count()
    row = b.first()
    from lexrev import rulepacks as RP
    assert row.report.startswith(RP.REPORT_TITLE) and set(row.issues_by_severity) >= {"High", "Medium", "Low"}
    assert spark.read.parquet(paths["log"]).count() == n_docs
    assert spark.read.text(paths["documents"] + "_json").count() == n_docs
    assert os.path.isdir(paths["suggestions"])
    issues = spark.read.parquet(paths["issues"])
    assert issues.count() > 0 and set(issues.columns) >= {"excerpt", "comment", "severity", "reference", "copies"}
    ann = spark.read.parquet(paths["annotations"])
    assert ann.where("n_comments = 0").count() == 0 and ann.count() > 0


def _custom_rules(folder):
    rules = [
        {"rule_id": 0, "pattern": "company shall", "issue": "Duty", "severity": "Critical", "suggestion": "Soften",
         "category": "own"},
        {"rule_id": 1, "pattern": "company (", "issue": "Broken", "severity": "High"},
        {"rule_id": 2, "pattern": "x**", "issue": "Repeat", "severity": "High"},
    ]
    clauses = [{"category": "own", "template": "The company may.", "reference": "Own Act"}]
    for name, rows in (("flag_rules", rules), ("clauses", clauses)):
        with open(os.path.join(folder, f"{name}.json"), "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)


def test_review_job_with_custom_packs_and_faulty_rows(spark):
    folder, out = tempfile.mkdtemp(prefix="lexrev-rules-"), tempfile.mkdtemp(prefix="lexrev-run-")
    _custom_rules(folder)
    packs = read_packs(spark, folder)
    assert [r.rule_id for r in packs.flag_rules] == [0] and packs.clauses == [("own", "The company may.", "Own Act")]
    docs = spark.createDataFrame(
        [(1, "The company shall pay. The company shall stay.\nGoverned by UAE law.", "a"), (2, "Nothing.", "a"),
         (3, None, "a"), (4, " \n", "a"), (5, "one", "b"), (5, "two", "b"), (None, "lost", "b")],
        "doc_id long, text string, source string")
    paths = review_corpus(spark, docs, out, "source", packs=packs)
    report = {r.doc_id: r.report for r in spark.read.parquet(paths["documents"]).collect()}
    assert set(report) == {1, 2}
    assert [(f.rule_id, f.start, f.end) for f in report[1].review.red_flags] == [(0, 4, 17), (0, 27, 40)]
    assert [s.suggested_clause for s in report[1].review.legal_suggestions] == ["The company may."] * 2
    assert report[1].review.review_comments_count == 2
    batch = spark.read.parquet(paths["batches"]).first()
    assert batch.source == "a" and batch.issues_by_severity == {"High": 0, "Medium": 0, "Low": 0, "Critical": 2}
    assert [r.suggested_clause for r in spark.read.parquet(paths["suggestions"]).collect()] == ["The company may."] * 2
    errors = sorted((r.doc_id or 0, r.error) for r in spark.read.parquet(paths["errors"]).collect())
    assert errors == [(0, "missing id"), (3, "missing text"), (4, "blank text"), (5, "duplicate id"), (5, "duplicate id")]
    log = [r.log_line for r in spark.read.parquet(paths["log"]).collect()]
    assert len(log) == 7 and "!! Error processing 3: missing text" in log
    rejected = {r.rule: r.reason for r in spark.read.parquet(paths["rejected_rules"]).collect()}
    assert set(rejected) == {"1", "2"} and "invalid pattern" in rejected["1"] and "invalid pattern" in rejected["2"]
    note = spark.read.parquet(paths["issues"]).first()
    assert (note.paragraph_index, note.copies, note.severity) == (0, 2, "Critical")


def test_bad_type_rule_does_not_stop_the_others(spark):
    rows = [("x", 0, "pattern", 0, "a(", 1.0, True), ("x", 0, "primary", 0, "void", 1.0, False),
            ("x", 0, "primary", 1, None, 1.0, False)]
    packs = load_packs(spark, type_rules=spark.createDataFrame(
        rows, "type string, type_order int, kind string, ord int, term string, weight double, is_regex boolean"))
    assert [r.term for r in packs.type_rules] == ["void"] and len(packs.rejected) == 2
