"""Batch review job (E1 end to end, S5 sinks): ``python -m lexrev.plans.run IN OUT [--batch-col source]``.

The expensive per-document review (segmentation, measures, classification,
red flags) runs once, in one map-only pass, and is written as the
``documents`` table.  Every other output is derived from that written table,
so the text is never scanned twice and the lineage of the derived outputs is
cut at a durable table:

* ``documents/``  one nested record per document (parquet; ``--json`` adds JSON lines)
* ``flags/``      one row per red flag with offsets and rule fields
* ``suggestions/`` replacement clauses for flags whose category has a template
* ``batches/``    per batch: compliance, severity counts and the Markdown summary
* ``log/``        the processing log line of every document
* ``issues/``     the review table: one row per (rule, paragraph) comment with its excerpt
* ``annotations/`` commented paragraphs with their appended comments and highlight
* ``errors/``     rows that cannot be reviewed (null or repeated id, null or blank text) with the reason
* ``rejected_rules/`` rules of the packs that cannot be used, with the reason; the others still apply
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexrev.functions import text as X
from lexrev.functions.joins import join_keys
from lexrev.operators import compliance as K
from lexrev.operators import flags as FL
from lexrev.operators.passage_index import PassageIndex, build_index, open_index
from lexrev.operators.retrieval import split_text
from lexrev.operators.textmodel import load_bayes
from lexrev.plans import review as RV
from lexrev.plans.packs import RulePacks, load_packs, read_packs
from lexrev.session import clear_scratch
from lexrev.sources.corpus import (FILE_INFO, read_document_files, read_reference_texts, split_quarantine, spread_documents,
                                   with_file_metadata, with_processing_order)
from lexrev.sources.rules import CLAUSES_SCHEMA


def review_corpus(spark: SparkSession, docs: DataFrame, out_dir: str, batch_col: str = "source",
                  method: str = "ensemble", json: bool = False, packs: RulePacks | None = None,
                  comments: str = "paragraph", knowledge: str | None = None,
                  unreadable: DataFrame | None = None, model: str | None = None) -> dict[str, str]:
    """Review ``docs(doc_id, text, <batch_col>)``; ``FILE_INFO`` columns that they carry enter the records and errors.

    ``knowledge`` names a passage index (``passage_index.build_index``) whose related passages enter the records; ``unreadable``
    are errors found when the documents were read; ``model`` names a saved text model, which ``method="ml"`` applies.
    """
    paths = {k: os.path.join(out_dir, k) for k in ("documents", "flags", "suggestions", "batches", "log", "issues",
                                                   "annotations", "errors", "rejected_rules")}
    packs = packs or load_packs(spark)
    rules = packs.flag_rules
    packs.rejected_rules(spark).write.mode("overwrite").parquet(paths["rejected_rules"])
    docs, errors = split_quarantine(docs)
    if unreadable is not None:
        errors = errors.unionByName(unreadable)
    errors.write.mode("overwrite").parquet(paths["errors"])
    if knowledge:
        docs = RV.with_references(docs, open_index(spark, knowledge))
    if model:
        docs = RV.with_model_types(docs, load_bayes(spark, model))
    carried = [c for c in [*FILE_INFO, "related_references"] if c in docs.columns]
    rev = RV.reviewed(docs, method, packs.type_rules, rules, keep=[batch_col, *carried])
    # the commented paragraphs travel with the document record, so the issue table and the marked-up
    # paragraphs are derived without reading the text again
    rev = FL.with_paragraph_comments(rev, rules, comments)
    rev = rev.withColumns({"comments": FL.all_comments(F.col("commented")),
                           "annotated": FL.annotated_paragraphs(F.col("commented"), only_commented=True)})
    report = RV.document_report(rev, batch_col=batch_col, carry=["flag_severities", "comments", "annotated"],
                                clauses=packs.clauses, flag_rules=rules)
    report.write.mode("overwrite").parquet(paths["documents"])
    if json:
        spark.read.parquet(paths["documents"]).select(F.to_json(F.struct("*")).alias("value")).write.mode(
            "overwrite").text(paths["documents"] + "_json")

    done = spark.read.parquet(paths["documents"])
    flags = X.inline_rows(done, ["doc_id", batch_col], F.col("report.review.red_flags"), "rule_id")
    rid = F.col("rule_id")
    flags = flags.select(
        "doc_id", batch_col, rid.cast("long").alias("rule_id"), F.col("occurrence").cast("long").alias("occurrence"),
        *[FL._rule_meta(rules, rid, f).alias(f) for f in ("issue", "severity", "suggestion", "reference", "category")],
        "matched_text", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
    )
    flags.write.mode("overwrite").parquet(paths["flags"])
    clauses = spark.createDataFrame(packs.clauses, CLAUSES_SCHEMA)
    FL.suggest_clauses(spark.read.parquet(paths["flags"]), clauses).write.mode("overwrite").parquet(paths["suggestions"])

    per_doc = done.select(
        "doc_id", batch_col,
        F.col("report.classification.predicted_type").alias("predicted_type"),
        F.col("report.classification.confidence").alias("confidence"),
        F.col("report.review.red_flags").alias("flags"),
        "flag_severities",
    )
    comp = K.compliance(per_doc, batch_col, packs.process_rules, packs.requirements)
    sev = RV.severity_counts(per_doc, batch_col, rules).groupBy(batch_col).agg(
        F.map_from_entries(F.collect_list(F.struct("severity", "issues"))).alias("issues_by_severity"))
    summary = RV.summary_report(per_doc, batch_col, process_rules=packs.process_rules, requirements=packs.requirements,
                                flag_rules=rules)
    join_keys(join_keys(comp, sev, batch_col), summary, batch_col).write.mode("overwrite").parquet(paths["batches"])
    log = RV.processing_log(per_doc).unionByName(RV.error_log(spark.read.parquet(paths["errors"])))
    if knowledge:
        log = log.unionByName(spark.createDataFrame([(None, RV.knowledge_line(open_index(spark, knowledge)))], log.schema))
    log.write.mode("overwrite").parquet(paths["log"])
    issues = X.inline_rows(done, ["doc_id", batch_col], F.col("comments"), "rule_id")
    FL.issue_table(issues.withColumn("rule_id", F.col("rule_id").cast("long"))).write.mode("overwrite").parquet(
        paths["issues"])
    X.inline_rows(done, ["doc_id", batch_col], F.col("annotated"), "idx").write.mode("overwrite").parquet(
        paths["annotations"])
    return paths


def build_knowledge(spark: SparkSession, folder: str, path: str) -> PassageIndex:
    """S2, R1 and R4 as one plan: reference texts of a folder, cut at separators, indexed to ``path``."""
    texts = read_reference_texts(spark, folder)
    chunks = split_text(texts, key="source_name").select(
        F.concat_ws("#", "source_name", "chunk_no").alias("chunk_id"), "source_name", "chunk_no", "start", "text")
    return build_index(chunks, path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Review a corpus of documents (parquet with doc_id, text).")
    ap.add_argument("input")
    ap.add_argument("output")
    ap.add_argument("--batch-col", default="source")
    ap.add_argument("--method", default="ensemble", choices=["ensemble", "rule_based", "ml"])
    ap.add_argument("--json", action="store_true")
    ap.add_argument("--rules", help="folder of rule packs, <name>.json each (JSON lines); default packs for the rest")
    ap.add_argument("--comments", default="paragraph", choices=["paragraph", "reference"])
    ap.add_argument("--files", action="store_true", help="IN is a folder of text files, a document each; they are one batch")
    ap.add_argument("--knowledge", help="folder of a passage index whose related passages enter the records")
    ap.add_argument("--model", help="folder of a saved text model, for --method ml")
    ap.add_argument("--references", help="folder of *.txt reference texts, from which the index is built first")
    a = ap.parse_args(argv)
    if a.references and not a.knowledge:
        ap.error("--references needs --knowledge, the folder to keep the index in")
    spark = SparkSession.builder.appName("lexrev-review").getOrCreate()
    unreadable = None
    if a.files:
        docs, unreadable = read_document_files(spark, a.input)
        docs = docs.withColumn(a.batch_col, F.lit(a.input))
    else:
        scan = with_file_metadata(spark.read.parquet(a.input))
        docs = spread_documents(with_processing_order(scan.select("doc_id", "text", a.batch_col, "filename", "file_size")))
    if a.references:
        build_knowledge(spark, a.references, a.knowledge)
    packs = read_packs(spark, a.rules)
    for name, path in review_corpus(spark, docs, a.output, a.batch_col, a.method, a.json, packs, a.comments, a.knowledge,
                                    unreadable, a.model).items():
        print(f"{name}: {path}")
    clear_scratch(spark)


if __name__ == "__main__":
    main()
