"""The batch review plan (E1) and its per-batch outputs.

``reviewed`` is one map-only projection over the document scan: structure,
classification and red flags of every document are columns of its row.
Batch outputs then need a single partial-aggregated shuffle on the batch key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.operators import classify as C
from lexrev.operators import compliance as K
from lexrev.operators import flags as FL
from lexrev.operators import measures as M
from lexrev.operators import segment as S
from lexrev.operators.passage_index import REFERENCES_TYPE, PassageIndex, references
from lexrev.operators.textmodel import BayesModel, score_bayes
from lexrev.session import cut_lineage
from lexrev.sources.corpus import FILE_INFO


def _with_severities(d: DataFrame, frules: list[FL.FlagRule]) -> DataFrame:
    d = FL.with_flag_array(d, frules)
    return d.withColumn("flag_severities",
                        F.transform(F.col("flags"), lambda f: FL._rule_meta(frules, f["rule_id"], "severity")))


def flagged(docs: DataFrame, flag_rules: DataFrame | list | None = None, key: str = "doc_id", text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """One row per document with its flags and their severities only (no sections, no classification)."""
    d = docs.select(key, *(keep or []), S.full_text_from_text(F.col(text_col)).alias("full_text"))
    return _with_severities(d, FL.load_flag_rules(flag_rules, docs.sparkSession))


def reviewed(docs: DataFrame, method: str = "ensemble", type_rules: DataFrame | list | None = None,
             flag_rules: DataFrame | list | None = None, key: str = "doc_id", text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """One row per document: structure arrays, classification and its flags.

    ``_lt`` and ``_wc``, the lower-cased text and its number of words, go along for the record.

    ``method="ml"`` takes the types of a trained model where the documents carry them (``with_model_types``); the evidence
    stays that of the rules. Without a model it is ``rule_based``.
    """
    spark = docs.sparkSession
    trules = C.load_type_rules(type_rules, spark)
    frules = FL.load_flag_rules(flag_rules, spark)
    types = [c for c in ("ml_type", "ml_confidence") if c in docs.columns]
    d = S.with_structure(docs, text_col).select(key, *(keep or []), *types, "paras", "full_text", "sections", "tables")
    d = FL.with_case(d).withColumn("_wc", X.word_count("full_text"))  # once for flags, types and measures
    out = C.with_classification(_with_severities(d, frules), trules, method)
    if method == "ml" and types:
        out = out.withColumns({"predicted_type": F.coalesce("ml_type", F.lit("unknown")),
                               "confidence": F.coalesce("ml_confidence", F.lit(0.0)), "method_used": F.lit("ml")})
    return out.drop(*types, "_plain")


def with_references(docs: DataFrame, index: PassageIndex, k: int = RP.RETRIEVE_K, key: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """R4 in the record: ``docs`` with the array ``related_references`` (null without any), joined on the document's key.

    Found in the whole text; its tokens are those of ``full_text``, which only joins its lines by blanks.
    """
    found = cut_lineage(references(docs.select(key, text_col), index, k, key, text_col), "references")
    # Its contents repeat, so that the written table is far smaller than its rows: never sent to the tasks.
    return docs.join(found.hint("merge"), key, "left")


def with_model_types(docs: DataFrame, model: BayesModel, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """C8 for ``method="ml"``: ``docs`` with the trained model's type and its probability (``ml_type``, ``ml_confidence``)."""
    found = cut_lineage(score_bayes(model, docs, key, text_col).select(
        key, F.col("label").alias("ml_type"), X.round_half_up(F.col("probability"), 3).alias("ml_confidence")), "model-types")
    return docs.join(found.hint("merge"), key, "left")  # grows with the corpus: never sent to the tasks


def type_distribution(rev: DataFrame, batch_col: str) -> DataFrame:
    """A1: documents per predicted type in each batch."""
    return rev.groupBy(batch_col, "predicted_type").agg(F.count(F.lit(1)).alias("documents"))


def confidence_summary(rev: DataFrame, batch_col: str) -> DataFrame:
    """A2: mean confidence per batch (integer thousandths summed, divided once; 0 if empty)."""
    return rev.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(
            F.sum(F.round(F.col("confidence") * 1000).cast("long")).cast("double")
            / F.count(F.lit(1)).cast("double") / F.lit(1000.0),
            F.lit(0.0),
        ).alias("avg_confidence"),
    )


def severity_counts(rev: DataFrame, batch_col: str, flag_rules: DataFrame | list | None = None) -> DataFrame:
    """A3 + A4: flags per severity and batch; High/Medium/Low (and every severity of the pack that the
    documents were reviewed with, ``flag_rules``) always present.

    Each document contributes one counter per severity; a single ``groupBy(batch)`` with
    map-side partial sums gives every batch its zero-filled counts (one exchange).
    """
    sevs = severities(FL.load_flag_rules(flag_rules, rev.sparkSession))
    per_doc = rev.select(batch_col, *[F.size(F.filter("flag_severities", _equals(v))).alias(f"_s{i}")
                                      for i, v in enumerate(sevs)])
    sums = per_doc.groupBy(batch_col).agg(*[F.sum(f"_s{i}").cast("long").alias(f"_s{i}") for i in range(len(sevs))])
    rows = F.array(*[F.struct(F.lit(v).alias("severity"), F.col(f"_s{i}").alias("issues")) for i, v in enumerate(sevs)])
    return X.inline_rows(sums, [batch_col], rows, "severity")


def batch_summary(rev: DataFrame, batch_col: str) -> DataFrame:
    """A4 with A2: documents, total issues and mean confidence per batch."""
    per_doc = rev.select(batch_col, F.size("flags").alias("n_flags"), "confidence")
    return per_doc.groupBy(batch_col).agg(
        F.count(F.lit(1)).cast("long").alias("documents"),
        F.sum("n_flags").cast("long").alias("total_issues"),
        (F.sum(F.round(F.col("confidence") * 1000).cast("long")).cast("double")
         / F.count(F.lit(1)).cast("double") / F.lit(1000.0)).alias("avg_confidence"),
    )


def _equals(value: str):
    return lambda x: x == F.lit(value)


def severities(flag_rules: list[FL.FlagRule]) -> list[str]:
    """High, Medium and Low, then every other severity of the pack."""
    return list(dict.fromkeys(RP.SEVERITIES + [r.severity for r in flag_rules]))


def batch_type_counts(rev: DataFrame, batch_col: str, key: str = "doc_id", sevs: list[str] | None = None) -> DataFrame:
    """(batch, type) rows with document, issue and severity counts: the one shuffle of the batch outputs."""
    sevs = sevs or RP.SEVERITIES
    sev = F.col("flag_severities")
    per_doc = rev.select(
        batch_col, key, F.col("predicted_type").alias("doc_type"),
        F.round(F.col("confidence") * 1000).cast("long").alias("conf_k"),
        F.size("flags").cast("long").alias("n_flags"),
        *[F.size(F.filter(sev, _equals(s))).cast("long").alias(f"n_{i}") for i, s in enumerate(sevs)],
    )
    return per_doc.groupBy(batch_col, "doc_type").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first_doc"), F.sum("conf_k").alias("conf_k"),
        F.sum("n_flags").alias("n_flags"), *[F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(sevs))],
    )


def summary_report(rev: DataFrame, batch_col: str, key: str = "doc_id", process_rules=None,
                   requirements=None, flag_rules: DataFrame | list | None = None) -> DataFrame:
    """A5: the Markdown summary of each batch, from one (batch, type) aggregate that is gathered per batch.

    The breakdown has a line for High, Medium and Low and for every other severity of the pack that the documents were
    reviewed with (``flag_rules``).
    """
    sevs = severities(FL.load_flag_rules(flag_rules, rev.sparkSession))
    bt = batch_type_counts(rev, batch_col, key, sevs)
    summ = bt.groupBy(batch_col).agg(
        F.sum("n").cast("long").alias("documents_provided"), F.sum("n_flags").cast("long").alias("total_issues"),
        (F.sum("conf_k").cast("double") / F.sum("n").cast("double") / F.lit(1000.0)).alias("avg_confidence"),
        *[F.sum(f"n_{i}").cast("long").alias(f"n_{i}") for i in range(len(sevs))],
        F.sort_array(F.collect_list(F.struct("first_doc", "doc_type", "n"))).alias("types"),
        F.map_from_entries(F.collect_list(F.struct("doc_type", "n"))).alias("_types"),
    )
    j = K.with_compliance(summ, process_rules, requirements)
    type_lines = F.array_join(
        F.transform(F.col("types"), lambda t: F.format_string(
            "- **%s**: %d document(s)\n", X.title_words(t["doc_type"]), t["n"])), "")
    recs = F.col("recommendations")
    rec_block = F.when(F.size(recs) > 0, F.concat(
        F.lit("\n## Recommendations\n"),
        F.array_join(F.transform(F.slice(recs, 1, 3), lambda r: F.concat(F.lit("- "), r, F.lit("\n"))), ""),
    )).otherwise("")

    report = F.concat(
        F.lit(RP.REPORT_TITLE + "\n\n## Overview\n"),
        F.format_string("- **Documents Processed**: %d\n", F.col("documents_provided")),
        F.format_string("- **Total Issues Identified**: %d\n", F.col("total_issues")),
        F.concat(F.lit("- **Average Classification Confidence**: "), X.percent1(F.col("avg_confidence")), F.lit("\n")),
        F.concat(F.lit("- **Compliance Status**: "), F.col("status"), F.lit("\n")),
        F.lit("\n## Document Types Identified\n"),
        type_lines,
        F.lit("\n## Issue Breakdown by Severity\n"),
        # the line of Medium ends in two blanks, as in the reviewed application's report
        *[F.format_string(f"- **{v.replace('%', '%%')} Severity**: %d issues{'  ' if v == 'Medium' else ''}\n", F.col(f"n_{i}"))
          for i, v in enumerate(sevs)],
        F.lit("\n## Compliance Analysis\n"),
        F.concat(F.lit("- **Process**: "), X.title_words(F.col("process")), F.lit("\n")),
        F.concat(F.lit("- **Completeness**: "),
                 F.format_string("%.1f", X.round_half_up(F.col("completeness_percentage"), 1)), F.lit("%\n")),
        F.format_string("- **Missing Documents**: %d\n", F.size("missing_documents")),
        rec_block,
    )
    return j.select(batch_col, report.alias("report"))


def document_report(rev: DataFrame, key: str = "doc_id", batch_col: str | None = None,
                    carry: list[str] | None = None, clauses: DataFrame | list | None = None,
                    flag_rules: DataFrame | list | None = None) -> DataFrame:
    """The nested result record of each document (flat key columns + one struct), built in-row.

    ``flag_rules`` is the pack that the documents were reviewed with. The columns of ``FILE_INFO`` and ``related_references``
    (see ``with_references``) enter the record where the documents carry them.
    """
    spark = rev.sparkSession
    frules = FL.load_flag_rules(flag_rules, spark)
    catalogue = FL.load_clauses(clauses, spark)
    rev = FL.with_comment_count(rev, frules, "_comment_count", "commented" if "commented" in rev.columns else None)
    rev = M.lowered(M.counted(rev))
    ft, w, lower = F.col("full_text"), F.col("_wc"), F.col("_lt")
    score, level = M.readability(ft, w, F.col("_sc"))
    flags = F.col("flags")
    comp_words = M.complexity_columns(ft, F.col("sections"), w)
    record = F.struct(
        F.struct(F.col(key).alias("document"), *([F.col(batch_col).alias("batch")] if batch_col else []),
                 *[c for c in FILE_INFO if c in rev.columns]).alias("file_info"),
        F.struct("predicted_type", "confidence", "method_used", "all_scores", "best_matches",
                 "reasoning").alias("classification"),
        C.explanation_column(F.col("predicted_type"), F.col("confidence"), F.col("method_used"),
                             F.col("best_matches"), F.col("reasoning")).alias("explanation"),
        F.struct(
            w.alias("word_count"),
            F.size("paras").cast("long").alias("paragraph_count"),
            F.size("sections").cast("long").alias("section_count"),
            comp_words[0].alias("complexity"),
        ).alias("structure_analysis"),
        F.struct(
            F.struct(
                F.regexp_count(lower, F.lit("shall")).cast("long").alias("obligations"),
                M.compliance_references(ft).alias("compliance_indicators"),
                F.struct(
                    (lower.contains("party") | lower.contains("parties")).alias("parties"),
                    lower.contains("terms").alias("terms"),
                    lower.contains("conditions").alias("conditions"),
                    lower.contains("consideration").alias("consideration"),
                ).alias("contract_elements"),
                M.risk_terms(lower).alias("risk_indicators"),
            ).alias("legal_elements"),
            F.struct(score.alias("complexity_score"), level.alias("readability_level")).alias("readability"),
            M.key_phrases(ft, 5).alias("key_phrases"),
            F.transform(M.organisation_matches(ft, 5),
                        lambda t: F.struct(t.alias("text"), F.lit("ORGANIZATION").alias("label"))).alias(
                "named_entities"),
        ).alias("content_analysis"),
        F.struct(
            flags.alias("red_flags"),
            F.size(flags).cast("long").alias("issues"),
            FL.suggestion_array(flags, frules, catalogue).alias("legal_suggestions"),
            F.col("_comment_count").alias("review_comments_count"),
            *([F.coalesce("related_references", F.array().cast(REFERENCES_TYPE)).alias("related_references")]
              if "related_references" in rev.columns else []),
        ).alias("review"),
    )
    return rev.select(key, *([batch_col] if batch_col else []), record.alias("report"), *(carry or []))


def error_log(errors: DataFrame, key: str = "doc_id") -> DataFrame:
    """S6 for quarantined rows: ``!! Error processing name: reason``."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("(no id)"))
    return errors.select(key, F.concat(F.lit("!! Error processing "), name, F.lit(": "), F.col("error")).alias("log_line"))


def knowledge_line(index: PassageIndex) -> str:
    """The log's line on the knowledge base."""
    sources = index.passages.select("source_name").distinct().count() if "source_name" in index.passages.columns else index.n_passages
    return RP.LOG_KNOWLEDGE % sources


def processing_log(rev: DataFrame, key: str = "doc_id") -> DataFrame:
    """``>> name: type (p%) | n issues`` per document."""
    return rev.select(
        key,
        F.concat(
            F.lit(">> "), F.col(key).cast("string"), F.lit(": "), F.col("predicted_type"), F.lit(" ("),
            X.percent1(F.col("confidence")), F.lit(") | "), F.size("flags").cast("string"), F.lit(" issues"),
        ).alias("log_line"),
    )
