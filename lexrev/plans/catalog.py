"""Registered queries: one per operator family of the inventory, each over whole tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in ``lexrev.plans.oracle``.  Array results are
rendered as delimited strings so both engines hash them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexrev.functions import text as X
from lexrev.operators import classify as C
from lexrev.operators import compliance as K
from lexrev.operators import flags as FL
from lexrev.operators import measures as M
from lexrev.operators import passage_index as PI
from lexrev.operators import retrieval as R
from lexrev.operators import segment as S
from lexrev.operators import textmodel as TM
from lexrev.operators import vector_index as VI
from lexrev.plans import review as RV
from lexrev.session import broadcast_if_small, cut_lineage, scratch_path
from lexrev.sources.corpus import (FILE_INFO, read_documents, read_table, split_quarantine, with_file_metadata,
                                   with_processing_order)
from lexrev.sources.rules import FLAG_RULES_SCHEMA, default_rulepack
from lexrev.sources.seeds import CUSTOM_FLAG_RULES, SEARCHED_FLAG_RULES, faulty_documents, phrase_rules, seeded_documents

BATCH = "source"


def documents(spark: SparkSession, sf: str, spread: bool = True) -> DataFrame:
    return read_documents(spark, f"{sf}/documents.parquet", ["doc_id", "text", BATCH], spread=spread)


def seeded(spark: SparkSession, sf: str) -> DataFrame:
    return seeded_documents(documents(spark, sf))


def _join(c, sep="|"):
    return F.array_join(c, sep)


def _reviewed(spark, sf, method="ensemble"):
    return RV.reviewed(seeded(spark, sf), method=method, keep=[BATCH])


# ------------------------------------------------------------------ flags (F) and the flagship
def q_flags_by_severity(spark, sf):
    rules = FL.load_flag_rules(None, spark)
    return RV.severity_counts(RV.flagged(seeded(spark, sf), rules, keep=[BATCH]), BATCH, rules)


def custom_flag_rules(spark):
    """A pack other than the default one, with a fourth severity, a named group and one unusable pattern."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(CUSTOM_FLAG_RULES)], FLAG_RULES_SCHEMA)


def q_flags_by_severity_custom(spark, sf):
    rules = FL.load_flag_rules(custom_flag_rules(spark))
    return RV.severity_counts(RV.flagged(seeded(spark, sf), rules, keep=[BATCH]), BATCH, rules)


def q_red_flags_searched(spark, sf):
    """F1 with rules that Java cannot run as Python does, beside a compiled one."""
    rules = spark.createDataFrame([(i, *r[:-1]) for i, r in enumerate(SEARCHED_FLAG_RULES)], FLAG_RULES_SCHEMA)
    return FL.scan_flags(seeded(spark, sf), rules).select(
        "doc_id", "rule_id", "occurrence", "matched_text", "start", "end", "severity", "category")


def q_red_flags(spark, sf):
    return FL.scan_flags(seeded(spark, sf)).select(
        "doc_id", "rule_id", "occurrence", "matched_text", "start", "end", "severity", "category")


def q_review_comments(spark, sf):
    return FL.review_comments(seeded(spark, sf), mode="reference").drop("text")


def q_review_comments_paragraph(spark, sf):
    return FL.review_comments(seeded(spark, sf), mode="paragraph").drop("text")


def q_issue_table(spark, sf):
    return FL.issue_table(FL.review_comments(seeded(spark, sf), mode="reference"))


def q_clause_suggestions(spark, sf):
    return FL.suggest_clauses(FL.scan_flags(seeded(spark, sf)))


def q_annotations(spark, sf):
    a = FL.annotate(seeded(spark, sf), mode="reference").where(F.col("n_comments") > 0)
    return a.withColumn("comment_colors", _join(F.col("comment_colors"), ","))


# ------------------------------------------------------------------ segmentation (P)
def q_paragraphs(spark, sf):
    return S.paragraphs(seeded(spark, sf))


def q_sections(spark, sf):
    return S.sections(seeded(spark, sf)).drop("paragraphs")


def q_text_tables(spark, sf):
    t = S.text_tables(seeded(spark, sf))
    cells = F.array_join(F.transform(F.col("rows"), lambda r: F.array_join(r, "\t")), "\n")
    return t.select("doc_id", "table_idx", "first_line", cells.alias("cells"), "row_count", "column_count",
                    "has_headers", "table_type")


def q_document_structure(spark, sf):
    return S.document_structure(seeded(spark, sf))


# ------------------------------------------------------------------ measures (T)
def q_document_stats(spark, sf):
    return M.document_stats(seeded(spark, sf))


def q_text_analysis(spark, sf):
    return M.text_analysis(seeded(spark, sf))


def q_legal_elements(spark, sf):
    e = M.legal_elements(seeded(spark, sf))
    return e.select("doc_id", "obligations", "parties", "terms", "conditions", "consideration",
                    _join(F.col("compliance_indicators")).alias("compliance_indicators"),
                    _join(F.col("risk_indicators")).alias("risk_indicators"),
                    _join(F.col("legal_terms")).alias("legal_terms"))


def q_key_phrases(spark, sf):
    k = M.key_phrase_table(seeded(spark, sf))
    return k.select("doc_id", F.size("key_phrases").cast("long").alias("n_phrases"),
                    _join(F.col("key_phrases")).alias("key_phrases"))


def q_organisations(spark, sf):
    return M.organisations(seeded(spark, sf))


def q_features(spark, sf):
    return M.features(seeded(spark, sf))


# ------------------------------------------------------------------ classification (C)
def q_rule_hits(spark, sf):
    return C.rule_hits(seeded(spark, sf))


def q_rule_hits_large(spark, sf):
    """C1 with a pack of thousands of rules, keywords and patterns, that the benchmark passages give."""
    return C.rule_hits(seeded(spark, sf), phrase_rules(read_table(spark, sf, "benchmark")))


def q_type_scores(spark, sf):
    return C.type_scores(seeded(spark, sf))


def _classified(spark, sf, method):
    c = C.classify(seeded(spark, sf), method=method)
    ev = F.col("best_matches")
    return c.select("doc_id", "predicted_type", "confidence", "method_used", "evidence_types", "has_evidence",
                    "reasoning", _join(ev["primary"]).alias("primary_hits"),
                    _join(ev["secondary"]).alias("secondary_hits"), _join(ev["patterns"]).alias("pattern_hits"),
                    _join(ev["sections"]).alias("section_hits"))


def q_classification(spark, sf):
    return _classified(spark, sf, "ensemble")


def q_classification_rule_based(spark, sf):
    return _classified(spark, sf, "rule_based")


def _wide_rules(spark):
    return default_rulepack(spark, "type_rules", wide=True)


def q_classification_wide(spark, sf):
    """C3-C6 with the ten-type lexicon (more document types, so more filing processes are reachable)."""
    c = C.classify(seeded(spark, sf), type_rules=_wide_rules(spark), method="ensemble")
    ev = F.col("best_matches")
    return c.select("doc_id", "predicted_type", "confidence", "method_used", "evidence_types", "has_evidence",
                    "reasoning", _join(ev["primary"]).alias("primary_hits"),
                    _join(ev["secondary"]).alias("secondary_hits"), _join(ev["patterns"]).alias("pattern_hits"),
                    _join(ev["sections"]).alias("section_hits"))


def q_explanations(spark, sf):
    return C.explain_classification(C.classify(seeded(spark, sf), method="ensemble"))


def q_text_model(spark, sf):
    docs = documents(spark, sf)
    model = TM.train_text_model(docs, read_table(spark, sf, "labels"), label="quality", algo="naive_bayes")
    return TM.score_text_model(model, docs)


def _type_model(spark, docs):
    """A model of document types, trained on the rules' types of documents with evidence and an odd id."""
    by_rule = C.classify(docs.where(F.col("doc_id") % 2 == 1), method="rule_based")
    # Written before the filter, which would be pushed through the projections and carry the whole scoring with it.
    by_rule = cut_lineage(by_rule.select("doc_id", "predicted_type", "has_evidence"), "rule-types").where("has_evidence")
    return TM.fit_bayes(docs, by_rule.select("doc_id", F.col("predicted_type").alias("label")))


def q_classification_ml(spark, sf):
    """A trained model's types in the review (``method="ml"``)."""
    docs = seeded(spark, sf)
    rev = RV.reviewed(RV.with_model_types(docs, _type_model(spark, docs)), method="ml", keep=[BATCH])
    return rev.select("doc_id", BATCH, "predicted_type", "confidence", "method_used")


def q_text_model_terms(spark, sf):
    """Vocabulary, idf and log probabilities (above the label's default) of the model of document quality."""
    labels = read_table(spark, sf, "labels").groupBy("doc_id").agg(F.min("quality").cast("string").alias("label"))
    m = TM.fit_bayes(documents(spark, sf), labels)
    d = F.col("deltas")
    return m.terms.select("term", F.round("idf", 6).alias("idf"), F.round(F.coalesce(d["0"], F.lit(0.0)), 6).alias("delta_0"),
                          F.round(F.coalesce(d["1"], F.lit(0.0)), 6).alias("delta_1"))


# ------------------------------------------------------------------ compliance (K)
def _cls(spark, sf):
    return C.classify(seeded(spark, sf), method="ensemble", keep=[BATCH])


def q_process(spark, sf):
    return K.determine_process(_cls(spark, sf), BATCH)


def q_compliance(spark, sf):
    c = K.compliance(_cls(spark, sf), BATCH)
    return c.select(BATCH, "process", "status", "completeness_percentage", "total_required", "documents_provided",
                    "documents_matched", _join(F.col("missing_documents")).alias("missing_documents"),
                    _join(F.col("extra_documents")).alias("extra_documents"),
                    _join(F.col("recommendations")).alias("recommendations"))


def q_compliance_wide(spark, sf):
    cls = C.classify(seeded(spark, sf), type_rules=_wide_rules(spark), method="ensemble", keep=[BATCH])
    c = K.compliance(cls, BATCH)
    return c.select(BATCH, "process", "status", "completeness_percentage", "total_required", "documents_provided",
                    "documents_matched", _join(F.col("missing_documents")).alias("missing_documents"),
                    _join(F.col("extra_documents")).alias("extra_documents"),
                    _join(F.col("recommendations")).alias("recommendations"))


def _sets(spark, sf, kind, *keep):
    sets = K.compliance_sets(_cls(spark, sf), BATCH)
    return X.explode_rows(sets, [BATCH, *keep], F.col(f"{kind}_documents"), "doc_type")


def q_missing_documents(spark, sf):
    return _sets(spark, sf, "missing", "process")


def q_extra_documents(spark, sf):
    return _sets(spark, sf, "extra")


def q_matched_documents(spark, sf):
    return _sets(spark, sf, "matched")


def q_recommendations(spark, sf):
    return K.recommendations(q_missing_documents(spark, sf), BATCH)


# ------------------------------------------------------------------ batch analytics (A) and reports
def q_type_distribution(spark, sf):
    return RV.type_distribution(_reviewed(spark, sf), BATCH)


def q_confidence_summary(spark, sf):
    return RV.confidence_summary(_reviewed(spark, sf), BATCH)


def q_batch_summary(spark, sf):
    return RV.batch_summary(_reviewed(spark, sf), BATCH)


def q_summary_report(spark, sf):
    return RV.summary_report(_reviewed(spark, sf), BATCH)


def q_document_report(spark, sf):
    r = RV.document_report(_reviewed(spark, sf), batch_col=BATCH)
    rep = F.col("report")
    ca = rep["content_analysis"]
    return r.select(
        "doc_id", BATCH,
        rep["classification"]["predicted_type"].alias("predicted_type"),
        rep["classification"]["confidence"].alias("confidence"),
        rep["structure_analysis"]["word_count"].alias("word_count"),
        rep["structure_analysis"]["paragraph_count"].alias("paragraph_count"),
        rep["structure_analysis"]["section_count"].alias("section_count"),
        rep["structure_analysis"]["complexity"].alias("complexity"),
        ca["readability"]["complexity_score"].alias("complexity_score"),
        ca["readability"]["readability_level"].alias("readability_level"),
        _join(ca["key_phrases"]).alias("key_phrases"),
        _join(F.transform(ca["named_entities"], lambda e: e["text"])).alias("named_entities"),
        rep["review"]["issues"].alias("issues"),
        F.size(rep["review"]["legal_suggestions"]).cast("long").alias("suggestions"),
        rep["review"]["review_comments_count"].alias("review_comments_count"),
        rep["explanation"].alias("explanation"),
    )


def q_processing_log(spark, sf):
    return RV.processing_log(_reviewed(spark, sf))


def q_file_metadata(spark, sf):
    """S3: the file each document row was read from (name and size); rows-only check."""
    d = with_file_metadata(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id"))
    return d.select("doc_id", "filename", "file_size")


def q_quarantine(spark, sf):
    """S4 on documents of which some get a null, repeated or blank key or text."""
    good, errors = split_quarantine(faulty_documents(documents(spark, sf, spread=False)))  # no CPU-heavy work
    return errors.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("(no id)")).alias("doc_id"), "error")


# ------------------------------------------------------------------ retrieval (R)
def q_chunks(spark, sf):
    c = R.chunk_text(documents(spark, sf))
    return c.select("doc_id", "chunk_no", "start", F.length("text").cast("long").alias("chunk_len"), "text")


def q_knn_centroids(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    k = R.knn(R.label_centroids(emb), emb, k=3)
    return k.select("query_id", "rank", "vec_id", F.round("distance", 6).alias("distance"), "relevance")


def q_related_passages(spark, sf):
    bench = read_table(spark, sf, "benchmark").select(F.col("item_id").alias("chunk_id"), "text")
    return R.related_passages(documents(spark, sf), bench, k=3)


def q_split_chunks(spark, sf):
    """R1 cut at separators."""
    c = R.split_text(documents(spark, sf))
    return c.select("doc_id", "chunk_no", "start", F.length("text").cast("long").alias("chunk_len"), "text")


KNN_K = 10


def _knn_queries(emb):
    """The stated query set of vector searches: every vector whose id is divisible by 20."""
    return emb.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))


def q_knn_queries(spark, sf):
    """R3, exact, for a corpus of queries."""
    emb = read_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return R.knn(_knn_queries(emb), emb, k=KNN_K).withColumn("distance", F.round("distance", 6))


def q_knn_index(spark, sf):
    """R3 by the cell index."""
    emb = read_table(spark, sf, "embeddings")
    index = VI.build_index(emb, scratch_path(spark, "vector-index"))
    return VI.search(_knn_queries(emb), index, k=KNN_K)


def knowledge_index(spark, sf):
    """A passage index of the benchmark texts, cut at separators."""
    chunks = R.split_text(read_table(spark, sf, "benchmark"), key="item_id")
    return PI.build_index(chunks.select(F.concat_ws("#", "item_id", "chunk_no").alias("chunk_id"), "text"),
                          scratch_path(spark, "knowledge"))


def q_document_report_references(spark, sf):
    """S5 with file information, processing order and related references in the record."""
    scan = with_file_metadata(spark.read.parquet(f"{sf}/documents.parquet")).select(
        "doc_id", "text", BATCH, "filename", "file_size")
    docs = RV.with_references(seeded_documents(with_processing_order(scan)), knowledge_index(spark, sf))
    rev = RV.reviewed(docs, keep=[BATCH, *FILE_INFO, "related_references"])
    rep = F.col("report")
    refs = rep["review"]["related_references"]
    return RV.document_report(rev, batch_col=BATCH).select(
        "doc_id", rep["file_info"]["filename"].alias("filename"), rep["file_info"]["processing_order"].alias("processing_order"),
        rep["classification"]["predicted_type"].alias("predicted_type"), rep["review"]["issues"].alias("issues"),
        _join(F.transform(refs, lambda r: F.format_string("%s %.6f %s", r["passage"], r["score"], r["relevance"]))).alias("related_references"),
        F.sha2(F.coalesce(F.get(refs, F.lit(0))["content"], F.lit("")), 256).alias("best_sha256"))


def q_processing_order(spark, sf):
    """S3: every document's file and place in the processing order, with the number of documents of its file."""
    scan = with_file_metadata(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"))
    numbered = with_processing_order(scan.select("doc_id", "lang", "filename"))
    per_file = numbered.groupBy("filename").agg(F.count("*").alias("file_rows"))
    return numbered.join(broadcast_if_small(per_file), "filename").select("doc_id", "filename", "processing_order", "file_rows")


# The same operators on the unmodified documents table (no fixture clauses).
def q_paragraphs_raw(spark, sf):
    return S.paragraphs(documents(spark, sf))


def q_sections_raw(spark, sf):
    return S.sections(documents(spark, sf)).drop("paragraphs")


def q_text_tables_raw(spark, sf):
    t = S.text_tables(documents(spark, sf))
    cells = F.array_join(F.transform(F.col("rows"), lambda r: F.array_join(r, "\t")), "\n")
    return t.select("doc_id", "table_idx", "first_line", cells.alias("cells"), "row_count", "column_count",
                    "has_headers", "table_type")


def q_document_stats_raw(spark, sf):
    return M.document_stats(documents(spark, sf))


def q_text_analysis_raw(spark, sf):
    return M.text_analysis(documents(spark, sf))


def q_key_phrases_raw(spark, sf):
    k = M.key_phrase_table(documents(spark, sf))
    return k.select("doc_id", F.size("key_phrases").cast("long").alias("n_phrases"),
                    _join(F.col("key_phrases")).alias("key_phrases"))


def q_classification_raw(spark, sf):
    c = C.classify(documents(spark, sf), method="ensemble")
    ev = F.col("best_matches")
    return c.select("doc_id", "predicted_type", "confidence", "method_used", "evidence_types", "has_evidence",
                    "reasoning", _join(ev["primary"]).alias("primary_hits"),
                    _join(ev["secondary"]).alias("secondary_hits"), _join(ev["patterns"]).alias("pattern_hits"),
                    _join(ev["sections"]).alias("section_hits"))


def q_conversation_turns(spark, sf):
    """Second corpus: every conversation turn reviewed as a short document, in one projection."""
    conv = read_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    d = S.with_structure(conv)
    ft = F.col("full_text")
    score, level = M.readability(ft)
    out = d.select(
        "conv_id", "turn", *M.stats_columns(F.col("paras"), F.col("sections"), F.col("tables"), ft),
        score.alias("complexity_score"), level.alias("readability_level"),
        M.average_word_length(ft).alias("average_word_length"),
        F.regexp_count(ft, F.lit(M.PASSIVE_REGEX)).cast("long").alias("passive_voice_count"),
    )
    return out.select("conv_id", "turn", "word_count", "sentence_count", "character_count", "unique_words",
                      "complexity_score", "readability_level", "average_word_length", "passive_voice_count")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flags_by_severity": q_flags_by_severity,
    "flags_by_severity_custom": q_flags_by_severity_custom,
    "red_flags": q_red_flags,
    "red_flags_searched": q_red_flags_searched,
    "review_comments": q_review_comments,
    "review_comments_paragraph": q_review_comments_paragraph,
    "issue_table": q_issue_table,
    "clause_suggestions": q_clause_suggestions,
    "annotations": q_annotations,
    "paragraphs": q_paragraphs,
    "sections": q_sections,
    "text_tables": q_text_tables,
    "document_structure": q_document_structure,
    "document_stats": q_document_stats,
    "text_analysis": q_text_analysis,
    "legal_elements": q_legal_elements,
    "key_phrases": q_key_phrases,
    "organisations": q_organisations,
    "features": q_features,
    "rule_hits": q_rule_hits,
    "rule_hits_large": q_rule_hits_large,
    "type_scores": q_type_scores,
    "classification": q_classification,
    "classification_rule_based": q_classification_rule_based,
    "classification_wide": q_classification_wide,
    "explanations": q_explanations,
    "text_model": q_text_model,
    "text_model_terms": q_text_model_terms,
    "classification_ml": q_classification_ml,
    "process": q_process,
    "compliance": q_compliance,
    "compliance_wide": q_compliance_wide,
    "missing_documents": q_missing_documents,
    "extra_documents": q_extra_documents,
    "matched_documents": q_matched_documents,
    "recommendations": q_recommendations,
    "type_distribution": q_type_distribution,
    "confidence_summary": q_confidence_summary,
    "batch_summary": q_batch_summary,
    "summary_report": q_summary_report,
    "document_report": q_document_report,
    "processing_log": q_processing_log,
    "quarantine": q_quarantine,
    "file_metadata": q_file_metadata,
    "chunks": q_chunks,
    "knn_centroids": q_knn_centroids,
    "related_passages": q_related_passages,
    "split_chunks": q_split_chunks,
    "knn_queries": q_knn_queries,
    "knn_index": q_knn_index,
    "document_report_references": q_document_report_references,
    "processing_order": q_processing_order,
    "paragraphs_raw": q_paragraphs_raw,
    "sections_raw": q_sections_raw,
    "text_tables_raw": q_text_tables_raw,
    "document_stats_raw": q_document_stats_raw,
    "text_analysis_raw": q_text_analysis_raw,
    "key_phrases_raw": q_key_phrases_raw,
    "classification_raw": q_classification_raw,
    "conversation_turns": q_conversation_turns,
}
