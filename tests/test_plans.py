"""Physical-plan checks: the shapes the design promises, on every registered query."""

import pytest

from lexrev.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
MAP_ONLY = ["red_flags", "paragraphs", "sections", "text_tables", "document_structure", "document_stats",
            "text_analysis", "legal_elements", "key_phrases", "organisations", "features", "rule_hits",
            "type_scores", "classification", "classification_rule_based", "explanations", "review_comments",
            "review_comments_paragraph", "issue_table", "annotations", "processing_log", "document_report", "chunks",
            "paragraphs_raw", "sections_raw", "text_tables_raw", "document_stats_raw", "text_analysis_raw",
            "key_phrases_raw", "classification_raw", "conversation_turns"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(q(spark, SF)) for name, q in QUERIES.items() if name not in ("text_model", "file_metadata")}


def test_no_cross_joins_or_python(plans):
    for name, p in plans.items():
        if name == "red_flags_searched":  # rules that only Python's engine can run
            continue
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in p, (name, bad)


def test_per_document_queries_are_map_only(plans):
    # the only exchange allowed is the one that spreads a poorly split scan over the cores
    for name in MAP_ONLY:
        exchanges = [ln for ln in plans[name].splitlines() if "Exchange " in ln and "Broadcast" not in ln]
        assert all("hashpartitioning(doc_id" in ln and "REPARTITION_BY_NUM" in ln for ln in exchanges), (name, exchanges)
        assert all("text" in ln for ln in exchanges), (name, exchanges)
        assert len(exchanges) <= 1, name


def test_scans_are_pruned(plans):
    p = plans["flags_by_severity"]
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in p or \
        "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in p.replace("\n", " ")
    assert "lang" not in p and "n_chars" not in p
    assert "struct<vec_id:bigint,embedding:array<float>>" in plans["knn_centroids"] or "embedding" in plans["knn_centroids"]


def test_top_k_is_limited_before_the_shuffle(spark):
    p = QUERIES["knn_centroids"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_batch_aggregates_are_partial_before_the_exchange(plans):
    # a batch holding a third of all documents is reduced per task before any shuffle
    for name in ("flags_by_severity", "type_distribution", "confidence_summary", "batch_summary"):
        p = plans[name]
        assert "partial_" in p, name
        first_exchange = p.find("Exchange hashpartitioning(source")
        assert first_exchange > 0 and "partial_" in p[first_exchange:], name


def test_set_queries_read_the_documents_once(plans):
    for name in ("missing_documents", "extra_documents", "matched_documents", "recommendations", "compliance",
                 "summary_report"):
        assert plans[name].count("documents.parquet") == 1, name
