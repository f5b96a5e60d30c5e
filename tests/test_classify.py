from pyspark.sql import functions as F

from lexrev.operators import classify as C

X2 = "Articles of Association for Test Company Limited. This document contains governance provisions."
X8 = "Articles of Association.\nThis company is governed by UAE Federal Courts."


def test_mock_document_rule_based(docs):
    d = docs(X2)
    r = C.classify(d, method="rule_based").first()
    assert r.predicted_type == "articles_of_association" and r.confidence == 1.0
    scores = {s.type: s for s in C.type_scores(d).collect()}
    assert scores["articles_of_association"].raw_score == 4.0
    assert scores["articles_of_association"].normalized_score == 40.0
    assert scores["memorandum_of_association"].raw_score == 0.0 and scores["ubo_declaration"].raw_score == 0.0
    assert r.best_matches["primary"] == ["articles of association"] and r.best_matches["sections"] == ["governance"]
    assert r.reasoning == "Matched 1 primary keywords, 0 patterns"


def test_integration_mock_ensemble(docs):
    r = C.classify(docs(X8), method="ensemble").first()
    assert (r.predicted_type, r.confidence, r.evidence_types, r.method_used) == (
        "articles_of_association", 1.0, 1, "ensemble")
    assert r.all_scores["articles_of_association"] == 30.0


def test_no_evidence_gives_first_type(docs):
    for m in ("rule_based", "ensemble", "ml", "other"):
        r = C.classify(docs("", None, "plain words only"), method=m).orderBy("doc_id").collect()
        for row in r:
            assert row.predicted_type == "articles_of_association" and row.confidence == 0.0
            assert row.has_evidence is False
        assert r[0].method_used == ("ensemble" if m == "ensemble" else "rule_based")


def _boost(spark, kinds, conf_score):
    # a best score s with no runner-up difference: confidence = min(1, s/15) when all types tie
    ev = {"primary": ["a"] if kinds >= 1 else [], "secondary": ["b"] if kinds >= 2 else [],
          "patterns": ["c"] if kinds >= 3 else [], "sections": []}
    s = conf_score * 15.0
    row = [(t, o, 1.0, s, ev) for o, t in enumerate(["x", "y"])]
    ddl = ("_scores array<struct<type:string,type_order:int,raw_score:double,score:double,evidence:struct<"
           "primary:array<string>,secondary:array<string>,patterns:array<string>,sections:array<string>>>>")
    df = spark.createDataFrame([(row,)], ddl)
    return df.select(*C.columns_from_scores(F.col("_scores"), 2, "ensemble")).first().confidence


def test_ensemble_boost(spark):
    assert _boost(spark, 2, 0.5) == 0.55
    assert _boost(spark, 3, 0.5) == 0.65
    assert _boost(spark, 3, 0.9) == 1.0
    assert _boost(spark, 1, 0.5) == 0.5


def test_explanation(docs):
    e = C.explain_classification(C.classify(docs(X2), method="rule_based")).first().explanation
    assert e.startswith("Document classified as 'Articles Of Association' with 100.0% confidence using rule_based method.")
    assert "Primary indicators: articles of association\n" in e
    assert e.endswith("\nMatched 1 primary keywords, 0 patterns")


def test_rule_pack_is_data(spark, docs):
    rules = spark.createDataFrame(
        [("alpha", 0, "primary", 0, "zebra", 3.0, False), ("beta", 1, "pattern", 0, r"\bq\w+", 2.5, True)],
        "type string, type_order int, kind string, ord int, term string, weight double, is_regex boolean")
    r = C.classify(docs("a quick zebra", "quiet"), type_rules=rules, method="rule_based").orderBy("doc_id").collect()
    assert [x.predicted_type for x in r] == ["alpha", "beta"]
    hits = C.rule_hits(docs("a quick zebra"), type_rules=rules).count()
    assert hits == 2


def test_literal_prefix():
    from lexrev.functions.text import literal_prefix
    assert literal_prefix(r"objects?\s+of\s+(?:the\s+)?company") == "object"
    assert literal_prefix(r"UBO\s+declaration") == "UBO"
    assert literal_prefix(r"\d+%\s+(?:ownership|interest)") == ""
    assert literal_prefix("ab|c") == "" and literal_prefix("(a|b)c") == "" and literal_prefix(r"a\|b") == "a"


def test_prefilter_keeps_unicode_case_folding(spark, docs):
    import re
    rules = spark.createDataFrame([("t", 0, "pattern", 0, r"article\s+\d+", 2.5, True),
                                   ("t", 0, "pattern", 1, r"share\s+capital", 2.5, True)],
                                  "type string, type_order int, kind string, ord int, term string, weight double, is_regex boolean")
    texts = ["artıcle 5 here", "ſhare capital", "article 7", "plain words", "ARTICLE 9"]
    hits = {(r.doc_id, r.ord) for r in C.rule_hits(docs(*texts), type_rules=rules).collect()}
    for i, t in enumerate(texts):
        for o, p in enumerate([r"article\s+\d+", r"share\s+capital"]):
            assert ((i, o) in hits) == bool(re.search(p, t.lower(), re.IGNORECASE)), (t, p)
