from pyspark.sql import functions as F

from lexrev.operators import segment as S

X1 = "Article 1: Company Name. The company shall be known as Test Corporation Limited."


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("v")).first().v


def test_reference_parser_check(spark):
    assert one(spark, S.matches_section_pattern, X1) is True
    assert one(spark, S.content_type, X1) == "header"


def test_list_items(spark):
    for t in ["1. a", "(a) q", "- z", "• k", "* star"]:
        assert one(spark, S.is_list_item, t), t
    for t in ["x - y", "a (b)", "(A) upper"]:
        assert not one(spark, S.is_list_item, t), t


def test_all_caps_header_is_not_header_content(spark):
    assert one(spark, S.is_header, "DEFINITIONS AND TERMS") is True
    assert one(spark, S.content_type, "DEFINITIONS AND TERMS") == "short_text"


def test_section_prefixes(spark):
    for t in ["Part in the agreement", "definitionless", "section 12", "WHEREAS, the parties", "Schedule A fees"]:
        assert one(spark, S.matches_section_pattern, t), t
    for t in ["part of it", "schedule b", "whereas", "section 1"]:
        assert not one(spark, S.matches_section_pattern, t), t


def test_content_types_and_significance(spark):
    assert one(spark, S.content_type, "The company shall pay all sums due now.") == "legal_obligation"
    assert one(spark, S.content_type, "In this deed the word Company means the firm.") == "definition"
    assert one(spark, S.content_type, "A plain sentence with six words here.") == "body_paragraph"
    assert one(spark, S.legal_significance, "must pay; liable for breach") == "high"
    assert one(spark, S.legal_significance, "a penalty applies") == "medium"
    assert one(spark, S.legal_significance, "nothing") == "low"


def test_paragraph_index_counts_empty_lines(docs):
    p = S.paragraphs(docs("  first  \n\n   \nsecond")).orderBy("idx").collect()
    assert [(r.idx, r.text) for r in p] == [(0, "first"), (3, "second")]


def test_sections_partition_paragraphs_from_first_opener(docs):
    text = "Preamble text\nARTICLE 1 Name\nbody one\nSection 2 Objects\nbody two\nbody three"
    d = docs(text)
    secs = S.sections(d).orderBy("sec").collect()
    assert [(s.sec, s.title, s.paragraph_count) for s in secs] == [(1, "ARTICLE 1 Name", 2), (2, "Section 2 Objects", 3)]
    assert secs[0].section_text == "ARTICLE 1 Name ARTICLE 1 Name body one"
    assert secs[0].section_type == "legal_provision" and secs[1].importance == "high"
    n_par = S.paragraphs(d).count()
    assert sum(s.paragraph_count for s in secs) == n_par - 1  # the preamble belongs to no section


def test_tables(docs):
    d = docs("Name | Director\nAlice | Yes\n\nAmount | Fee\n\nsolo | row")
    t = {r.table_idx: r for r in S.text_tables(d).collect()}
    assert t[0].rows == [["Name", "Director"], ["Alice", "Yes"]] and t[0].has_headers and t[0].table_type == "personnel_list"
    assert t[1].row_count == 1 and not t[1].has_headers and t[1].table_type == "financial_table"
    assert t[2].table_type == "general_table" and t[2].column_count == 2


def test_document_structure(docs):
    d = docs("TITLE OF DEED\nIntroduction part 1 here\nArticle 2 Definitions\nChapter 9 Final words")
    r = S.document_structure(d).first()
    assert r.has_title and r.has_definitions and r.has_conclusion
    assert r.total_levels == 3 and r.structural_completeness == 1.0
    assert abs(r.organization_score - 1.0) < 1e-12


def test_cased_properties_follow_python(spark):
    from lexrev.functions import text as X
    for t in ["Ⅻ", "ABCª", "ÉTÉ", "ǅX", "123", "ß"]:
        assert one(spark, X.is_upper, t) == t.isupper(), t
    for t in ["Ⅻ Ab", "Ⓐbc", "ǅungla x", "abc", "A1b", "O'Neil"]:
        assert one(spark, X.has_title_word, t) == any(w.istitle() for w in t.split()), t
