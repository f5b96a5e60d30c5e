from pyspark.sql import functions as F

from lexrev.operators import flags as FL
from lexrev.operators import segment as S

X5 = "This agreement is governed by UAE Federal Courts and shall be subject to UAE law."


def flags_of(docs, *texts):
    return FL.scan_flags(docs(*texts)).orderBy("doc_id", "rule_id", "start").collect()


def test_reference_red_flag_check(docs):
    f = flags_of(docs, X5)
    assert [(r.matched_text, r.start, r.end, r.severity) for r in f] == [
        ("UAE Federal Courts", 30, 48, "High"), ("UAE law", 73, 80, "High"), ("subject to UAE law", 62, 80, "High")]


def test_registration_lookahead_and_word_boundaries(docs):
    f = flags_of(docs, "registered in UAE.", "Incorporated in UAE ADGM",
                 "registered in  United Arab Emirates Abu Dhabi Global Market", "UAE lawsuit")
    got = {(r.doc_id, r.rule_id) for r in f}
    assert (0, 4) in got and (1, 4) not in got and (2, 4) not in got and (3, 2) in got


def test_offsets_in_code_points(docs):
    f = flags_of(docs, "\U0001F600\U0001F600 UAE law")
    assert (f[0].start, f[0].end) == (3, 10)


def test_offsets_invariant(docs):
    texts = [X5 + "\n\U0001F600 governed by UAE legislation; UAE laws apply.", "shall  be void and shall be VOID"]
    d = S.with_structure(docs(*texts))
    f = FL.scan_flags(d)
    bad = f.join(d.select("doc_id", "full_text"), "doc_id").where(
        F.expr("substring(full_text, start + 1, `end` - start)") != F.col("matched_text"))
    assert bad.count() == 0 and f.count() == 7


def test_match_spanning_paragraphs(docs):
    d = docs("It is governed by\nUAE legislation today.")
    assert [r.rule_id for r in FL.scan_flags(d).collect()] == [3]
    assert FL.review_comments(d, mode="reference").where("rule_id = 3").count() == 0


def test_comment_modes(docs):
    d = docs("UAE law one.\nUAE law two.")
    ref = FL.review_comments(d, mode="reference").collect()
    par = FL.review_comments(d, mode="paragraph").collect()
    assert sum(r.copies for r in ref) == 4 and len(ref) == 2
    assert sum(r.copies for r in par) == 2


def test_suggestion_and_catalogue(spark, docs):
    s = FL.suggest_clauses(FL.scan_flags(docs(X5))).orderBy("rule_id").collect()
    assert s[0].category == "jurisdiction" and s[0].context_note == "Suggested replacement for: UAE Federal Courts"
    assert {r.category for r in s} == {"jurisdiction", "governing_law"}
    from lexrev.sources.rules import all_clauses
    assert all_clauses(spark).count() == 3


def test_annotation(docs):
    d = docs("This is a test paragraph.\nThis contract is governed by UAE Federal Courts.")
    a = {r.idx: r for r in FL.annotate(d).collect()}
    assert a[0].annotated_text == "This is a test paragraph." and a[0].highlight is None
    assert a[1].annotated_text == ("This contract is governed by UAE Federal Courts. [ADGM Review: Incorrect "
                                   "jurisdiction reference - Replace with ADGM Courts | Legal Reference: ADGM Courts "
                                   "Regulations 2020, Section 3]")
    assert a[1].highlight == "high"


def test_last_comment_decides_highlight(docs):
    a = FL.annotate(docs("UAE law, and it shall be void.")).first()
    assert a.n_comments == 2 and a.highlight == "medium"


def test_issue_excerpt(docs):
    t80 = "UAE law " + "x" * 72
    t81 = t80 + "y"
    rows = FL.issue_table(FL.review_comments(docs(t80, t81), mode="reference")).orderBy("doc_id").collect()
    assert rows[0].excerpt == t80 and rows[1].excerpt == t80 + "..."


def test_many_matches_in_one_document(docs):
    import re
    text = " ".join(f"w{i} UAE law" for i in range(5000))
    f = FL.scan_flags(docs(text)).where("rule_id = 2").orderBy("start").collect()
    want = [m.start() for m in re.finditer(r"UAE\s+(?:law|laws|legal system)", text, re.IGNORECASE)]
    assert [r.start for r in f] == want and len(want) == 5000
    assert all(text[r.start:r.end] == r.matched_text for r in f)


def test_prefilter_keeps_unicode_case_folding(docs):
    import re
    from lexrev import rulepacks as RP
    texts = ["it ſhall be void", "UAE LAW applies", "Ünited: uae law", "nothing here", "registered in uae."]
    got = sorted((r.doc_id, r.rule_id, r.start, r.end) for r in FL.scan_flags(docs(*texts)).collect())
    want = sorted((i, k, m.start(), m.end()) for i, t in enumerate(texts)
                  for k, rule in enumerate(RP.FLAG_RULES) for m in re.finditer(rule[0], t, re.IGNORECASE))
    assert got == want and len(want) == 4


def test_comment_font_colours(docs):
    a = FL.annotate(docs("UAE law, and it shall be void.")).first()
    assert a.comment_colors == ["8B0000", "B8860B"] and a.highlight_color == "YELLOW"
