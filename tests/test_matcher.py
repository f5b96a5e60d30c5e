import random
import re
import string

import pytest

from lexrev.operators import classify as C
from lexrev.operators import flags as FL
from lexrev.operators import matcher as MT
from lexrev.plans import review as RV
from lexrev.sources.rules import FLAG_RULES_SCHEMA, TYPE_RULES_SCHEMA

PATTERNS = ["x*void|x*", r"(a)?b(?(1)c|d)", r"limited\Z", "[a&&y]b", "(?x) vo id", "s(hall|will) not", r"\bIstanbul\b", "kilo?", "(?:ab|cd){2,}e",
            "(?i:ab)c", "[^a]b", "a.c$", r"\d{3,}", "(?<=the )company", "(?!x)yz", "é(tude|col)", "a|b|", "(ss|ſt)op", r"\0", "(ab)+?c", "term(?=s)"]
TEXTS = ["", "void x xxvoid", "abc bd b ac", "a limited\n", "limited", "yb ab &b", "SHALL NOT, will not", "İstanbul ıstanbul ISTANBUL istanbul", "KILO kil Kilos",
         "ababe cdabe ABCDE abc", "the company THE COMPANY", "xyz yz", "Étude ÉCOL", "ſtop SSOP ssop ſſop", "a\rc\na c", "\x00 12 3456", "terms term", "ababc" * 50]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_every_match_of_python_is_found(pattern):
    m = MT.RuleMatcher([(pattern, True)])
    for t in TEXTS:
        want = [(0, k, x.group(), x.start(), x.end()) for k, x in enumerate(re.finditer(pattern, t, re.IGNORECASE), 1)]
        assert list(m.spans(t)) == want, t
        assert m.hits(t.lower()) == ([0] if re.search(pattern, t.lower(), re.IGNORECASE) else [])


def test_required_literals():
    assert MT.required_literals("shall (be|become) void") == {"shall "}
    assert MT.required_literals("(void|null)x?") == {"void", "null"}
    assert MT.required_literals("(void)?") is None and MT.required_literals("a|") is None and MT.required_literals(r"\d+") is None
    assert MT.required_literals("(?:abc){1,3}") == {"abc"}


def test_random_keywords_and_patterns_against_single_tests():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    rules = [(w if rnd.random() < 0.6 else f"{w}[ab]+{rnd.choice(words)}", False) for w in words]
    rules = [(r, "[" in r) for r, _ in rules] + [("ſ", False), ("İ", False), ("ı", False)]
    texts = [" ".join(rnd.choices(words, k=30)) for _ in range(40)] + ["ſs iı i̇ İ".lower(), "s", "i"]
    for block in (10_000, 17):
        parts = MT.matchers(rules, block)
        assert len(parts) == -(-len(rules) // block)
        for t in texts:
            got = [first + i for first, m in parts for i in m.hits(t)]
            assert got == [i for i, (r, rx) in enumerate(rules) if (re.search(r, t, re.IGNORECASE) if rx else r.lower() in t)]


CHAINS = [r"of[ ,.]+the", r"of[ ,.]+the[ ,.]+ab", r"of +the", r"of\s+the", r"of\s+?the", r"of[ ,]{2,}the", r"of[ ,]{1,2}the", r"of [ ,]+the", r"of t[ ,]+a", r" of[ ,]+the ",
          r"of[ ,]+[.]+the", r"of[ ,]+\s+the", r"(of|ab)[ ,]+the[ ,]+", r"\bof[ ,]+the\b", r"of[ ,]*the", r"of[ ,]+the|x", r"of[ ,]+(the)+", r"of[ ,]++the",
          r"of[^a]+the", r"of[ a]+the", r"(?a)of\s+k", r"of\s+k", r"of\s+is", r"[ ,]+of", r"of[ ,]+", r"of\x00+the", r"(?-i:of)[ ,]+the", r"a[ ,]+a[ ,]+a"]


@pytest.mark.parametrize("pattern", CHAINS)
def test_literals_joined_by_separators(pattern):
    m, rnd = MT.RuleMatcher([(pattern, True)]), random.Random(4)
    parts = ["of", "the", "ab", "a", "OF", "t", "k", "\u212a", "\u0131s", "is", "x", " ", " ", ",", "., ", "\u00a0", "\n", "\x00", "\x1c"]
    for _ in range(3000):
        t = "".join(rnd.choices(parts, k=rnd.randint(0, 9)))
        assert [(s, e) for *_, s, e in m.spans(t)] == [x.span() for x in re.finditer(pattern, t, re.IGNORECASE)], t
        assert m.hits(t.lower()) == ([0] if re.search(pattern, t.lower(), re.IGNORECASE) else []), t


def test_patterns_of_common_words_name_few_candidates():
    words = [a + b for a in "bcdfghjklm" for b in "aeiou"]
    m = MT.RuleMatcher([(f"{a}[ ,.]+{b}", True) for a in words for b in words])
    text = " ".join(words)  # holds every word, and 49 of the 2,500 pairs
    assert len(m.candidates(text)) == len(m.hits(text)) == 49


@pytest.mark.parametrize("pattern,differs", [("a\\Z", True), ("[a&&b]", True), ("[a[b]", True), ("[]a]", True), ("(?x)a b", True), ("\\v", True),
                                             ("[\\[a]", False), ("a&&b", False), ("(?i:a)", False), ("(?:a|x)", False), ("\\\\Z", False), ("(?P<ax>a)", False)])
def test_where_java_differs(pattern, differs):
    assert MT.java_differs(pattern) is differs


def large_pack(n):
    letters = [a + b + c for a in string.ascii_lowercase for b in string.ascii_lowercase for c in string.ascii_lowercase]
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        kind = ("primary", "secondary", "pattern", "section")[i % 4]
        term = rnd.choice(letters) + (rnd.choice("aeiou") if kind == "primary" else f"[a-{rnd.choice('mnz')}]{{1,2}}\\b" if kind == "pattern" else "")
        rows.append((f"t{i % 7}", i % 7, kind, i, term, float(1 + i % 3), kind == "pattern"))
    return rows


@pytest.fixture
def prose(spark):
    rnd = random.Random(6)
    texts = [" ".join("".join(rnd.choice("aeioubdklmnrst") for _ in range(rnd.randint(2, 7))) for _ in range(60)) for _ in range(25)]
    return spark.createDataFrame([*enumerate(texts), (100, None), (101, "")], "doc_id long, text string")


def test_20000_rules_give_the_rows_that_expressions_give_in_parts(spark, prose):
    rows = large_pack(20_000)
    whole = spark.createDataFrame(rows, TYPE_RULES_SCHEMA)
    got = sorted(map(tuple, C.rule_hits(prose, whole).collect()))
    assert len(got) > 1000
    parts = []
    keep = random.Random(1).sample(range(20_000), 400)  # expressions of all rules take minutes to compile
    for k in range(2):
        part = spark.createDataFrame([rows[i] for i in keep[k * 200:(k + 1) * 200]], TYPE_RULES_SCHEMA)
        parts += map(tuple, C.rule_hits(prose, part).collect())
    chosen = {rows[i][3] for i in keep}
    assert sorted(parts) == [r for r in got if r[4] in chosen]
    texts = {r.doc_id: (r.text or "").lower() for r in prose.collect()}
    assert got == sorted((d, t, o, k, n, term, w) for d, x in texts.items() for t, o, k, n, term, w, rx in rows
                         if (re.search(term, x) if rx else term in x))


def test_large_pack_classifies_as_expressions_do(spark, prose, monkeypatch):
    rows = large_pack(120)
    pack = spark.createDataFrame(rows, TYPE_RULES_SCHEMA)
    expected = [C.classify(prose, pack).orderBy("doc_id").collect(), C.type_scores(prose, pack).orderBy("doc_id", "type").collect()]
    monkeypatch.setattr(C, "MAX_COMPILED_RULES", 10)
    assert [C.classify(prose, pack).orderBy("doc_id").collect(), C.type_scores(prose, pack).orderBy("doc_id", "type").collect()] == expected


def test_searched_flags_and_comments_equal_compiled_ones(spark, docs, monkeypatch):
    d = docs("ADGM void law. The law shall be void\n\nvoid\nUAE law UAE law", "", None, "LAW ſhall be VOİD", "no match", "law\nlaw void")
    pack = spark.createDataFrame([(5, "law", "Law", "High", "s", "r", "c"), (2, "shall be void|void", "V", "Critical", "s", "", "d"),
                                  (9, "(a)(b", "x", "Low", "", "", "")], FLAG_RULES_SCHEMA)

    def outputs():
        rules = FL.load_flag_rules(pack)
        rev = RV.reviewed(d, flag_rules=rules, keep=["source"])
        return [sorted(map(str, x.collect())) for x in (
            FL.scan_flags(d, pack), FL.review_comments(d, pack, "reference"), FL.review_comments(d, pack, "paragraph"), FL.annotate(d, pack),
            RV.severity_counts(rev, "source", rules), RV.document_report(rev, flag_rules=rules), RV.summary_report(rev, "source", flag_rules=rules))]

    compiled = outputs()
    assert "Critical Severity" in compiled[-1][0] and len(compiled[0]) > 5
    monkeypatch.setattr(FL, "MAX_COMPILED_RULES", 1)
    assert not any(r.compiled for r in FL.load_flag_rules(pack))
    assert outputs() == compiled


def test_rules_that_match_the_empty_text(spark, docs):
    pack = spark.createDataFrame([(1, "x*void|x*", "a", "High", "", "", ""), (2, "void", "b", "High", "", "", "")], FLAG_RULES_SCHEMA)
    rejected = []
    assert [r.compiled for r in FL.load_flag_rules(pack, rejected=rejected)] == [False, True] and not rejected
    got = [(r.rule_id, r.occurrence, r.matched_text, r.start, r.end) for r in FL.scan_flags(docs("xxvoid void"), pack).collect()]
    assert got == [(i, k, m.group(), m.start(), m.end()) for i, p in ((1, "x*void|x*"), (2, "void"))
                   for k, m in enumerate(re.finditer(p, "xxvoid void", re.IGNORECASE), 1)]
