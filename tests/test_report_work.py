"""What a document's record costs: shared work is done once, patterns run only where their literals are, all cores take part."""

import re

from pyspark.sql import functions as F

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.operators import classify as C
from lexrev.operators import flags as FL
from lexrev.operators import measures as M
from lexrev.operators.matcher import literals_of
from lexrev.plans import review as RV
from lexrev.sources.corpus import spread_documents
from lexrev.sources.rules import TYPE_RULES_SCHEMA


def test_the_record_lower_cases_a_text_once(docs):
    df = RV.document_report(RV.reviewed(docs("UAE law"), keep=["source"]), batch_col="source")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(full_text") == 1
    assert len(re.findall(r"AS _hits#", plan)) == 1 and len(re.findall(r"AS _unsorted#", plan)) == 1  # columns of their own


def test_few_splits_are_spread_over_all_cores(spark, docs):
    cores = spark.sparkContext.defaultParallelism
    few = docs(*(f"text {i}" for i in range(200))).repartition(cores + 1)  # a second wave would hold one task
    assert spread_documents(few).rdd.getNumPartitions() == 4 * cores
    many = few.repartition(4 * cores)
    assert spread_documents(many) is many


def test_patterns_are_skipped_in_texts_beyond_ascii_that_lack_their_literals(docs):
    rules = FL.load_flag_rules([FL.FlagRule(0, RP.FLAG_RULES[3][0], "i", "High", "s", "", "c")])
    assert literals_of(RP.FLAG_RULES[3][0])[0] == {"uae"}
    d, lacks = FL._with_lacking(docs("Café au lait", "governed by UAE law – Café", "ſhall", "a \u212a", None).withColumnRenamed("text", "full_text"),
                                rules, "full_text")
    got = {r.doc_id: r.x for r in d.select("doc_id", F.coalesce(lacks(rules[0]), F.lit(False)).alias("x")).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False}


def test_characters_that_match_ascii_letters(spark, docs):
    every = "".join(chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000)
    found = docs(every).select(F.regexp_extract_all("text", F.lit("(?iU)[a-z]|" + "|".join(map(chr, range(97, 123)))), F.lit(0))).first()[0]
    assert set(found) == set(X.FOLDED_CHARS)
    texts = ["it ſhall be void", "shall be voıd", "ſhall  be vOİd", "é shall be void", "é shall not be void", ""]
    got = sorted((r.doc_id, r.matched_text) for r in FL.scan_flags(docs(*texts)).where("pattern LIKE 'shall%'").collect())
    assert got == [(0, "ſhall be void"), (1, "shall be voıd"), (2, "ſhall  be vOİd"), (3, "shall be void")]


def test_words_are_those_of_python(docs):
    odd = "".join(chr(c) for c in range(0x3100))
    texts = [odd, " ".join(odd), "a".join(odd), *("x" + ch + "y" for ch in X.PY_WS_CHARS + "\x00\x08\x0e\x1b\x7f\u200b\u180e\ufeff"),
             "a b\tc\r\n d ", "\U0001F600 \U0001F600x é", "", " ", "\x1c"]
    got = {r.doc_id: r.n for r in docs(*texts).select("doc_id", X.word_count("text").alias("n")).collect()}
    assert got == {i: len(t.split()) for i, t in enumerate(texts)}


def test_shared_parts_change_no_hit(spark, docs):
    terms = ["share capital", "shares", "shareholder rights", "capital", "voting rights", "rights", "x", "no part here"]
    pack = spark.createDataFrame([("t", 0, "primary", i, t, 1.0, False) for i, t in enumerate(terms)]
                                 + [("t", 0, "pattern", 0, r"share\s+capital", 1.0, True)], TYPE_RULES_SCHEMA)
    part = X.shared_parts(terms)
    assert part["share capital"] in ("share", "capital") and "x" not in part and all(p in t for t, p in part.items())
    texts = ["Share Capital é", "shareholder rights", "shares and rights", "capita l", "x", "SHARE\n capital", None]
    got = sorted((r.doc_id, r.kind, r.term) for r in C.rule_hits(docs(*texts), pack).collect())
    low = [" ".join(ln.strip() for ln in (t or "").split("\n") if ln.strip()).lower() for t in texts]
    assert got == sorted([(i, "primary", t) for i, x in enumerate(low) for t in terms if t in x]
                         + [(i, "pattern", r"share\s+capital") for i, x in enumerate(low) if re.search(r"share\s+capital", x)])


def test_organisations_need_an_ending(docs):
    texts = ["Acme Holdings Limited and Beta Co", "Acme Holdings", "acme limited", "Gamma Corp. Delta Company Co", None]
    got = {r.doc_id: r.x for r in docs(*texts).select("doc_id", M.organisation_matches(F.col("text")).alias("x")).collect()}
    assert got == {i: [m.group() for m in re.finditer(RP.ORGANISATION_PATTERN, t or "")] for i, t in enumerate(texts)}


def test_organisations_in_long_runs_of_capitalised_words(docs):
    run = "De " * 20000  # far beyond what Java's stack takes when a loop may go back
    long = [run + "end. Contract", "x " + run + "Company", run + "Co " + run + "Ltd " + run + "Corporate. Beta Co"]
    short = ["Company Co Co2 Acme Companyé Beta\u00a0Co-op xGamma Delta\n Ltd Co_ Limited", "Acme Co Be Corp Be, Co Co", "Co"]
    want = [[], [run + "Company"], [run + "Co " + run + "Ltd", "Beta Co"],
            *([m.group() for m in re.finditer(RP.ORGANISATION_PATTERN, t)] for t in short)]
    got = {r.doc_id: r.x for r in docs(*long, *short).select("doc_id", M.organisation_matches(F.col("text")).alias("x")).collect()}
    assert got == dict(enumerate(want)) and [len(x) for x in want] == [0, 1, 2, 3, 2, 0]
    assert [r.text for r in M.organisations(docs(*long)).orderBy("doc_id", "pos").collect()] == want[1] + want[2]
