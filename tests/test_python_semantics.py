"""Third opinion: a plain-Python restatement (``re``/``str`` semantics) against Spark, whole sf0.001 corpus."""

import math
import re

import pyarrow.parquet as pq
import pytest

from lexrev import rulepacks as RP
from lexrev.operators import classify as C
from lexrev.operators import flags as FL
from lexrev.operators import measures as M
from lexrev.operators import segment as S
from lexrev.sources.seeds import SEED_CLAUSES, seeded_documents

PATH = "/root/testdata/sf0.001/documents.parquet"


def seeded_texts():
    t = pq.read_table(PATH, columns=["doc_id", "text"]).to_pydict()
    out = {}
    for d, text in zip(t["doc_id"], t["text"]):
        head, tail = SEED_CLAUSES[d % len(SEED_CLAUSES)]
        out[d] = "\n".join(x for x in (head, text, tail) if x is not None)
    return out


def paragraphs_py(text):
    return [(i, ln.strip()) for i, ln in enumerate((text or "").split("\n")) if ln.strip()]


def full_text_py(text):
    return " ".join(p for _, p in paragraphs_py(text))


@pytest.fixture(scope="module")
def corpus():
    return seeded_texts()


@pytest.fixture(scope="module")
def sdocs(spark):
    return seeded_documents(spark.read.parquet(PATH).select("doc_id", "text", "source"))


def test_full_text_and_stats(corpus, sdocs):
    got = {r.doc_id: r for r in M.document_stats(sdocs).collect()}
    for d, text in corpus.items():
        ft = full_text_py(text)
        r = got[d]
        assert r.word_count == len(ft.split())
        assert r.character_count == len(ft)
        assert r.sentence_count == len(re.findall(r"[.!?]+", ft))
        assert r.unique_words == len(set(ft.lower().split()))
        assert r.paragraph_count == len(paragraphs_py(text))


def test_paragraph_attributes(corpus, sdocs):
    got = {(r.doc_id, r.idx): r for r in S.paragraphs(sdocs).collect()}
    n = 0
    for d, text in corpus.items():
        for i, p in paragraphs_py(text):
            r = got[(d, i)]
            upper = p.isupper() or bool(re.match(RP.HEADER_PATTERN, p, re.IGNORECASE))
            assert r.is_header == upper, p
            assert r.is_list_item == bool(re.match(RP.LIST_ITEM_PATTERN, p))
            assert r.word_count == len(p.split())
            n += 1
    assert n == len(got)


def test_flags_match_python_finditer(corpus, sdocs):
    got = sorted((r.doc_id, r.rule_id, r.start, r.end, r.matched_text) for r in FL.scan_flags(sdocs).collect())
    want = []
    for d, text in corpus.items():
        ft = full_text_py(text)
        for rid, rule in enumerate(RP.FLAG_RULES):
            for m in re.finditer(rule[0], ft, re.IGNORECASE):
                want.append((d, rid, m.start(), m.end(), m.group()))
    assert got == sorted(want) and len(want) > 0


def test_classification_matches_python_scoring(corpus, sdocs):
    got = {r.doc_id: r for r in C.classify(sdocs, method="rule_based").collect()}
    for d, text in corpus.items():
        low = full_text_py(text).lower()
        scores = []
        for typ, kinds in RP.TYPE_LEXICON.items():
            raw = 0.0
            for kind, w in RP.KIND_WEIGHTS.items():
                for term in kinds.get(kind, []):
                    hit = re.search(term, low, re.IGNORECASE) if kind == "pattern" else term.lower() in low
                    raw += w if hit else 0.0
            n_words = len(low.split())
            factor = n_words / 1000.0 if n_words else 1.0
            scores.append((typ, raw / max(factor, 0.1)))
        best = max(scores, key=lambda s: s[1])
        ranked = sorted(scores, key=lambda s: s[1], reverse=True)
        conf = min(1.0, best[1] / 15.0) + min(0.4, (ranked[0][1] - ranked[1][1]) / 10.0)
        conf = min(1.0, conf)
        r = got[d]
        assert r.predicted_type == best[0]
        assert math.isclose(r.confidence, conf, abs_tol=0.0011)


def test_line_ends_and_named_groups(spark):
    from pyspark.sql import functions as F

    from lexrev.functions.text import py_regex

    texts = [f"liability is{c}limited" for c in ("\r", "\x85", " ", " ", "\n", " ")] + ["end\r", "end\n", "end", "aa penalty b", "abab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for p in ("liability.*limited", "end$", "(?P<a>penalty)", "(?P<x>ab)(?P=x)"):
        got = {r.i for r in df.where(F.col("t").rlike(py_regex(p, ignore_case=True))).collect()}
        assert got == {i for i, t in enumerate(texts) if re.search(p, t, re.IGNORECASE)}, p
