"""Text measures (T1-T15), computed per document inside its row (map-only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.operators import segment as S

PASSIVE_REGEX = X.py_regex(RP.PASSIVE_PATTERN)
LEGAL_TERM_REGEX = X.py_regex("\\b(?:" + "|".join(RP.LEGAL_TERMS) + ")\\b")
CITATION_REGEXES = [X.py_regex(p) for p in RP.CITATION_PATTERNS]
KEY_PHRASE_REGEX = X.py_regex(RP.KEY_PHRASE_PATTERN)
ORGANISATION_ENDINGS = RP.ORGANISATION_PATTERN.rpartition("(?:")[2].partition(")")[0].split("|")


def organisation_regex() -> str:
    """ORGANISATION_PATTERN with loops that never go back; its matches are group 1.

    Java takes stack for each round of a greedy loop over a group: a run of some 2,000 capitalised words overflowed it, which
    ends the executor. A match goes from the run's first word to its last ending, so it is a series of other words and an
    ending each. Runs without one are taken whole, without group 1: they are not searched again from each of their words.
    """
    word, ending = "[A-Z][a-z]++", "(?:" + "|".join(ORGANISATION_ENDINGS) + ")\\b"
    named = f"{word}(?:(?:\\s++(?!{ending}){word})*+\\s++{ending})++"
    return X.py_regex(f"(?=[A-Z])\\b(?:({named})|{word}(?:\\s++{word})++)")


ORGANISATION_REGEX = organisation_regex()


def structured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs if "full_text" in docs.columns else S.with_structure(docs, text_col)


# ----------------------------------------------------------------- T2-T8 column forms
def counted(d: DataFrame, ft: str = "full_text") -> DataFrame:
    """Add ``_wc`` and ``_sc`` (words, sentences of the full text) once, for the measures that reuse them."""
    if "_wc" not in d.columns:
        d = d.withColumn("_wc", X.word_count(F.col(ft)))
    return d.withColumn("_sc", X.sentence_count(F.col(ft)))


def readability(ft: Column, w: Column | None = None, s: Column | None = None) -> tuple[Column, Column]:
    """T4: (complexity_score, readability_level); thresholds test the rounded score."""
    w = X.word_count(ft) if w is None else w
    s = X.sentence_count(ft) if s is None else s
    score = F.when(s == 0, F.lit(0.0)).otherwise(X.round_half_up(w.cast("double") / s.cast("double") * F.lit(2.0), 2))
    level = (
        F.when(s == 0, "unknown").when(score < 20, "easy").when(score < 30, "moderate").otherwise("complex")
    )
    return score, level


def lexicon_share(ft: Column, terms: list[str], divisor: float) -> Column:
    """Distinct lexicon hits / divisor, capped at 1."""
    n = X.contains_count(F.lower(F.coalesce(ft, F.lit(""))), terms)
    return F.least(F.lit(1.0), n.cast("double") / F.lit(float(divisor)))


def lexicon_density(ft: Column, terms: list[str], w: Column | None = None) -> Column:
    """Distinct lexicon hits per 100 words, 2 decimals; 0 without words."""
    n = X.contains_count(F.lower(F.coalesce(ft, F.lit(""))), terms)
    w = X.word_count(ft) if w is None else w
    return F.when(w > 0, X.round_half_up(n.cast("double") / w.cast("double") * F.lit(100.0), 2)).otherwise(F.lit(0.0))


def average_word_length(ft: Column, w: Column | None = None) -> Column:
    w = X.word_count(ft) if w is None else w
    return F.when(w > 0, X.round_half_up(X.non_ws_chars(ft).cast("double") / w.cast("double"), 2)).otherwise(
        F.lit(0.0)
    )


def compliance_references(ft: Column) -> Column:
    """All citation matches, pattern by pattern.

    The patterns are case-sensitive, so a match contains its literal prefix verbatim: the
    regex only runs on texts that hold it (exact for every text).
    """
    text = F.coalesce(ft, F.lit(""))
    parts = []
    for raw, rx in zip(RP.CITATION_PATTERNS, CITATION_REGEXES):
        found = F.regexp_extract_all(text, F.lit(rx), 0)
        prefix = X.literal_prefix(raw)
        parts.append(F.when(text.contains(prefix), found).otherwise(F.array().cast("array<string>"))
                     if prefix else found)
    return F.concat(*parts)


def lowered(d: DataFrame, ft: str = "full_text") -> DataFrame:
    """Add ``_lt``, the lower-cased full text, once, where the row has none yet."""
    return d if "_lt" in d.columns else d.withColumn("_lt", F.lower(F.col(ft)))


def risk_terms(lower: Column) -> Column:
    """Risk words present in a lower-cased text (a column: it is read for every word), in lexicon order."""
    return X.terms_present(F.coalesce(lower, F.lit("")), RP.RISK_WORDS)


def legal_terms(ft: Column) -> Column:
    """Distinct whole-word legal terms (sorted)."""
    return F.array_sort(
        F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(ft, F.lit(""))), F.lit(LEGAL_TERM_REGEX), 0))
    )


def key_phrases(ft: Column, n: int = 15) -> Column:
    """First ``n`` distinct runs of Capitalised words, by first occurrence."""
    return F.slice(F.array_distinct(F.regexp_extract_all(F.coalesce(ft, F.lit("")), F.lit(KEY_PHRASE_REGEX), 0)), 1, n)


def organisation_matches(ft: Column, n: int = 20) -> Column:
    """First ``n`` company-name matches, duplicates kept.

    The pattern is case-sensitive and ends in one of a few words: it only runs on texts that hold one.
    """
    text = F.coalesce(ft, F.lit(""))
    endings = [w for w in ORGANISATION_ENDINGS if not any(v != w and v in w for v in ORGANISATION_ENDINGS)]
    found = F.filter(F.regexp_extract_all(text, F.lit(ORGANISATION_REGEX), 1), lambda m: m != "")
    ending = F.lit(False)
    for w in endings:
        ending = ending | text.contains(w)
    return F.slice(F.when(ending, found).otherwise(F.array().cast("array<string>")), 1, n)


# ----------------------------------------------------------------- T1, T3, T5
def stats_columns(paras: Column, secs: Column, tables: Column, ft: Column, w: Column | None = None,
                  s: Column | None = None) -> list[Column]:
    n_par = F.size(paras)
    w = X.word_count(ft) if w is None else w
    s = X.sentence_count(ft) if s is None else s
    denom = F.greatest(F.lit(1), n_par).cast("double")
    return [
        w.alias("word_count"),
        n_par.cast("long").alias("paragraph_count"),
        F.size(secs).cast("long").alias("section_count"),
        F.size(tables).cast("long").alias("table_count"),
        s.alias("sentence_count"),
        X.round_half_up(w.cast("double") / denom, 2).alias("avg_words_per_paragraph"),
        X.round_half_up(s.cast("double") / denom, 2).alias("avg_sentences_per_paragraph"),
        F.length(ft).cast("long").alias("character_count"),
        F.size(F.array_distinct(X.words(F.lower(ft)))).cast("long").alias("unique_words"),
    ]


def complexity_columns(ft: Column, secs: Column, total: Column | None = None) -> list[Column]:
    """T5: overall complexity from total words and mean section length."""
    total = X.word_count(ft) if total is None else total
    n_sec = F.size(secs)
    avg = F.when(n_sec > 0, total.cast("double") / n_sec.cast("double")).otherwise(total.cast("double"))
    level = (
        F.when((total > 3000) | (avg > 500), "high")
        .when((total > 1500) | (avg > 250), "medium")
        .otherwise("low")
    )
    return [level.alias("overall_complexity"), total.alias("total_words"),
            X.round_half_up(avg, 2).alias("average_section_length")]


def document_stats(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """T1 + T3: the nine statistics per document."""
    d = counted(structured(docs, text_col))
    return d.select(key, *stats_columns(F.col("paras"), F.col("sections"), F.col("tables"), F.col("full_text"),
                                        F.col("_wc"), F.col("_sc")))


def text_analysis(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """T2, T4, T5, T6 (+T7, T8 parser versions): readability, complexity and language per document."""
    d = counted(structured(docs, text_col))
    ft, w, s = F.col("full_text"), F.col("_wc"), F.col("_sc")
    score, level = readability(ft, w, s)
    lower = F.lower(ft)
    return d.select(
        key,
        s.alias("sentence_count"),
        score.alias("complexity_score"),
        level.alias("readability_level"),
        *complexity_columns(ft, F.col("sections"), w),
        average_word_length(ft, w).alias("average_word_length"),
        lexicon_share(ft, RP.FORMALITY_WORDS, 10.0).alias("formal_language_score"),
        F.regexp_count(ft, F.lit(PASSIVE_REGEX)).cast("long").alias("passive_voice_count"),
        lexicon_density(ft, RP.JARGON_WORDS, w).alias("legal_jargon_density"),
        F.regexp_count(lower, F.lit("shall")).cast("long").alias("obligation_count"),
    )


def legal_elements(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Obligations, contract elements, citations, risk words, legal terms."""
    d = lowered(structured(docs, text_col))
    ft, lower = F.col("full_text"), F.col("_lt")
    return d.select(
        key,
        F.regexp_count(lower, F.lit("shall")).cast("long").alias("obligations"),
        (lower.contains("party") | lower.contains("parties")).alias("parties"),
        lower.contains("terms").alias("terms"),
        lower.contains("conditions").alias("conditions"),
        lower.contains("consideration").alias("consideration"),
        compliance_references(ft).alias("compliance_indicators"),
        risk_terms(lower).alias("risk_indicators"),
        legal_terms(ft).alias("legal_terms"),
    )


def key_phrase_table(docs: DataFrame, key: str = "doc_id", text_col: str = "text", n: int = 15) -> DataFrame:
    """T13 per document."""
    d = structured(docs, text_col)
    return d.select(key, key_phrases(F.col("full_text"), n).alias("key_phrases"))


def organisations(docs: DataFrame, key: str = "doc_id", text_col: str = "text", n: int = 20) -> DataFrame:
    """One row per organisation mention (position kept), label ORGANIZATION."""
    d = structured(docs, text_col)
    return X.explode_rows(d, [key], organisation_matches(F.col("full_text"), n), "text", "pos").select(
        key, F.col("pos").cast("long").alias("pos"), "text", F.lit("ORGANIZATION").alias("label")
    )


def feature_columns(d_paras: Column, secs: Column, tables: Column, ft: Column) -> list[Column]:
    n_par = F.size(d_paras)
    n_sec = F.size(secs)
    numbered = F.exists(secs, lambda s: s["title"].rlike(X.py_regex("^\\d+\\.")))
    return [
        ft.alias("full_text"),
        X.word_count(ft).alias("word_count"),
        n_par.cast("long").alias("paragraph_count"),
        n_sec.cast("long").alias("section_count"),
        F.when(n_par > 0, F.element_at(d_paras, 1)["is_header"]).otherwise(F.lit(False)).alias("has_title"),
        (n_sec > 0).alias("has_sections"),
        numbered.alias("has_numbered_sections"),
        (F.size(tables) > 0).alias("has_tables"),
        lexicon_density(ft, RP.CLASSIFIER_TERM_WORDS).alias("legal_term_density"),
        lexicon_share(ft, RP.FORMALITY_WORDS, 15.0).alias("formality_score"),
    ]


def features(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The classifier's ten-feature row."""
    d = structured(docs, text_col)
    return d.select(key, *feature_columns(F.col("paras"), F.col("sections"), F.col("tables"), F.col("full_text")))
