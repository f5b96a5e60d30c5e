"""Lexicon classification.

A type-rule pack of up to ``MAX_COMPILED_RULES`` rules is compiled to one boolean expression
per rule on the lower-cased ``full_text``; a larger one, or one with a pattern that Java cannot
run as Python does, goes to the keyword automaton of ``matcher``, with the same rows.  Scores,
arg-max, runner-up and confidence are then computed inside each document's
row (sorting an array of a few types), so classifying a corpus is map-only.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexrev.functions import text as X
from lexrev.operators import flags as FL
from lexrev.operators import segment as S
from lexrev.operators.matcher import RULE_BLOCK, java_differs, literals_of, matchers, pattern_error
from lexrev.session import MAX_COMPILED_RULES
from lexrev.sources.rules import KINDS, default_rulepack

RULE_FIELDS = ["type", "type_order", "kind", "ord", "term", "weight", "is_regex"]
# Output names of the evidence lists per rule kind (the reviewed application's result keys).
EVIDENCE_KEYS = {"primary": "primary", "secondary": "secondary", "pattern": "patterns", "section": "sections"}


def load_type_rules(type_rules: DataFrame | list | None = None, spark=None,
                    rejected: list[tuple[str, str, str]] | None = None) -> list:
    """The usable rules of a pack in order (a list that was loaded before passes through); a rule without a
    usable term is left out and added to ``rejected`` as (pack, rule, reason)."""
    if isinstance(type_rules, list):
        return type_rules
    if type_rules is None:
        type_rules = default_rulepack(spark, "type_rules")
    # the pack itself is configuration: a row a rule, of which the driver holds the list
    rows = list(type_rules.select(*RULE_FIELDS).toLocalIterator())
    kind_rank = {k: i for i, k in enumerate(KINDS)}
    faults = [("no term" if not r.term else pattern_error(r.term) if r.is_regex else None) for r in rows]
    if rejected is not None:
        rejected += [("type_rules", f"{r.type}/{r.kind}/{r.ord}", f) for r, f in zip(rows, faults) if f]
    rows = [r for r, f in zip(rows, faults) if not f]
    return sorted(rows, key=lambda r: (r.type_order, kind_rank.get(r.kind, 9), r.ord))


def needs_automaton(spark, rules: list) -> bool:
    """Whether a pack is too large for expressions, or has a pattern that Java refuses or takes otherwise."""
    return len(rules) > MAX_COMPILED_RULES or any(
        r.is_regex and (java_differs(r.term) or X.pattern_fault(spark, r.term) is not None) for r in rules)


def _types(rules) -> "OrderedDict[str, int]":
    out: OrderedDict[str, int] = OrderedDict()
    for r in rules:
        out.setdefault(r.type, r.type_order)
    return out


def _hit(lt: Column, plain: Column, r, contains) -> Column:
    """A rule fires once per document: substring of the lower-cased text, or a regex search (any case).

    A pattern whose matches all hold certain literals cannot match a lower-cased text that lacks
    them, so the regex is skipped there (exact: texts that are not ``plain``, where Unicode case
    folding could match other characters, always run the regex).
    """
    if r.is_regex:
        full = F.coalesce(lt.rlike(X.py_regex(r.term, ignore_case=True)), F.lit(False))
        required = literals_of(r.term)
        if required:
            return F.when(plain & ~X.holds(required, contains), F.lit(False)).otherwise(full)
        return full
    return contains(r.term.lower())


def _ft(docs: DataFrame, text_col: str) -> DataFrame:
    if "full_text" in docs.columns:
        return docs
    return docs.withColumn("full_text", S.full_text_from_text(F.col(text_col)))


def _hits_array(hits: Column, rules) -> Column:
    items = [
        F.struct(
            F.lit(r.type).alias("type"), F.lit(r.type_order).alias("type_order"), F.lit(r.kind).alias("kind"),
            F.lit(r.ord).alias("ord"), F.lit(r.term).alias("term"), F.lit(float(r.weight)).alias("weight"),
            hits[i].alias("hit"),
        )
        for i, r in enumerate(rules)
    ]
    return F.filter(F.array(*items), lambda h: h["hit"])


def rule_hits(docs: DataFrame, type_rules: DataFrame | None = None, key: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per (document, rule) that fires."""
    rules = load_type_rules(type_rules, docs.sparkSession)
    if needs_automaton(docs.sparkSession, rules):
        return _automaton_hits(_ft(docs, text_col), key, rules)
    d = _staged_hits(_ft(docs, text_col), [key], rules)
    h = X.inline_rows(d, [key], _hits_array(F.col("_hits"), rules), "type")
    return h.select(key, "type", F.col("type_order").cast("long").alias("type_order"), "kind",
                    F.col("ord").cast("long").alias("ord"), "term", "weight")


def _automaton_hits(d: DataFrame, key: str, rules: list, block: int = RULE_BLOCK) -> DataFrame:
    """``rule_hits`` by the keyword automaton: one pass over the documents per block of rules."""
    meta_type = [("type", pa.string()), ("type_order", pa.int64()), ("kind", pa.string()), ("ord", pa.int64()),
                 ("term", pa.string()), ("weight", pa.float64())]
    schema = T.StructType([d.schema[key], *[T.StructField(n, t) for n, t in zip(
        [n for n, _ in meta_type], [T.StringType(), T.LongType(), T.StringType(), T.LongType(), T.StringType(),
                                    T.DoubleType()])]])
    lowered = d.select(key, F.lower(F.col("full_text")).alias("_lt"))
    found = None
    for first, m in matchers([(r.term, bool(r.is_regex)) for r in rules], block):
        own = rules[first:first + block]
        meta = [pa.array([getattr(r, n) for r in own], t) for n, t in meta_type]
        sent = d.sparkSession.sparkContext.broadcast((m, meta))  # at most ``block`` rules

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher, columns = sent.value
            for b in batches:
                hits = [matcher.hits(t or "") for t in b.column(1).to_pylist()]
                rule = pa.array([i for own in hits for i in own], pa.int64())
                row = pa.array([k for k, own in enumerate(hits) for _ in own], pa.int64())
                if len(rule):
                    yield pa.RecordBatch.from_arrays([b.column(0).take(row), *(c.take(rule) for c in columns)],
                                                     names=schema.fieldNames())

        part = lowered.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def _automaton_scores(d: DataFrame, cols: list[str], rules: list, ft: str) -> DataFrame:
    """(cols, _scores): the sorted scores of every document, its evidence found by the keyword automaton."""
    types = list(_types(rules).items())
    parts = matchers([(r.term, bool(r.is_regex)) for r in rules])
    sent = d.sparkSession.sparkContext.broadcast((parts, rules, types))
    evidence = ",".join(f"{EVIDENCE_KEYS[k]}:array<string>" for k in KINDS)

    @F.pandas_udf(f"array<struct<type:string,type_order:int,raw_score:double,score:double,evidence:struct<{evidence}>>>")
    def scores(texts: pd.Series, words: pd.Series) -> pd.Series:
        parts, rules, types = sent.value

        def one(text: str, n: int) -> list[dict]:
            mine: dict[str, list] = {}
            for first, m in parts:
                for i in m.hits(text or ""):
                    mine.setdefault(rules[first + i].type, []).append(rules[first + i])
            denom = max(n / 1000.0 if n > 0 else 1.0, 0.1)
            out = []
            for name, order in types:
                own = mine.get(name, [])
                raw = 0.0
                for r in own:
                    raw += float(r.weight)
                out.append({"type": name, "type_order": order, "raw_score": raw, "score": raw / denom, "evidence": {
                    EVIDENCE_KEYS[k]: [r.term for r in own if r.kind == k] for k in KINDS}})
            return sorted(out, key=lambda s: (-s["score"], s["type_order"]))

        return pd.Series([one(t, n) for t, n in zip(texts, words)], dtype=object)

    staged = d.select(*cols, F.lower(F.col(ft)).alias("_lt"), X.word_count(F.col(ft)).alias("_w"))
    return staged.select(*cols, scores("_lt", "_w").alias("_scores"))


def _score_array(hits: Column, words: Column, rules) -> Column:
    """C2 from the rule hit flags: every type keeps an entry, also with zero evidence."""
    factor = F.when(words > 0, words.cast("double") / F.lit(1000.0)).otherwise(F.lit(1.0))
    denom = F.greatest(factor, F.lit(0.1))
    none = F.array().cast("array<string>")
    structs = []
    for typ, t_ord in _types(rules).items():
        mine = [(i, r) for i, r in enumerate(rules) if r.type == typ]
        raw = F.lit(0.0)
        for i, r in mine:
            raw = raw + F.when(hits[i], F.lit(float(r.weight))).otherwise(F.lit(0.0))
        ev = {}
        for k in KINDS:
            terms = [(i, r) for i, r in mine if r.kind == k]
            # concatenated, not filtered: a lambda's input is interpreted, not compiled
            ev[k] = F.concat(*[F.when(hits[i], F.array(F.lit(r.term))).otherwise(none) for i, r in terms]) if terms else none
        structs.append(F.struct(
            F.lit(typ).alias("type"), F.lit(t_ord).alias("type_order"), raw.alias("raw_score"),
            (raw / denom).alias("score"),
            F.struct(*[ev[k].alias(EVIDENCE_KEYS[k]) for k in KINDS]).alias("evidence"),
        ))
    return F.array(*structs)


def _staged_hits(d: DataFrame, cols: list[str], rules, ft: str = "full_text") -> DataFrame:
    """(cols, _w, _hits): lower-case once (or take what ``with_case`` has added), look up what many rules
    share, then all rule tests (a boolean per rule, in rule order) in one code-generated projection."""
    d1 = (d if "_lt" in d.columns else FL.with_case(d, ft)).select(
        *dict.fromkeys([*cols, "_lt", "_plain"]), (F.col("_wc") if "_wc" in d.columns else X.word_count(F.col(ft))).alias("_w"))
    d2, contains = X.with_parts(d1, "_lt", [t for r in rules for t in (
        (t for s in literals_of(r.term) for t in s) if r.is_regex else [r.term.lower()])], "_parts")
    hits = F.array(*[_hit(F.col("_lt"), F.col("_plain"), r, contains) for r in rules])
    # never null; the guard keeps the array a column: CollapseProject would inline the tests of a bare one
    return d2.select(*cols, "_w", F.when(F.col("_w") >= 0, hits).alias("_hits"))


def _by_score(a: Column, b: Column) -> Column:
    return (
        F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1)
        .when(a["type_order"] < b["type_order"], -1).when(a["type_order"] > b["type_order"], 1).otherwise(0)
    )


def type_scores(docs: DataFrame, type_rules: DataFrame | None = None, key: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Raw and length-normalised score of every type for every document."""
    rules = load_type_rules(type_rules, docs.sparkSession)
    if needs_automaton(docs.sparkSession, rules):
        s = X.inline_rows(_automaton_scores(_ft(docs, text_col), [key], rules, "full_text"), [key], F.col("_scores"), "type")
    else:
        d = _staged_hits(_ft(docs, text_col), [key], rules)
        s = X.inline_rows(d, [key], _score_array(F.col("_hits"), F.col("_w"), rules), "type")
    return s.select(key, "type", F.col("type_order").cast("long").alias("type_order"), "raw_score",
                    X.round_half_up(F.col("score"), 3).alias("normalized_score"))


def sorted_scores(scores: Column) -> Column:
    """All type scores of a document, best first (ties to the first declared type), from the column of ``_score_array``."""
    return F.when(X.pinned(scores), F.array_sort(scores, _by_score))


def columns_from_scores(scores: Column, n_types: int, method: str = "ensemble") -> list[Column]:
    """C3-C6 from the sorted score array (computed once in the previous projection)."""
    if n_types == 0:
        return [F.lit("unknown").alias("predicted_type"), F.lit(0.0).alias("confidence"),
                F.lit("rule_based").alias("method_used")]
    best = F.element_at(scores, 1)
    conf = F.least(F.lit(1.0), best["score"] / F.lit(15.0))
    if n_types > 1:
        second = F.element_at(scores, 2)
        conf = conf + F.least(F.lit(0.4), (best["score"] - second["score"]) / F.lit(10.0))
    conf = X.round_half_up(F.least(F.lit(1.0), conf), 3)
    ev = best["evidence"]
    kinds_present = sum((F.size(ev[EVIDENCE_KEYS[k]]) > 0).cast("int") for k in KINDS)
    method_used = "ensemble" if method == "ensemble" else "rule_based"
    if method == "ensemble":
        boosted = (
            F.when(kinds_present >= 3, F.least(F.lit(1.0), conf * F.lit(1.3)))
            .when(kinds_present >= 2, F.least(F.lit(1.0), conf * F.lit(1.1)))
            .otherwise(conf)
        )
        conf = X.round_half_up(boosted, 3)
    return [
        # never null: keeps inferred IS NOT NULL filters (joins on the type) from being pushed
        # into the scoring projection, which would inline and repeat the rule tests
        F.coalesce(best["type"], F.lit("unknown")).alias("predicted_type"),
        conf.alias("confidence"),
        F.lit(method_used).alias("method_used"),
        F.map_from_arrays(
            F.transform(scores, lambda s: s["type"]),
            F.transform(scores, lambda s: X.round_half_up(s["score"], 3)),
        ).alias("all_scores"),
        ev.alias("best_matches"),
        kinds_present.cast("long").alias("evidence_types"),
        (best["raw_score"] > 0).alias("has_evidence"),
        F.format_string("Matched %d primary keywords, %d patterns", F.size(ev["primary"]),
                        F.size(ev["patterns"])).alias("reasoning"),
    ]


def with_classification(d: DataFrame, rules, method: str = "ensemble", passthrough: list[str] | None = None,
                        ft: str = "full_text") -> DataFrame:
    """Three projections: the score array once per row, its order, then the result columns from it."""
    cols = passthrough if passthrough is not None else d.columns
    n = len(_types(rules))
    if not n:
        return d.select(*cols, *columns_from_scores(F.lit(None), 0, method))
    if needs_automaton(d.sparkSession, rules):
        return _automaton_scores(d, cols, rules, ft).select(*cols, *columns_from_scores(F.col("_scores"), n, method))
    staged = _staged_hits(d, cols, rules, ft)
    staged = staged.select(*cols, _score_array(F.col("_hits"), F.col("_w"), rules).alias("_unsorted"))
    staged = staged.select(*cols, sorted_scores(F.col("_unsorted")).alias("_scores"))
    return staged.select(*cols, *columns_from_scores(F.col("_scores"), n, method))


def classify(docs: DataFrame, type_rules: DataFrame | None = None, method: str = "ensemble", key: str = "doc_id",
             text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``rule_based`` or ``ensemble``; ``ml`` (untrained) and unknown names fall back to rule_based."""
    rules = load_type_rules(type_rules, docs.sparkSession)
    d = _ft(docs, text_col).select(key, *(keep or []), "full_text")
    return with_classification(d, rules, method, [key, *(keep or [])])


def explanation_column(predicted_type: Column, confidence: Column, method_used: Column, best_matches: Column,
                       reasoning: Column) -> Column:
    """C7 as a column: title-cased type, percent, up to three primary hits, counts, reasoning."""
    ev = best_matches
    head = F.concat(
        F.lit("Document classified as '"), X.title_words(predicted_type), F.lit("' with "),
        X.percent1(confidence), F.lit(" confidence using "), method_used, F.lit(" method.\n\n"),
    )
    prim = F.when(F.size(ev["primary"]) > 0, F.concat(
        F.lit("Primary indicators: "), F.array_join(F.slice(ev["primary"], 1, 3), ", "), F.lit("\n"))).otherwise("")
    pat = F.when(F.size(ev["patterns"]) > 0, F.format_string("Legal patterns: %d patterns matched\n",
                                                             F.size(ev["patterns"]))).otherwise("")
    sec = F.when(F.size(ev["secondary"]) > 0, F.format_string("Secondary indicators: %d found\n",
                                                              F.size(ev["secondary"]))).otherwise("")
    return F.concat(head, prim, pat, sec, F.lit("\n"), reasoning)


def explain_classification(classified: DataFrame, key: str = "doc_id") -> DataFrame:
    """The explanation text of a classification."""
    return classified.select(key, explanation_column(
        F.col("predicted_type"), F.col("confidence"), F.col("method_used"), F.col("best_matches"),
        F.col("reasoning")).alias("explanation"))
