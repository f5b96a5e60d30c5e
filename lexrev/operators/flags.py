"""Red flags, review comments, suggestions and annotation.

A flag-rule pack is compiled into one literal regex expression per rule, so scanning is a
map-only projection: no join with the corpus, no shuffle, each pattern is
compiled once per task.  Rules that Java cannot run as Python does (or that match the empty
text), and packs of over ``MAX_COMPILED_RULES`` rules, are searched by the keyword automaton
of ``matcher`` and Python's ``re`` in Arrow batches, with the same rows.  Offsets are code points of ``full_text``, computed
from ``regexp_extract_all`` (matches) and ``split`` (gaps between them) with
block prefix sums; an exact test skips a rule's regex on texts that lack
the literals every match holds.  Comments, suggestions and
annotations stay inside the document row as well.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.operators import segment as S
from lexrev.operators.matcher import java_differs, literals_of, matchers, pattern_error
from lexrev.session import MAX_COMPILED_RULES, broadcast_if_small
from lexrev.sources.rules import default_rulepack


@dataclass(frozen=True)
class FlagRule:
    rule_id: int
    pattern: str
    issue: str
    severity: str
    suggestion: str
    reference: str
    category: str
    #: whether the pattern runs as an expression; otherwise the automaton and Python's ``re`` run it
    compiled: bool = True

    @property
    def regex(self) -> str:
        return X.py_regex(self.pattern, ignore_case=True)

    @property
    def comment(self) -> str:
        return f"{self.issue} - {self.suggestion}"


def load_flag_rules(flag_rules: DataFrame | list[FlagRule] | None = None, spark=None,
                    rejected: list[tuple[str, str, str]] | None = None) -> list[FlagRule]:
    """The usable rules of a pack (a list that was loaded before passes through).

    A rule whose pattern cannot be used is left out, so that it does not stop the others, and is added
    to ``rejected`` as (pack, rule, reason).
    """
    if isinstance(flag_rules, list):
        return flag_rules
    if flag_rules is None:
        flag_rules = default_rulepack(spark, "flag_rules")
    # the pack itself is configuration: a row a rule, of which the driver holds the list
    rows = list(flag_rules.orderBy("rule_id").toLocalIterator())
    few = len(rows) <= MAX_COMPILED_RULES
    out = []
    for r in rows:
        fault = pattern_error(r.pattern) if r.pattern else "no pattern"
        if fault is None:
            compiled = few and not java_differs(r.pattern) and X.pattern_fault(
                flag_rules.sparkSession, r.pattern, find_all=True) is None
            out.append(FlagRule(r.rule_id, r.pattern, r.issue or "Unknown issue", r.severity or "Medium",
                                r.suggestion or "Review required", r.reference or "", r.category or "general", compiled))
        elif rejected is not None:
            rejected.append(("flag_rules", str(r.rule_id), fault))
    return out


BLOCK = 64
FLAG_TYPE = "array<struct<rule_id:int,occurrence:int,matched_text:string,start:int,end:int>>"


def _searched_spans(spark, rules: list[FlagRule]):
    """A function of a text column: every match of these rules by the automaton, in rule order."""
    sent = spark.sparkContext.broadcast((matchers([(r.pattern, True) for r in rules]), [r.rule_id for r in rules]))

    @F.pandas_udf(FLAG_TYPE)
    def spans(texts: pd.Series) -> pd.Series:
        parts, ids = sent.value
        return pd.Series([[
            {"rule_id": ids[first + i], "occurrence": k, "matched_text": m, "start": start, "end": end}
            for first, matcher in parts for i, k, m, start, end in matcher.spans(t or "")] for t in texts], dtype=object)

    return spans


def with_flag_array(d: DataFrame, rules: list[FlagRule], ft: str = "full_text", out: str = "flags") -> DataFrame:
    """Add ``out``: every match of every rule (rule order, then position) with [start, end) code points.

    Rules that are not compiled are searched by the automaton, then merged in rule order.
    """
    searched = [r for r in rules if not r.compiled]
    if not searched:
        return _compiled_flag_array(d, rules, ft, out)
    cols = d.columns
    compiled = [r for r in rules if r.compiled]
    d = d.withColumn("_searched", _searched_spans(d.sparkSession, searched)(F.coalesce(F.col(ft), F.lit(""))))
    if not compiled:
        return d.select(*cols, F.col("_searched").alias(out))
    d = _compiled_flag_array(d, compiled, ft, "_found")
    both = F.array_sort(F.concat("_searched", "_found"))  # by rule id, then occurrence
    return d.select(*cols, both.alias(out))


def with_case(d: DataFrame, ft: str = "full_text") -> DataFrame:
    """Add ``_lt``, the lower-cased text, and ``_plain`` (see ``is_plain``), for all rule tests of a row."""
    return d.select("*", F.lower(F.col(ft)).alias("_lt"), X.is_plain(F.col(ft)).alias("_plain"))


def _with_lacking(d: DataFrame, rules: list[FlagRule], ft: str):
    """(``d`` with what the test needs, a function): of a rule, whether the text lacks literals that all its matches hold.

    Exact: a plain text without such a literal in lower case has no match; texts that are not plain run every regex.
    """
    required = {r.pattern: literals_of(r.pattern) for r in rules}
    d, contains = X.with_parts(d if "_lt" in d.columns else with_case(d, ft), "_lt",
                               [t for r in rules for s in required[r.pattern] for t in s], "_fparts")
    return d, lambda r: F.col("_plain") & ~X.holds(required[r.pattern], contains)


def _compiled_flag_array(d: DataFrame, rules: list[FlagRule], ft: str, out: str) -> DataFrame:
    """The flags of rules that run as expressions.

    Offsets come from the matches (``regexp_extract_all``) and the gaps between them
    (``split``): start_i = sum of (gap + match) lengths before i + gap_i.  The prefix sums use
    blocks of ``BLOCK`` pieces, so a document with n matches of one rule costs
    O(n * BLOCK + (n / BLOCK)^2) instead of O(n^2).  Each array is built in its own projection
    (see ``pinned``) because higher-order functions recompute inline inputs per element.
    """
    cols = d.columns
    text = F.col(ft)
    ks = range(len(rules))
    d, lacks = _with_lacking(d, rules, ft)

    def matches(r):
        found = F.regexp_extract_all(text, F.lit(r.regex), 0)
        return F.coalesce(F.when(lacks(r), F.array().cast("array<string>")).otherwise(found), F.array().cast("array<string>"))

    d = d.select("*", *[matches(r).alias(f"_fm{k}") for k, r in zip(ks, rules)])
    d = d.select("*", *[F.when(F.size(f"_fm{k}") > 0, F.slice(F.split(text, r.regex, -1), 1, F.size(f"_fm{k}")))
                        .otherwise(F.array().cast("array<string>")).alias(f"_fg{k}") for k, r in zip(ks, rules)])
    d = d.select("*", *[F.zip_with(f"_fg{k}", f"_fm{k}", lambda g, x: F.length(g) + F.length(x)).alias(f"_fl{k}")
                        for k in ks])

    def n_blocks(k):
        return F.floor((F.size(f"_fl{k}") + F.lit(BLOCK - 1)) / F.lit(BLOCK)).cast("int")

    def block_sums(k):
        lens = F.col(f"_fl{k}")
        return F.transform(X.seq0(n_blocks(k)), lambda b: F.aggregate(
            F.slice(lens, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x))

    d = d.select("*", *[block_sums(k).alias(f"_fb{k}") for k in ks])

    def block_starts(k):
        sums = F.col(f"_fb{k}")
        return F.transform(X.seq0(F.size(sums)), lambda b: F.aggregate(F.slice(sums, 1, b), F.lit(0), lambda a, x: a + x))

    d = d.select("*", *[block_starts(k).alias(f"_fs{k}") for k in ks])

    def spans(k, r):
        m, g, lens, starts = (F.col(f"_f{c}{k}") for c in "mgls")

        def one(x, i):
            q = F.floor(i / F.lit(BLOCK)).cast("int")
            start = (F.element_at(starts, q + 1)
                     + F.aggregate(F.slice(lens, q * BLOCK + 1, i - q * BLOCK), F.lit(0), lambda a, y: a + y)
                     + F.length(F.element_at(g, i + 1)))
            return F.struct(
                F.lit(r.rule_id).alias("rule_id"), (i + 1).alias("occurrence"), x.alias("matched_text"),
                start.alias("start"), (start + F.length(x)).alias("end"),
            )

        return F.when(X.pinned(g, lens, starts), F.transform(m, one))

    flags = F.concat(*[spans(k, r) for k, r in zip(ks, rules)]) if rules else F.array().cast(FLAG_TYPE)
    return d.select(*cols, flags.alias(out))


def _rule_meta(rules: list[FlagRule], rule_id: Column, field: str) -> Column:
    if len(rules) > MAX_COMPILED_RULES:  # one literal map instead of a branch a rule
        pairs = F.map_from_arrays(F.lit([r.rule_id for r in rules]), F.lit([getattr(r, field) for r in rules]))
        return F.element_at(pairs, rule_id)
    expr = None if rules else F.lit(None).cast("string")
    for r in rules:
        v = F.lit(getattr(r, field))
        expr = F.when(rule_id == r.rule_id, v) if expr is None else expr.when(rule_id == r.rule_id, v)
    return expr


META = ["pattern", "issue", "severity", "suggestion", "reference", "category"]


def rule_table(spark, rules: list[FlagRule]) -> DataFrame:
    """The pack as a table: rule_id and its fields."""
    frame = pd.DataFrame([[r.rule_id, *(getattr(r, f) for f in META)] for r in rules], columns=["rule_id", *META])
    return spark.createDataFrame(frame, "rule_id int, " + ", ".join(f"{f} string" for f in META))


def _with_full_text(docs: DataFrame, text_col: str) -> DataFrame:
    if "full_text" in docs.columns:
        return docs
    return docs.withColumn("full_text", S.full_text_from_text(F.col(text_col)))


def scan_flags(docs: DataFrame, flag_rules: DataFrame | None = None, key: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """every match of every rule in ``full_text`` (rule order, then position)."""
    rules = load_flag_rules(flag_rules, docs.sparkSession)
    d = with_flag_array(_with_full_text(docs, text_col).select(key, "full_text"), rules)
    f = X.inline_rows(d, [key], F.col("flags"), "rule_id")
    if len(rules) > MAX_COMPILED_RULES:  # flag rows join the pack's table
        return f.join(broadcast_if_small(rule_table(docs.sparkSession, rules)), "rule_id").select(
            key, F.col("rule_id").cast("long").alias("rule_id"), F.col("occurrence").cast("long").alias("occurrence"), *META,
            "matched_text", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    rid = F.col("rule_id")
    return f.select(
        key,
        rid.cast("long").alias("rule_id"),
        F.col("occurrence").cast("long").alias("occurrence"),
        _rule_meta(rules, rid, "pattern").alias("pattern"),
        _rule_meta(rules, rid, "issue").alias("issue"),
        _rule_meta(rules, rid, "severity").alias("severity"),
        _rule_meta(rules, rid, "suggestion").alias("suggestion"),
        _rule_meta(rules, rid, "reference").alias("reference"),
        _rule_meta(rules, rid, "category").alias("category"),
        "matched_text",
        F.col("start").cast("long").alias("start"),
        F.col("end").cast("long").alias("end"),
    )


def _comment_struct(r: FlagRule, p: Column, copies: Column) -> Column:
    return F.struct(
        F.lit(r.rule_id).alias("rule_id"),
        p["idx"].alias("paragraph_index"),
        p["text"].alias("text"),
        F.lit(r.comment).alias("comment"),
        F.lit(r.severity).alias("severity"),
        F.lit(r.reference).alias("reference"),
        copies.alias("copies"),
    )


COMMENT_TYPE = ("array<struct<rule_id:int,paragraph_index:int,text:string,comment:string,severity:string,"
                "reference:string,copies:int>>")


def with_paragraph_comments(d: DataFrame, rules: list[FlagRule], mode: str, out: str = "commented") -> DataFrame:
    """Add ``out``: every paragraph (idx, text) with its comment structs in rule order, each with its ``copies``.

    Comments are built paragraph by paragraph, so the work is linear in the paragraphs.  Reference mode
    needs the number of flags of each rule in the whole document; those counts (taken from ``flags`` where
    the row has them) are computed in their own projection, so the per-paragraph lambda reads a column.
    """
    cols = d.columns
    if not all(r.compiled for r in rules):
        return _searched_comments(d, rules, mode, out)
    empty = F.array().cast(COMMENT_TYPE)
    if mode == "reference":
        if "flags" in cols:
            counts = [F.size(F.filter("flags", _rule_equals(r.rule_id))) for r in rules]
        else:
            d, lacks = _with_lacking(d, rules, "full_text")
            counts = [match_count(F.col("full_text"), r, lacks(r)) for r in rules]
        d = d.select(*cols, *[n.alias(f"_n{k}") for k, n in enumerate(counts)])

    def copies(k: int, r: FlagRule, text: Column) -> Column:
        if mode == "reference":
            n = F.col(f"_n{k}")
            return F.when(n > 0, F.when(text.rlike(r.regex), n).otherwise(0)).otherwise(0)
        return F.when(text.rlike(r.regex), F.size(F.regexp_extract_all(text, F.lit(r.regex), 0))).otherwise(0)

    def per_para(p: Column) -> Column:
        every = [_comment_struct(r, p, copies(k, r, p["text"])) for k, r in enumerate(rules)]
        mine = F.filter(F.array(*every), lambda c: c["copies"] > 0) if rules else empty
        return F.struct(p["idx"].alias("idx"), p["text"].alias("text"), mine.alias("comments"))

    return d.select(*cols, F.transform("paras", per_para).alias(out))


def _searched_comments(d: DataFrame, rules: list[FlagRule], mode: str, out: str) -> DataFrame:
    """``with_paragraph_comments`` by the automaton, for all rules of the pack."""
    sent = d.sparkSession.sparkContext.broadcast((matchers([(r.pattern, True) for r in rules]), rules))
    fields = "rule_id:int,comment:string,severity:string,reference:string,copies:int"

    @F.pandas_udf(f"array<array<struct<{fields}>>>")
    def found(paragraphs: pd.Series, full: pd.Series) -> pd.Series:
        parts, rules = sent.value

        def counts(text: str) -> dict[int, int]:
            n: dict[int, int] = {}
            for first, matcher in parts:
                for i, k, *_ in matcher.spans(text):
                    n[first + i] = k
            return n

        def one(texts: list[str], whole: str) -> list[list[dict]]:
            total = counts(whole or "") if mode == "reference" else None
            mine = []
            for t in texts:
                n = counts(t)
                if total is not None:
                    n = {i: total[i] for i in n if i in total}
                mine.append([{"rule_id": rules[i].rule_id, "comment": rules[i].comment, "severity": rules[i].severity,
                              "reference": rules[i].reference, "copies": k} for i, k in sorted(n.items())])
            return mine

        return pd.Series([one(list(p), t) for p, t in zip(paragraphs, full)], dtype=object)

    cols = d.columns
    d = d.select(*cols, found(F.transform("paras", lambda p: p["text"]), F.col("full_text")).alias("_rows"))

    def per_para(p: Column, rows: Column) -> Column:
        mine = F.transform(rows, lambda c: F.struct(
            c["rule_id"].alias("rule_id"), p["idx"].alias("paragraph_index"), p["text"].alias("text"),
            c["comment"].alias("comment"), c["severity"].alias("severity"), c["reference"].alias("reference"),
            c["copies"].alias("copies")))
        return F.struct(p["idx"].alias("idx"), p["text"].alias("text"), mine.alias("comments"))

    return d.select(*cols, F.zip_with("paras", "_rows", per_para).alias(out))


def all_comments(commented: Column) -> Column:
    """The comments of all paragraphs in one array."""
    return F.flatten(F.transform(commented, lambda p: p["comments"]))


def match_count(text: Column, r: FlagRule, lacks: Column) -> Column:
    """Number of matches of one rule in a text (0 where it ``lacks`` the rule's literals)."""
    n = F.when(text.rlike(r.regex), F.size(F.regexp_extract_all(text, F.lit(r.regex), 0))).otherwise(F.lit(0))
    return F.when(lacks, F.lit(0)).otherwise(n)


def review_comments(docs: DataFrame, flag_rules: DataFrame | None = None, mode: str = "paragraph",
                    key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """comments on paragraphs.

    ``reference`` mode reproduces the reviewed application: every flag occurrence in the
    document comments every paragraph its rule matches, i.e. ``copies`` = occurrences in
    the document (n flags x m paragraphs = sum of copies).  ``paragraph`` mode counts the
    occurrences inside each paragraph instead.  One row per (rule, paragraph); the
    repetition is a count, not n x m rows.
    """
    if mode not in ("reference", "paragraph"):
        raise ValueError("mode must be 'reference' or 'paragraph'")
    rules = load_flag_rules(flag_rules, docs.sparkSession)
    d = docs if "paras" in docs.columns else S.with_structure(docs, text_col)
    d = with_paragraph_comments(d.select(key, "paras", "full_text"), rules, mode)
    c = X.inline_rows(d, [key], all_comments(F.col("commented")), "rule_id")
    return c.select(
        key,
        F.col("rule_id").cast("long").alias("rule_id"),
        F.col("paragraph_index").cast("long").alias("paragraph_index"),
        "text", "comment", "severity", "reference",
        F.col("copies").cast("long").alias("copies"),
    )


def issue_table(comments: DataFrame, key: str = "doc_id") -> DataFrame:
    """review table rows: document, text cut to 80 characters (+'...'), comment, severity, reference."""
    t = F.col("text")
    return comments.select(
        key, "rule_id", "paragraph_index",
        F.when(F.length(t) > 80, F.concat(F.substring(t, 1, 80), F.lit("..."))).otherwise(t).alias("excerpt"),
        "comment", "severity", "reference", "copies",
    )


def load_clauses(clauses: DataFrame | list | None = None, spark=None) -> list[tuple[str, str, str]]:
    if isinstance(clauses, list):
        return clauses
    if clauses is None:
        clauses = default_rulepack(spark, "clauses")
    rows = clauses.select("category", "template", "reference").toLocalIterator()
    return [(r.category, r.template, r.reference) for r in rows]


def suggestion_array(flags: Column, rules: list[FlagRule], clauses: list[tuple[str, str, str]]) -> Column:
    """F4 inside the document row: a clause for every flag whose category has a template."""
    by_cat = {c: (t, ref) for c, t, ref in clauses}

    def lookup(cat: Column, i: int) -> Column:
        if len(by_cat) > MAX_COMPILED_RULES:  # one literal map instead of a branch a category
            return F.element_at(F.map_from_arrays(F.lit(list(by_cat)), F.lit([v[i] for v in by_cat.values()])), cat)
        expr = None
        for c, vals in by_cat.items():
            v = F.lit(vals[i])
            expr = F.when(cat == c, v) if expr is None else expr.when(cat == c, v)
        return expr

    def category(f):
        return _rule_meta(rules, f["rule_id"], "category")

    if not by_cat or not rules:
        return F.array().cast("array<struct<category:string,suggested_clause:string,legal_reference:string,"
                              "context_note:string>>")
    kept = F.filter(flags, lambda f: category(f).isin(*by_cat.keys()))
    return F.transform(kept, lambda f: F.struct(
        category(f).alias("category"),
        lookup(category(f), 0).alias("suggested_clause"),
        lookup(category(f), 1).alias("legal_reference"),
        F.when(F.coalesce(f["matched_text"], F.lit("")) != "",
               F.concat(F.lit("Suggested replacement for: "), f["matched_text"])).otherwise(F.lit("")).alias(
            "context_note"),
    ))


def with_comment_count(d: DataFrame, rules: list[FlagRule], out: str, commented: str | None = None) -> DataFrame:
    """Add ``out``, the number of review comments in reference mode: per rule, flags x paragraphs the rule matches.

    ``commented`` names the row's commented paragraphs (of either mode), if it has them: then no pattern is tested again.
    """
    cols = d.columns
    if not all(r.compiled for r in rules):
        d = _searched_comments(d, rules, "reference", "_counted")
        n = F.aggregate(all_comments(F.col("_counted")), F.lit(0).cast("long"), lambda a, c: a + c["copies"])
        return d.select(*cols, n.alias(out))
    total = F.lit(0).cast("long")
    if commented:
        d = d.select(*cols, F.transform(all_comments(F.col(commented)), lambda c: c["rule_id"]).alias("_of"))
    for r in rules:
        n = F.size(F.filter("flags", _rule_equals(r.rule_id)))
        many = F.size(F.filter("_of", _is(r.rule_id))) if commented else _paras_matching(F.col("paras"), r.regex)
        total = total + F.when(n > 0, n * many).otherwise(0)
    return d.select(*cols, total.alias(out))


def _is(value: int):
    return lambda x: x == F.lit(value)


def _rule_equals(rule_id: int):
    return lambda f: f["rule_id"] == F.lit(rule_id)


def _paras_matching(paras: Column, regex: str) -> Column:
    return F.size(F.filter(paras, lambda p: p["text"].rlike(regex)))


def suggest_clauses(flags: DataFrame, clauses: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """a replacement clause for every flag whose category has a template."""
    if clauses is None:
        clauses = default_rulepack(flags.sparkSession, "clauses")
    cat = clauses.select("category", F.col("template").alias("suggested_clause"),
                         F.col("reference").alias("legal_reference"))
    j = flags.join(broadcast_if_small(cat), "category", "inner")
    m = F.col("matched_text")
    return j.select(
        key, "rule_id", "occurrence", "category", "suggested_clause", "legal_reference",
        F.when(F.coalesce(m, F.lit("")) != "", F.concat(F.lit("Suggested replacement for: "), m))
        .otherwise(F.lit("")).alias("context_note"),
    )


def _style(sev: Column) -> Column:
    s = F.lower(sev)
    return F.when(s.isin(*RP.ANNOTATION_STYLES.keys()), s).otherwise(F.lit("medium"))


def _render(c: Column) -> Column:
    ref = F.when(c["reference"] != "", F.concat(F.lit(RP.ANNOTATION_REFERENCE), c["reference"])).otherwise("")
    one = F.concat(F.lit(RP.ANNOTATION_PREFIX), c["comment"], ref, F.lit("]"))
    return F.repeat(one, c["copies"])


def annotated_paragraphs(commented: Column, only_commented: bool = False) -> Column:
    """F5 in-row: the text of each paragraph of ``with_paragraph_comments`` with its comments appended in order,
    the number of comments and the highlight style (the last comment decides it; null without comments)."""

    def per_para(p):
        mine = p["comments"]
        return F.struct(
            p["idx"].alias("idx"),
            p["text"].alias("text"),
            F.concat(p["text"], F.array_join(F.transform(mine, _render), "")).alias("annotated_text"),
            F.aggregate(mine, F.lit(0).cast("long"), lambda a, c: a + c["copies"]).alias("n_comments"),
            F.when(F.size(mine) > 0, _style(F.element_at(mine, -1)["severity"])).alias("highlight"),
            # each appended comment is written in the font colour of its own severity
            F.flatten(F.transform(mine, lambda c: F.array_repeat(style_value(_style(c["severity"]), 1),
                                                                 c["copies"]))).alias("comment_colors"),
        )

    def style_value(style: Column, i: int) -> Column:
        out = None
        for name, values in RP.ANNOTATION_STYLES.items():
            out = F.when(style == name, F.lit(values[i])) if out is None else out.when(style == name, F.lit(values[i]))
        return out

    def with_color(a):
        return a.withField("highlight_color", style_value(a["highlight"], 0))

    out = F.transform(F.transform(commented, per_para), with_color)
    return F.filter(out, lambda a: a["n_comments"] > 0) if only_commented else out


def annotate(docs: DataFrame, flag_rules: DataFrame | None = None, mode: str = "reference",
             key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """per paragraph, the text with its review comments appended in order, and the
    highlight style (the last comment decides it).  Paragraphs without comments are kept
    unchanged with a null highlight."""
    rules = load_flag_rules(flag_rules, docs.sparkSession)
    d = docs if "paras" in docs.columns else S.with_structure(docs, text_col)
    d = with_paragraph_comments(d.select(key, "paras", "full_text"), rules, mode)
    out = X.inline_rows(d, [key], annotated_paragraphs(F.col("commented")), "idx")
    return out.select(key, F.col("idx").cast("long").alias("idx"), "text", "annotated_text", "n_comments",
                      "highlight", "highlight_color", "comment_colors")
