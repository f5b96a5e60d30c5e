"""Segmentation (P1-P14): paragraphs, sections, text tables, document structure.

Every document is handled inside its own row: paragraphs, sections and
table islands are arrays computed with higher-order functions, so the whole
segmentation is one narrow projection over the scan (no shuffle, no window).
Rows are exploded only when the caller asks for paragraph/section/table grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexrev import rulepacks as RP
from lexrev.functions import text as X

SECTION_REGEX = X.py_regex("^(?:" + "|".join(RP.SECTION_PATTERNS) + ")", ignore_case=True)
HEADER_REGEX = X.py_regex(RP.HEADER_PATTERN, ignore_case=True)
LIST_ITEM_REGEX = X.py_regex("^(?:" + RP.LIST_ITEM_PATTERN[1:] + ")")
TABLE_ROW_MARK = " | "


# ----------------------------------------------------------------- P2 - P6
def is_header(c: Column) -> Column:
    """All-caps text, or a numbered ARTICLE/SECTION/CLAUSE/PART/CHAPTER prefix."""
    return X.is_upper(c) | F.coalesce(c.rlike(HEADER_REGEX), F.lit(False))


def is_list_item(c: Column) -> Column:
    """Starts with ``1.``, ``(a)`` or a bullet/dash/star (every branch anchored)."""
    return F.coalesce(X.py_strip(c).rlike(LIST_ITEM_REGEX), F.lit(False))


def content_type(c: Column) -> Column:
    """First matching class of the lower-cased paragraph."""
    lt = F.lower(F.coalesce(c, F.lit("")))
    return (
        F.when(lt == "", "empty")
        .when(is_header(lt), "header")
        .when(is_list_item(lt), "list_item")
        .when(X.word_count(c) < 5, "short_text")  # lower-casing never changes the word count
        .when(X.contains_any(lt, RP.OBLIGATION_WORDS), "legal_obligation")
        .when(X.contains_any(lt, RP.DEFINITION_WORDS), "definition")
        .otherwise("body_paragraph")
    )


def legal_significance(c: Column) -> Column:
    """P5: number of distinct significance words contained."""
    n = X.contains_count(F.lower(F.coalesce(c, F.lit(""))), RP.SIGNIFICANCE_WORDS)
    return F.when(n >= 3, "high").when(n >= 1, "medium").otherwise("low")


def matches_section_pattern(c: Column) -> Column:
    """One anchored alternation of the section prefixes, any case."""
    return F.coalesce(c.rlike(SECTION_REGEX), F.lit(False))


# ----------------------------------------------------------------- P8, P9
def section_type(title: Column) -> Column:
    t = F.lower(F.coalesce(title, F.lit("")))
    return (
        F.when(t.contains("definition"), "definitions")
        .when(X.contains_any(t, RP.SECTION_PROVISION_WORDS), "legal_provision")
        .when(t.contains("schedule") | t.contains("appendix"), "appendix")
        .otherwise("general_section")
    )


def section_importance(title: Column) -> Column:
    t = F.lower(F.coalesce(title, F.lit("")))
    return (
        F.when(X.contains_any(t, RP.SECTION_IMPORTANT_WORDS), "high")
        .when(X.contains_any(t, RP.SECTION_ANNEX_WORDS), "low")
        .otherwise("medium")
    )


# ----------------------------------------------------------------- per-document arrays
# Built in stages (separate projections): an array used by several later expressions is
# materialised once, because higher-order functions evaluate their inputs without
# common-subexpression elimination (an inline array would be recomputed per element access).
def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def stripped_lines(text: Column) -> Column:
    return F.transform(lines_of(text), lambda l: X.py_strip(l))


def paragraphs_from_lines(lines: Column) -> Column:
    """P1 as an array: non-empty stripped lines with their line index (empties counted)."""
    tagged = F.transform(lines, lambda l, i: F.struct(i.alias("idx"), l.alias("text")))
    kept = F.filter(tagged, lambda p: p["text"] != "")
    headed = F.transform(kept, lambda p: F.struct(
        p["idx"].alias("idx"), p["text"].alias("text"), is_header(p["text"]).alias("is_header")))
    return F.transform(headed, lambda p: F.struct(
        p["idx"].alias("idx"), p["text"].alias("text"), p["is_header"].alias("is_header"),
        (p["is_header"] | matches_section_pattern(p["text"])).alias("opens_section")))


def full_text_from_text(text: Column) -> Column:
    """P10 straight from the raw text: non-empty stripped lines joined by one space."""
    return F.array_join(F.filter(stripped_lines(text), lambda l: l != ""), " ")


def full_text_of(paras: Column) -> Column:
    """P10: paragraphs joined by one space."""
    return F.array_join(F.transform(paras, lambda p: p["text"]), " ")


def section_starts(paras: Column) -> Column:
    """Positions (0-based) of the section openers."""
    return F.filter(F.transform(paras, lambda p, i: F.when(p["opens_section"], i)), lambda x: x.isNotNull())


def sections_from(paras: Column, starts: Column) -> Column:
    """An opener starts a section and is its first paragraph; earlier paragraphs belong to none."""
    n = F.size(paras)

    def one(s, k):
        nxt = F.coalesce(F.try_element_at(starts, k + 2), n)
        members = F.slice(paras, s + 1, nxt - s)
        return F.struct(
            (k + 1).alias("sec"),
            F.element_at(paras, s + 1)["text"].alias("title"),
            F.transform(members, lambda p: F.struct(p["idx"].alias("idx"), p["text"].alias("text"))).alias("paragraphs"),
        )

    return F.transform(starts, one)


def table_flags(lines: Column) -> Column:
    return F.transform(lines, lambda l: l.contains(TABLE_ROW_MARK))


def island_bounds(flags: Column) -> tuple[Column, Column]:
    """First and last line index of every run of flagged lines."""
    n = F.size(flags)
    starts = F.filter(
        F.transform(flags, lambda f, i: F.when(f & F.when(i > 0, ~F.element_at(flags, i)).otherwise(F.lit(True)), i)),
        lambda x: x.isNotNull(),
    )
    ends = F.filter(
        F.transform(flags, lambda f, i: F.when(
            f & F.when(i < n - 1, ~F.element_at(flags, i + 2)).otherwise(F.lit(True)), i)),
        lambda x: x.isNotNull(),
    )
    return starts, ends


def tables_from(lines: Column, starts: Column, ends: Column, min_rows: int = 1) -> Column:
    """Islands of adjacent lines holding ' | ' become tables of trimmed cells."""
    islands = F.transform(
        starts,
        lambda s, k: F.struct(
            s.alias("first_line"),
            F.transform(
                F.slice(lines, s + 1, F.element_at(ends, k + 1) - s + 1),
                lambda row: F.transform(F.split(row, "\\|", -1), lambda c: X.py_strip(c)),
            ).alias("rows"),
        ),
    )
    kept = F.filter(F.when(X.pinned(ends), islands), lambda t: F.size(t["rows"]) >= min_rows)
    return F.transform(
        kept,
        lambda t, k: F.struct(k.alias("table_idx"), t["first_line"].alias("first_line"), t["rows"].alias("rows")),
    )


def with_structure(docs: DataFrame, text_col: str = "text", min_table_rows: int = 1) -> DataFrame:
    """Add ``paras``, ``full_text``, ``sections`` and ``tables`` arrays to each document row (map-only)."""
    d = docs.withColumn("_lines", stripped_lines(F.col(text_col)))
    d = d.withColumn("paras", paragraphs_from_lines(F.col("_lines"))).withColumn("_tflags", table_flags(F.col("_lines")))
    ts, te = island_bounds(F.col("_tflags"))
    d = (d.withColumn("full_text", full_text_of(F.col("paras")))
         .withColumn("_sstarts", section_starts(F.col("paras")))
         .withColumn("_tstarts", ts).withColumn("_tends", te))
    d = (d.withColumn("sections", sections_from(F.col("paras"), F.col("_sstarts")))
         .withColumn("tables", tables_from(F.col("_lines"), F.col("_tstarts"), F.col("_tends"), min_table_rows)))
    return d.drop("_lines", "_tflags", "_sstarts", "_tstarts", "_tends")


# ----------------------------------------------------------------- P1 rows
def paragraphs(docs: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per kept paragraph with its measures."""
    p = X.explode_rows(docs, [key], lines_of(F.col(text_col)), "raw", "idx")
    p = p.select(key, F.col("idx").cast("long").alias("idx"), X.py_strip(F.col("raw")).alias("text")).where(
        F.col("text") != ""
    )
    t = F.col("text")
    return p.select(
        key,
        "idx",
        "text",
        X.word_count(t).alias("word_count"),
        X.sentence_count(t).alias("sentence_count"),
        is_header(t).alias("is_header"),
        is_list_item(t).alias("is_list_item"),
        content_type(t).alias("content_type"),
        legal_significance(t).alias("legal_significance"),
    )


# ----------------------------------------------------------------- P7-P10 rows
def sections(docs: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per section with type, importance, size and section text."""
    s = X.inline_rows(with_structure(docs.select(key, text_col), text_col), [key], F.col("sections"), "sec")
    ptexts = F.transform(F.col("paragraphs"), lambda p: p["text"])
    return s.select(
        key,
        F.col("sec").cast("long").alias("sec"),
        "title",
        section_type(F.col("title")).alias("section_type"),
        section_importance(F.col("title")).alias("importance"),
        F.size("paragraphs").cast("long").alias("paragraph_count"),
        F.element_at("paragraphs", 1)["idx"].cast("long").alias("first_idx"),
        F.concat(F.col("title"), F.lit(" "), F.array_join(ptexts, " ")).alias("section_text"),
        F.col("paragraphs"),
    )


def section_texts(docs: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """P10: ``title + ' ' + paragraphs`` per section (the title appears twice)."""
    return sections(docs, text_col, key).select(key, "sec", "section_text")


# ----------------------------------------------------------------- P11-P13 rows
def table_has_headers(rows: Column) -> Column:
    """Two or more rows and a first-row cell in capitals or holding a title-case word."""
    first = F.element_at(rows, 1)
    return (F.size(rows) >= 2) & F.exists(
        first, lambda c: (c != "") & (X.is_upper(c) | X.has_title_word(c))
    )


def table_type(rows: Column) -> Column:
    """Ordered substring tests over the text of all rows."""
    t = F.lower(F.array_join(F.flatten(rows), " "))
    return (
        F.when(F.size(rows) == 0, "empty")
        .when(X.contains_any(t, RP.TABLE_PERSONNEL_WORDS), "personnel_list")
        .when(X.contains_any(t, RP.TABLE_FINANCIAL_WORDS), "financial_table")
        .when(X.contains_any(t, RP.TABLE_SCHEDULE_WORDS), "schedule_table")
        .otherwise("general_table")
    )


def text_tables(docs: DataFrame, text_col: str = "text", key: str = "doc_id", min_rows: int = 1) -> DataFrame:
    t = X.inline_rows(with_structure(docs.select(key, text_col), text_col, min_rows), [key], F.col("tables"), "table_idx")
    rows = F.col("rows")
    return t.select(
        key,
        F.col("table_idx").cast("long").alias("table_idx"),
        F.col("first_line").cast("long").alias("first_line"),
        rows.alias("rows"),
        F.size(rows).cast("long").alias("row_count"),
        F.array_max(F.transform(rows, lambda r: F.size(r))).cast("long").alias("column_count"),
        table_has_headers(rows).alias("has_headers"),
        table_type(rows).alias("table_type"),
    )


# ----------------------------------------------------------------- P14
def structure_columns(paras: Column, secs: Column) -> list[Column]:
    n_sec = F.size(secs)
    n_par = F.size(paras)
    titles = F.transform(secs, lambda s: F.lower(s["title"]))
    last_title = F.when(n_sec > 0, F.element_at(titles, -1)).otherwise(F.lit(""))
    headers = F.size(F.filter(paras, lambda p: p["is_header"]))
    return [
        F.when(n_par > 0, F.element_at(paras, 1)["is_header"]).otherwise(F.lit(False)).alias("has_title"),
        F.exists(titles, lambda t: t.contains("introduction")).alias("has_introduction"),
        F.exists(titles, lambda t: t.contains("definition")).alias("has_definitions"),
        X.contains_any(last_title, RP.CONCLUSION_WORDS).alias("has_conclusion"),
        n_sec.cast("long").alias("total_levels"),
        n_sec.cast("long").alias("max_level"),
        F.when(n_sec >= 3, F.lit(1.0)).otherwise(n_sec.cast("double") / F.lit(3.0)).alias("structural_completeness"),
        F.least(
            F.lit(1.0), headers.cast("double") / F.greatest(F.lit(1), n_par).cast("double") * F.lit(5.0)
        ).alias("organization_score"),
    ]


def document_structure(docs: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    s = with_structure(docs.select(key, text_col), text_col)
    return s.select(key, *structure_columns(F.col("paras"), F.col("sections")))
