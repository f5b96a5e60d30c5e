"""Review fixture corpus.

The driver's test prose almost never contains legal vocabulary, so the
checks run on ``seeded_documents``: every document keeps its whole text and
gets one fixture clause set (a heading before it and/or clauses after it),
picked by ``pmod(doc_id, len(SEED_CLAUSES))``.  All rows are kept; the work
grows with the documents table.  The fixture sentences come from the
reviewed application's own checks plus edge rows from FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: (head, tail) appended around the document text; None = nothing.
SEED_CLAUSES: list[tuple[str | None, str | None]] = [
    (None, None),
    (None, "Article 1: Company Name. The company shall be known as Test Corporation Limited."),
    (None, "This agreement is governed by UAE Federal Courts and shall be subject to UAE law."),
    ("Articles of Association for Test Company Limited. This document contains governance provisions.", None),
    ("ARTICLES OF ASSOCIATION",
     "ARTICLE 2 Board of Directors\nThe board of directors shall convene the general meeting and the annual general "
     "meeting. Share capital and voting rights are set by the shareholders.\nDEFINITIONS AND TERMS"),
    ("Memorandum of Association",
     "The objects of the company are stated. The liability of members is limited. The registered office is in Abu "
     "Dhabi and the company is registered in UAE.\nSchedule A Fees and amounts"),
    ("UBO Declaration",
     "The ultimate beneficial owner holds 25% ownership through a nominee arrangement.\nControl structure and "
     "beneficial interest are disclosed; the ownership structure was reviewed."),
    (None,
     "1. The parties shall act without ADGM approval.\n(a) Any breach shall be void.\n- Penalty for default and "
     "non-compliance: the party is liable for damages.\n• Each party must pay the fee."),
    (None,
     "Section 12 Definitions\n\"Company\" means the company incorporated in United Arab Emirates Abu Dhabi Global "
     "Market pursuant to ADGM Regulations 2020.\nA company incorporated in UAE must register."),
    (None, "Name | Director | Member\nAlice Smith | Yes | No\nBob | No | Yes"),
    (None, "Amount | Fee | Cost\n100 | 20 | 5"),
    ("PART IV Governance of the Company",
     "Whereas the shareholders meeting was convened, it is resolved that the board resolution was adopted.\n"
     "Companies Regulations 2015 and Financial Services and Markets Regulations 2015 apply."),
    (None,
     "This contract is governed by UAE laws and the UAE legal system. UAE lawsuit pending.\nIncorporated in UAE "
     "ADGM and registered in  United Arab Emirates Abu Dhabi Global Market."),
    (None,
     "Chapter 3 Final Provisions\nThe Conclusion of this agreement hereby follows in accordance with the "
     "aforementioned terms and conditions and consideration, subject to the jurisdiction of the court under the "
     "warranty and covenant."),
    (None, "Appendix B Exhibit list\nDeadline | Date\n1 May | 2 June"),
    (None,
     "Acme Holdings Limited and Beta Trading Co signed with Gamma Corp.\n\U0001F600\U0001F600 UAE law applies; "
     "this is governed by\nUAE law in full."),
    ("Recital A The parties agree.",
     "Clause 7. Jurisdiction: UAE Federal Court decisions were reviewed and were amended by the board of directors "
     "of Delta Ltd."),
]
# END FIXED VALUES

# A pack other than the default one, with a fourth severity and a named group:
# (pattern, issue, severity, suggestion, reference, category); the last pattern does not compile and is rejected.
CUSTOM_FLAG_RULES = [
    ("shall be (void|subject)", "Void clause", "Critical", "Rewrite the clause", "", "governing_law"),
    ("(?P<who>company|party) must", "Duty", "Low", "Name the duty", "", "duty"),
    ("board of directors", "Board", "Medium", "Check the board", "", "board"),
    ("limited (", "Broken", "High", "None", "", "broken"),
]

# Rules with their RE2 twins (None: the same). All but the last need Python's engine: a conditional group, the end of the
# text, and brackets and ampersands in a class, which Java takes otherwise.
SEARCHED_FLAG_RULES = [
    ("(board of )?directors(?(1)\\b| shall)", "Board", "High", "Name the board", "", "board", "board of directors\\b|directors shall"),
    ("full\\.\\Z", "Last word", "Low", "Check the end", "", "end", "full\\.\\z"),
    ("[a&&y]greement", "Agreement", "Medium", "Name the contract", "", "contract", "[a&y]greement"),
    ("shareholders", "Members", "Medium", "Name the members", "", "members", None),
]

SEED_SCHEMA = T.StructType([
    T.StructField("seed", T.IntegerType()),
    T.StructField("head", T.StringType()),
    T.StructField("tail", T.StringType()),
])


def seeded_documents(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its fixture clauses (broadcast join with the 17-row seed table)."""
    spark = docs.sparkSession
    seeds = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(SEED_CLAUSES)], SEED_SCHEMA)
    k = len(SEED_CLAUSES)
    out = docs.withColumn("seed", F.pmod(F.col(key), F.lit(k)).cast("int")).join(F.broadcast(seeds), "seed", "left")
    return out.withColumn(text_col, F.concat_ws("\n", F.col("head"), F.col(text_col), F.col("tail"))).drop(
        "seed", "head", "tail"
    )


def phrase_rules(passages: DataFrame, key: str = "item_id", text_col: str = "text") -> DataFrame:
    """A type-rule pack that grows with its passages: their runs of two to five words, a type a passage.

    Pairs of plain words are patterns (any run of blanks, commas and stops between them); the longer runs are keywords.
    """
    words = F.filter(F.split(F.lower(F.col(text_col)), "[ \\n]+"), lambda w: w != "")
    at = passages.select(F.col(key).cast("int").alias("type_order"), words.alias("w")).select(
        "type_order", "w", F.explode(F.sequence(F.lit(2), F.lit(5))).alias("n")).where("size(w) >= n").select(
        "type_order", "w", "n", F.explode(F.expr("sequence(1, size(w) - n + 1)")).alias("ord"))
    run = F.slice("w", F.col("ord"), F.col("n"))
    plain = F.forall(run, lambda w: w.rlike("^[a-z]+$"))
    kind = F.element_at(F.array(*[F.lit(k) for k in ("pattern", "primary", "secondary", "section")]), F.col("n") - 1)
    weight = F.element_at(F.array(*[F.lit(x) for x in (2.0, 3.0, 4.0, 5.0)]), F.col("n") - 1)
    return at.where((F.col("n") > 2) | plain).select(
        F.concat(F.lit("item_"), "type_order").alias("type"), "type_order", kind.alias("kind"), "ord",
        F.when(F.col("n") == 2, F.array_join(run, "[ ,.]+")).otherwise(F.array_join(run, " ")).alias("term"),
        weight.alias("weight"), (F.col("n") == 2).alias("is_regex"))


def seeds_sql_values() -> str:
    """The seed table as a DuckDB VALUES list (for the oracle queries)."""

    def lit(s):
        return "NULL" if s is None else "'" + s.replace("'", "''") + "'"

    rows = ", ".join(f"({i}, {lit(h)}, {lit(t)})" for i, (h, t) in enumerate(SEED_CLAUSES))
    return f"(VALUES {rows}) AS s(seed, head, tail)"


def faulty_documents(docs: DataFrame) -> DataFrame:
    """Every document, with faults for the quarantine by ``pmod(doc_id, 97)``: 1 loses its id, 2 takes the
    document's id two below, 3 loses its text, 4 has blank text."""
    m = F.pmod(F.col("doc_id"), F.lit(97))
    return docs.withColumns({
        "doc_id": F.when(m == 1, F.lit(None)).when(m == 2, F.col("doc_id") - 2).otherwise(F.col("doc_id")),
        "text": F.when(m == 3, F.lit(None)).when(m == 4, F.lit(" \t\n")).otherwise(F.col("text")),
    })
