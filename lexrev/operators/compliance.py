"""Compliance of a batch (K1-K6).

A batch is any grouping column (``batch_col``).  The only shuffle that sees
documents is ``groupBy(batch, type).count()`` with map-side partial
aggregation, so a hot batch is reduced before the exchange; every later step
works on at most (batches x types) rows joined to the small, size-checked
requirement tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.functions.joins import join_keys
from lexrev.session import MAX_COMPILED_RULES, bounded_rows, broadcast_if_small
from lexrev.sources.rules import default_rulepack


COMPLIANCE_COLUMNS = ["process", "status", "completeness_percentage", "total_required", "documents_provided",
                      "documents_matched", "missing_documents", "extra_documents", "recommendations"]


def present_types(classified: DataFrame, batch_col: str, type_col: str = "predicted_type") -> DataFrame:
    """(batch, doc_type, n, first_doc): documents per type, duplicates counted."""
    return classified.groupBy(batch_col, F.col(type_col).alias("doc_type")).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")
    )


def _process_table(process_rules: DataFrame | list | None, spark) -> list[tuple[str, list[str], int]]:
    """Bounded process indicators as (process, indicator types, threshold), by priority (a loaded list passes through)."""
    if isinstance(process_rules, list):
        return process_rules
    if process_rules is None:
        process_rules = default_rulepack(spark, "process_rules")
    rows = bounded_rows(process_rules, MAX_COMPILED_RULES, "process rules")
    by_proc: dict[str, tuple[int, int, list[str]]] = {}
    for r in rows:
        prio, thr, types = by_proc.get(r.process, (r.priority, r.threshold, []))
        by_proc[r.process] = (prio, thr, types + [r.doc_type])
    return [(p, types, thr) for p, (prio, thr, types) in sorted(by_proc.items(), key=lambda kv: kv[1][0])]


def _requirement_table(requirements: DataFrame | dict | None, spark) -> dict[str, list[str]]:
    if isinstance(requirements, dict):
        return requirements
    if requirements is None:
        requirements = default_rulepack(spark, "requirements")
    out: dict[str, list[str]] = {}
    for r in bounded_rows(requirements, MAX_COMPILED_RULES, "requirements"):
        out.setdefault(r.process, []).append(r.doc_type)
    return out


def _per_batch(present: DataFrame, batch_col: str) -> DataFrame:
    """One row per batch: its document types as a map type -> count (bounded by the type list)."""
    return present.groupBy(batch_col).agg(
        F.map_from_entries(F.collect_list(F.struct("doc_type", "n"))).alias("_types"),
        F.sum("n").cast("long").alias("documents_provided"),
    )


def _process_column(types: Column, table: list[tuple[str, list[str], int]]) -> Column:
    """K1 in-row: the first process (by priority) whose indicator documents reach its threshold."""
    expr = None
    for proc, indicators, threshold in table:
        cnt = F.lit(0).cast("long")
        for t in indicators:
            cnt = cnt + F.coalesce(F.try_element_at(types, F.lit(t)), F.lit(0)).cast("long")
        cond = cnt >= F.lit(threshold)
        expr = F.when(cond, F.lit(proc)) if expr is None else expr.when(cond, F.lit(proc))
    return F.lit(RP.DEFAULT_PROCESS) if expr is None else expr.otherwise(F.lit(RP.DEFAULT_PROCESS))


def determine_process(classified: DataFrame, batch_col: str, process_rules: DataFrame | None = None,
                      type_col: str = "predicted_type", present: DataFrame | None = None) -> DataFrame:
    """K1: first process (by priority) whose indicator documents reach its threshold (duplicates count)."""
    spark = classified.sparkSession
    present = present if present is not None else present_types(classified, batch_col, type_col)
    table = _process_table(process_rules, spark)
    return _per_batch(present, batch_col).select(batch_col, _process_column(F.col("_types"), table).alias("process"))


def _required(process: DataFrame, batch_col: str, requirements: DataFrame | None) -> DataFrame:
    if requirements is None:
        requirements = default_rulepack(process.sparkSession, "requirements")
    return process.join(broadcast_if_small(requirements), "process").select(batch_col, "process", "doc_type")


def missing_documents(process: DataFrame, present: DataFrame, batch_col: str,
                      requirements: DataFrame | None = None, req: DataFrame | None = None) -> DataFrame:
    """K3: required types not present in the batch."""
    req = req if req is not None else _required(process, batch_col, requirements)
    return join_keys(req, present.select(batch_col, "doc_type"), [batch_col, "doc_type"], "left_anti")


def extra_documents(process: DataFrame, present: DataFrame, batch_col: str,
                    requirements: DataFrame | None = None, req: DataFrame | None = None) -> DataFrame:
    """K4: present types the process does not require."""
    req = req if req is not None else _required(process, batch_col, requirements)
    return join_keys(present.select(batch_col, "doc_type"), req, [batch_col, "doc_type"], "left_anti")


def matched_documents(process: DataFrame, present: DataFrame, batch_col: str,
                      requirements: DataFrame | None = None, req: DataFrame | None = None) -> DataFrame:
    """K5: present types the process requires."""
    req = req if req is not None else _required(process, batch_col, requirements)
    return join_keys(present.select(batch_col, "doc_type"), req, [batch_col, "doc_type"], "left_semi")


def recommendations(missing: DataFrame, batch_col: str) -> DataFrame:
    """K6: one sentence per missing document type."""
    return missing.select(
        batch_col, "doc_type", _recommendation(F.col("doc_type"), F.col("process")).alias("recommendation"))


def _recommendation(doc_type: Column, process: Column) -> Column:
    return F.concat(F.lit("Please provide "), X.title_words(doc_type), F.lit(" to complete your "),
                    F.regexp_replace(process, "_", " "), F.lit(" submission"))


def with_compliance(b: DataFrame, process_rules=None, requirements=None) -> DataFrame:
    """K1-K6 of rows that hold a batch's types (``_types``, ``documents_provided``), as further columns.

    The process, required, missing, extra and matched sets are computed in the row from the bounded rule
    tables (``array_except`` / ``array_intersect``), without shuffles.
    """
    spark = b.sparkSession
    table = _process_table(process_rules, spark)
    b = b.withColumn("process", _process_column(F.col("_types"), table))
    req = None
    for proc, types in _requirement_table(requirements, spark).items():
        arr = F.array(*[F.lit(t) for t in types])
        req = F.when(F.col("process") == proc, arr) if req is None else req.when(F.col("process") == proc, arr)
    empty = F.array().cast("array<string>")
    b = b.withColumns({"_req": empty if req is None else req.otherwise(empty), "_have": F.map_keys("_types")})
    b = b.withColumns({
        "missing_documents": F.array_sort(F.array_except("_req", "_have")),
        "extra_documents": F.array_sort(F.array_except("_have", "_req")),
        "matched_documents": F.array_sort(F.array_intersect(F.array_distinct("_req"), F.col("_have"))),
    })
    n_set = F.size(F.array_distinct("_req"))
    matched = F.size("matched_documents").cast("long")
    return b.withColumns({
        "status": F.when(F.size("missing_documents") == 0, "Complete").otherwise("Incomplete"),
        "completeness_percentage": F.when(n_set > 0, X.round_half_up(
            matched.cast("double") / n_set.cast("double") * F.lit(100.0), 1)).otherwise(F.lit(100.0)),
        "total_required": F.size("_req").cast("long"),
        "documents_matched": matched,
        "recommendations": F.array_sort(F.transform("missing_documents", lambda t: _recommendation(t, F.col("process")))),
    })


def compliance_sets(classified: DataFrame | None, batch_col: str, process_rules=None, requirements=None,
                    type_col: str = "predicted_type", present: DataFrame | None = None) -> DataFrame:
    """One row per batch with K1-K6, the missing, extra and matched types as arrays.

    Documents are counted per (batch, type) with partial aggregation and then gathered per batch (a map
    bounded by the type list): the documents are read once.
    """
    if present is None:
        present = present_types(classified, batch_col, type_col)
    return with_compliance(_per_batch(present, batch_col), process_rules, requirements)


def compliance(classified: DataFrame | None, batch_col: str, process_rules=None, requirements=None,
               type_col: str = "predicted_type", present: DataFrame | None = None) -> DataFrame:
    """K2 with K1 and K3-K6 folded in: one row per batch."""
    b = compliance_sets(classified, batch_col, process_rules, requirements, type_col, present)
    return b.select(batch_col, *COMPLIANCE_COLUMNS)
