"""Rule packs as tables (S7): built from the default packs or read from JSON files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lexrev import rulepacks as RP

TYPE_RULES_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("type_order", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("ord", T.IntegerType()),
    T.StructField("term", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("is_regex", T.BooleanType()),
])
FLAG_RULES_SCHEMA = T.StructType([
    T.StructField("rule_id", T.IntegerType()),
    T.StructField("pattern", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("suggestion", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("category", T.StringType()),
])
CLAUSES_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("template", T.StringType()),
    T.StructField("reference", T.StringType()),
])
REQUIREMENTS_SCHEMA = T.StructType([
    T.StructField("process", T.StringType()),
    T.StructField("doc_type", T.StringType()),
])
PROCESS_RULES_SCHEMA = T.StructType([
    T.StructField("process", T.StringType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("threshold", T.IntegerType()),
    T.StructField("priority", T.IntegerType()),
])

SCHEMAS = {
    "type_rules": TYPE_RULES_SCHEMA,
    "flag_rules": FLAG_RULES_SCHEMA,
    "clauses": CLAUSES_SCHEMA,
    "requirements": REQUIREMENTS_SCHEMA,
    "process_rules": PROCESS_RULES_SCHEMA,
}

KINDS = ["primary", "secondary", "pattern", "section"]


def type_rule_rows(lexicon: dict | None = None, weights: dict | None = None) -> list[tuple]:
    lexicon = lexicon or RP.TYPE_LEXICON
    weights = weights or RP.KIND_WEIGHTS
    rows = []
    for t_ord, (typ, kinds) in enumerate(lexicon.items()):
        for kind in KINDS:
            for o, term in enumerate(kinds.get(kind, [])):
                rows.append((typ, t_ord, kind, o, term, float(weights[kind]), kind == "pattern"))
    return rows


def flag_rule_rows() -> list[tuple]:
    return [(i, *r) for i, r in enumerate(RP.FLAG_RULES)]


def requirement_rows() -> list[tuple]:
    return [(p, t) for p, types in RP.REQUIREMENTS.items() for t in types]


def process_rule_rows() -> list[tuple]:
    return [(p, t, thr, prio) for prio, (p, types, thr) in enumerate(RP.PROCESS_INDICATORS) for t in types]


def default_rulepack(spark: SparkSession, kind: str, wide: bool = False) -> DataFrame:
    if kind == "type_rules":
        rows = type_rule_rows(RP.WIDE_TYPE_LEXICON if wide else RP.TYPE_LEXICON)
    elif kind == "flag_rules":
        rows = flag_rule_rows()
    elif kind == "clauses":
        rows = list(RP.CLAUSE_TEMPLATES)
    elif kind == "requirements":
        rows = requirement_rows()
    elif kind == "process_rules":
        rows = process_rule_rows()
    else:
        raise ValueError(f"unknown rule pack {kind!r}")
    # from pandas: a local relation whose exact size the optimizer knows (no job to size it)
    schema = SCHEMAS[kind]
    return spark.createDataFrame(pd.DataFrame(rows, columns=schema.fieldNames()), schema)


def read_rulepack(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Read a rule pack written as JSON lines with the fixed schema of ``kind``."""
    return spark.read.schema(SCHEMAS[kind]).json(path)


def all_clauses(spark: SparkSession) -> DataFrame:
    """The clause catalogue (``get_all_suggestions``)."""
    return default_rulepack(spark, "clauses")
