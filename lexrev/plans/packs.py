"""Rule packs of a review (S7): loaded once, then handed to every consumer as plain lists."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lexrev.operators import classify as C
from lexrev.operators import compliance as K
from lexrev.operators import flags as FL
from lexrev.sources.rules import SCHEMAS, read_rulepack

REJECTED_SCHEMA = "pack string, rule string, reason string"


@dataclass(frozen=True)
class RulePacks:
    type_rules: list
    flag_rules: list[FL.FlagRule]
    clauses: list[tuple[str, str, str]]
    requirements: dict[str, list[str]]
    process_rules: list[tuple[str, list[str], int]]
    #: rules that cannot be used, as (pack, rule, reason); the others still apply
    rejected: list[tuple[str, str, str]] = field(default_factory=list)

    def rejected_rules(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rejected, REJECTED_SCHEMA)


def load_packs(spark: SparkSession, **tables: DataFrame) -> RulePacks:
    """The given rule tables (by the names of ``sources.rules.SCHEMAS``); a pack not given is the default one."""
    unknown = set(tables) - set(SCHEMAS)
    if unknown:
        raise ValueError(f"unknown rule packs {sorted(unknown)}")
    rejected: list[tuple[str, str, str]] = []
    return RulePacks(
        C.load_type_rules(tables.get("type_rules"), spark, rejected),
        FL.load_flag_rules(tables.get("flag_rules"), spark, rejected),
        FL.load_clauses(tables.get("clauses"), spark),
        K._requirement_table(tables.get("requirements"), spark),
        K._process_table(tables.get("process_rules"), spark),
        rejected,
    )


def read_packs(spark: SparkSession, folder: str | None) -> RulePacks:
    """The packs ``<folder>/<name>.json`` (JSON lines) that exist, the default ones for the rest."""
    tables = {}
    for kind in SCHEMAS if folder else ():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{kind}.json")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            tables[kind] = read_rulepack(spark, path.toString(), kind)
    return load_packs(spark, **tables)
