"""Joins on grouping keys that may be null (a batch column can hold nulls: they form one batch)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: list[str] | str, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` with null-safe equality (``<=>``), keeping one copy of each key.

    Still planned as a hash / sort-merge / broadcast equi-join; the right side's keys are
    renamed first so joins between relations of one lineage are never ambiguous.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    renamed = right.select(*[F.col(c).alias(f"_rk_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_rk_{k}")) for k in keys])
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*[f"_rk_{k}" for k in keys])
