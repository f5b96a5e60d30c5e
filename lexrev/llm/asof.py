"""As-of join that does not bind a hot key to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexrev.llm.common import join_totals


def last_before(events: DataFrame, key: str, time: str, tie: str, value: Column, width: int, name: str) -> DataFrame:
    """``events`` with column ``name``: ``value`` of the latest earlier event of the same key whose value is not null.

    Earlier means smaller (time, tie); events equal in both never see each other. Each key's events are cut into stretches of ``width`` time units: windows run
    within a stretch, and what a stretch leaves behind is carried over stretches, one row for each. A key with
    a third of all rows is thus spread over its stretches. Events with a null key or time get null.
    """
    cut = events.withColumn("_slot", F.floor(F.col(time) / F.lit(width))).withColumn("_value", value)
    within = Window.partitionBy(key, "_slot").orderBy(time, tie).rowsBetween(Window.unboundedPreceding, -1)
    before = cut.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        "*", F.last("_value", ignorenulls=True).over(within).alias("_before"),
        F.row_number().over(Window.partitionBy(key, "_slot").orderBy(time, tie)).alias("_row"))
    # What the first of equal events sees is earlier than all of them; the sort of the window above serves this one too.
    near = before.withColumn("_near", F.min_by("_before", "_row").over(Window.partitionBy(key, "_slot", time, tie))).drop("_before", "_row")
    left = (cut.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key, "_slot")
            .agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(time, tie))).alias("_left")))
    over = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = left.select(key, "_slot", F.last("_left", ignorenulls=True).over(over).alias("_carried"))
    found = (join_totals(near, carried, [key, "_slot"]).withColumn(name, F.coalesce("_near", "_carried")))
    lost = cut.where(F.col(key).isNull() | F.col(time).isNull()).withColumn(name, F.lit(None).cast(found.schema[name].dataType))
    columns = [*events.columns, name]
    return found.select(*columns).unionByName(lost.select(*columns))
