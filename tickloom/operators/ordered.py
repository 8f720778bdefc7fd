"""Running sums over an order that no task sees whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def running(df: DataFrame, order: str, sums: dict[str, Column], before: dict[str, Column] | None = None) -> DataFrame:
    """df with `place` (0, 1, ... by the order column), for each of sums its sum over all earlier rows, and for each of before
    its value in the row before (null in the first row of a range).

    Rows are dealt into ranges of the order; ranges' totals, a line for each range, make what each begins with. The order
    column must hold no value twice; its nulls come first."""
    ranges = stored(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    sums = {"place": F.lit(1)} | sums
    totals = ranges.groupBy("_range").agg(*(F.sum(c).alias(f"_{k}") for k, c in sums.items()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *(F.coalesce(F.sum(f"_{k}").over(earlier), F.lit(0)).alias(f"_{k}") for k in sums))
    own = Window.partitionBy("_range").orderBy(order)
    upto = own.rowsBetween(Window.unboundedPreceding, -1)
    rows = ranges.withColumns({k: F.coalesce(F.sum(c).over(upto), F.lit(0)) for k, c in sums.items()} | {k: F.lag(c).over(own) for k, c in (before or {}).items()})
    rows = rows.join(F.broadcast(offsets), "_range")  # a line for each range
    return rows.withColumns({k: (F.col(k) + F.col(f"_{k}")).cast("long") for k in sums}).drop("_range", *(f"_{k}" for k in sums))
