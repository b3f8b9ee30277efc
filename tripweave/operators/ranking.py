"""Ranks, shares and comparisons with earlier rows, on aggregated data.

The unpartitioned windows here run in one task. They are meant for inputs whose row number
follows from the calendar (days, weeks) or from a fixed set of labels, never for trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import scratch_path


def rank_within(groups: Sequence[str], value: str) -> Column:
    """Dense rank by ``value``, largest first, inside each group."""
    return F.dense_rank().over(Window.partitionBy(*groups).orderBy(F.desc(value)))


def group_total(groups: Sequence[str], value: str) -> Column:
    """Sum of ``value`` over the row's group."""
    return F.sum(value).over(Window.partitionBy(*groups))


def overall_max(value: str) -> Column:
    """Largest ``value`` of the whole input, on every row."""
    return F.max(value).over(Window.partitionBy())


def previous_row(order: str, value: str) -> Column:
    """``value`` of the row before; not of the day or week before where there are gaps."""
    return F.lag(value).over(Window.orderBy(order))


def trailing_mean(order: str, value: str, length: int) -> Column:
    """Mean of ``value`` over the last ``length`` rows including this one."""
    frame = Window.orderBy(order).rowsBetween(1 - length, Window.currentRow)
    return F.avg(value).over(frame)


def overall_dense_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Dense rank of every row by ``value``, largest first, over the whole input.

    Ranks come from the distinct values alone, so that a value of very many rows costs what
    any other does: they are dealt into ranges of about equal size, ranked inside each, and
    every range is shifted by the number of values above it. The one task over all ranges sees
    one row of each. NaN ranks first, NULL last, as in a window over all rows.

    Rows and ranges are written to the shared folder when this is called, because the bounds
    of ranges are drawn from the values and must be the same for all that reads them.
    """
    rows = _written(df, "ranked-rows")
    values = rows.select(F.col(value).alias("_value")).distinct()
    dealt = values.repartitionByRange(F.desc("_value"))
    dealt = _written(dealt.withColumn("_range", F.spark_partition_id()), "ranked-values")
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_shift"))
    )
    local = F.row_number().over(Window.partitionBy("_range").orderBy(F.desc("_value")))
    ranks = (
        dealt.withColumn("_local", local)
        .join(shifts, "_range")
        .select("_value", (F.col("_shift") + F.col("_local")).cast("int").alias(name))
    )
    return rows.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
