"""Deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows that one part of a group holds, at most and about: what a task sorts and a file keeps.
ROWS_IN_PART = 500_000
_GROUP, _PARTS, _PART = "_group", "_parts", "_part"


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The smallest record of every ``key``, compared by ``order`` with NULLs last.

    NULL keys are equal to each other and the surviving row is one whole input row. A rank
    filter is planned as a group limit on both sides of the shuffle: every map task sends at
    most one row per key, so a key holding a large part of all rows stays a small group.
    """
    ranked = Window.partitionBy(*key).orderBy(*(F.asc_nulls_last(name) for name in order))
    return (
        df.withColumn("_position", F.row_number().over(ranked))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def keep_first_grouped(df: DataFrame, key: Sequence[str], order: Sequence[str], group: str) -> DataFrame:
    """The rows of ``keep_first``, dealt by ``group`` and sorted by it: a write by ``group`` needs no other shuffle.

    Equal keys must be of one group, and groups few enough to be listed. A group comes in as many
    parts, by the hash of the key, as its rows fill. Only a part that holds far more is trimmed
    before the shuffle: there a key with a large part of all rows leaves every map task as one row.
    Rows are counted when this is called, so ``df`` should be stored.
    """
    spark = df.sparkSession
    counted = df.groupBy(group).count()
    parts = counted.select(F.col(group).alias(_GROUP), F.ceil(F.col("count") / ROWS_IN_PART).alias(_PARTS))
    parts = F.broadcast(spark.createDataFrame(parts.collect(), parts.schema))
    dealt = df.join(parts, F.col(group).eqNullSafe(F.col(_GROUP)))
    dealt = dealt.withColumn(_PART, F.pmod(F.xxhash64(*key), _PARTS)).drop(_GROUP, _PARTS)
    crowded = dealt.groupBy(group, _PART).count().filter(F.col("count") > 2 * ROWS_IN_PART).drop("count")
    if found := crowded.collect():
        crowded = F.broadcast(spark.createDataFrame(found, crowded.schema))
        trimmed = keep_first(dealt.join(crowded, [group, _PART], "left_semi"), key, order)
        dealt = dealt.join(crowded, [group, _PART], "left_anti").unionByName(trimmed)
    return keep_first(dealt.repartition(group, _PART), [group, _PART, *key], order).drop(_PART)
