"""Row-level differences between two snapshots of a dataset."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of change whose rows are in the new snapshot.
ADDED = ("insert", "update_postimage")


def snapshot_changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that differ, with ``_change_type``: insert, delete, update_preimage, update_postimage.

    Equal rows cancel out first, so that only changed rows are grouped by ``key``; a key with
    rows on both sides is an update. ``key`` is expected to identify a record within each
    snapshot; rows that are repeated all the same appear once, with the difference in their
    number as ``_row_count``. Columns of ``new`` set the layout; NULLs equal each other.
    """
    columns = new.columns
    weighed = old.select(*columns, F.lit(-1).alias("_w")).unionByName(
        new.select(*columns, F.lit(1).alias("_w"))
    )
    net = weighed.groupBy(*columns).agg(F.sum("_w").alias("_net")).filter("_net <> 0")

    # Signs are aggregated before they are shuffled, and joined back: a join's hot keys can be
    # split, a window's cannot.
    signs = net.groupBy(*(F.col(name).alias(f"_{name}") for name in key)).agg(
        ((F.min("_net") < 0) & (F.max("_net") > 0)).alias("_both")
    )
    same_key = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in key))
    kind = (
        F.when(F.col("_net") > 0, F.when(F.col("_both"), "update_postimage").otherwise("insert"))
        .when(F.col("_both"), "update_preimage")
        .otherwise("delete")
    )
    return (
        net.join(signs, same_key)
        .select(*columns, kind.alias("_change_type"), F.abs("_net").alias("_row_count"))
    )
