"""Quality scores from NULL rates and negative amounts, one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.measures import rows

# Points lost per percent of NULLs in a critical column.
NULL_PENALTY = 2


@dataclass(frozen=True)
class QualityCheck:
    """Columns whose NULLs lower the score, and columns whose negatives are counted."""

    critical: Sequence[str]
    non_negative: Sequence[str] = ()


def null_percentage(name: str) -> Column:
    """Percentage of NULLs; 0 for an empty input."""
    nulls = F.count_if(F.col(name).isNull())
    return F.coalesce(F.try_divide(nulls, rows()) * 100, F.lit(0.0))


def quality_score(df: DataFrame, check: QualityCheck) -> DataFrame:
    """One row: record count, NULL percentages, negative counts and the score.

    The score starts at 100 and may fall below 0; negatives are reported, not scored.
    """
    measured = df.agg(
        rows().alias("total_records"),
        *(null_percentage(name).alias(f"{name}_null_percentage") for name in check.critical),
        *(
            F.count_if(F.col(name) < 0).alias(f"{name}_negative_count")
            for name in check.non_negative
        ),
    )
    score = reduce(
        lambda left, name: left - F.col(f"{name}_null_percentage") * NULL_PENALTY,
        check.critical,
        F.lit(100.0),
    )
    return measured.withColumn("quality_score", score)


def quality_by_table(tables: Mapping[str, tuple[DataFrame, QualityCheck]]) -> DataFrame:
    """The scores of several tables as ``table_name, metric, value, total_records, quality_score``."""
    return reduce(
        DataFrame.unionByName,
        (_long_form(name, df, check) for name, (df, check) in tables.items()),
    )


def _long_form(table: str, df: DataFrame, check: QualityCheck) -> DataFrame:
    metrics = [f"{name}_null_percentage" for name in check.critical]
    metrics += [f"{name}_negative_count" for name in check.non_negative]
    if not metrics:
        raise ValueError(f"no column of {table} to check")
    lines = [
        F.struct(F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"))
        for metric in metrics
    ]
    return quality_score(df, check).select(
        F.lit(table).alias("table_name"),
        F.inline(F.array(*lines)),
        "total_records",
        "quality_score",
    )
