"""Named aggregate expressions, so that a report reads as a list of its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Measures = dict[str, Column]


def rows() -> Column:
    return F.count(F.lit(1))


def rollup(df: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    """One row per key combination; NULL is a key value like any other."""
    return df.groupBy(*keys).agg(*(column.alias(name) for name, column in measures.items()))


def extend(df: DataFrame, *steps: Measures) -> DataFrame:
    """Add derived columns, one projection per step; a step may use the step before."""
    for step in steps:
        df = df.select("*", *(column.alias(name) for name, column in step.items()))
    return df
