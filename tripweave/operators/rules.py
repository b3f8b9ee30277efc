"""Data-quality rules: named SQL conditions that warn about rows or drop them.

A rule whose condition is NULL for a row counts as violated.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]

# Rule names and conditions per dataset.
RAW_RULES: Rules = {
    "valid_vendor": "VendorID IS NOT NULL",
    "valid_pickup_time": "tpep_pickup_datetime IS NOT NULL",
    "valid_dropoff_time": "tpep_dropoff_datetime IS NOT NULL",
}
ENRICHED_RULES: Rules = {
    "positive_trip_distance": "trip_distance > 0",
    "positive_passenger_count": "passenger_count > 0",
    "valid_fare": "fare_amount >= 0",
    "valid_trip_duration": "trip_duration_minutes > 0",
}
SILVER_RULES: Rules = {
    "valid_trip_distance": "trip_distance > 0 AND trip_distance < 100",
    "valid_passenger_count": "passenger_count > 0 AND passenger_count <= 6",
    "valid_fare": "fare_amount > 0 AND fare_amount < 500",
    "valid_duration": "trip_duration_minutes > 0 AND trip_duration_minutes < 180",
    "valid_speed": "avg_speed_mph > 0 AND avg_speed_mph < 80",
    "logical_timestamps": "tpep_pickup_datetime < tpep_dropoff_datetime",
}


def apply_expectations(df: DataFrame, rules: Rules, mode: str = "drop") -> DataFrame:
    """Apply ``rules``: ``drop`` keeps rows passing all of them, ``warn`` keeps every row.

    The filter is a plain conjunction, so that its parts can reach the scan.
    """
    if mode == "warn" or not rules:
        return df
    if mode != "drop":
        raise ValueError(f"unknown expectation mode {mode!r}")
    return df.filter(_all_of(rules))


def _all_of(rules: Rules) -> Column:
    return reduce(lambda left, right: left & right, map(F.expr, rules.values()), F.lit(True))


def rejected_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows that break any of ``rules``, with ``failed_rules``, the names of those they break."""
    broken = [F.when(F.coalesce(F.expr(test), F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, test in rules.items()]
    return df.filter(~F.coalesce(_all_of(rules), F.lit(False))).withColumn(
        "failed_rules", F.array_compact(F.array(*broken))
    )


def observed(df: DataFrame, rules: Rules, watch: Observation | str, dropping: Rules | None = None) -> DataFrame:
    """``df``, whose next action counts rows by the way: seen, passing each rule, and kept.

    ``kept`` rows pass the ``dropping`` rules (default: all). A batch takes an ``Observation``, a
    stream a name, under which every progress report carries the counts. A task that fails is
    not counted, but one that ended counts again if its stage runs anew after its output was
    lost with an executor: whoever stores the rows can tell by their number.
    """
    counts = {"seen": F.count(F.lit(1)), "kept": F.count_if(_all_of(rules if dropping is None else dropping))}
    counts |= {f"passed_{i}": F.count_if(F.expr(test)) for i, test in enumerate(rules.values())}
    return df.observe(watch, *(column.alias(name) for name, column in counts.items()))


def observed_lines(counts: Mapping[str, int], rules: Rules, dataset: str) -> list[tuple[str, str, int, int]]:
    """Lines of a rule report from the counts of ``observed``."""
    passed = [counts[f"passed_{i}"] for i in range(len(rules))]
    return [(dataset, name, n, counts["seen"] - n) for name, n in zip(rules, passed, strict=True)]


REPORT_LAYOUT = "dataset string, rule string, passed long, failed long"


def told(watch: Observation) -> dict[str, object] | None:
    """What a finished action left in ``watch``; None if it left nothing."""
    try:
        return watch.get
    except Py4JJavaError:
        return None


def expectation_report(df: DataFrame, rules: Rules, dataset: str) -> DataFrame:
    """Passed and failed rows per rule: ``dataset, rule, passed, failed``.

    All rules are counted in one aggregate, then turned into one row each.
    """
    names = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("seen"),
        *(F.count_if(F.expr(rules[name])).alias(f"passed_{i}") for i, name in enumerate(names)),
    )
    lines = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"passed_{i}").alias("passed"),
            (F.col("seen") - F.col(f"passed_{i}")).alias("failed"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*lines)))
