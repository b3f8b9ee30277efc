"""Daily figures kept up to date from changes instead of being rebuilt.

``daily_totals`` holds a row per date from which daily statistics and key figures follow: sums,
counts, extremes and the vendors seen. Changes of silver trips are added to and subtracted from
the sums and counts of their dates. Extremes and vendors can only be extended by new rows; for
dates that lost rows, and for no others, they are read from the trips again.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.arithmetic import percent, ratio
from tripweave.functions.clock import stamp
from tripweave.functions.measures import extend, rollup
from tripweave.operators.changes import ADDED
from tripweave.plans.gold import compare_days
from tripweave.plans.silver import CASH, CREDIT_CARD

DAY = "pickup_date"
_SUMMED = (
    "trip_distance", "trip_duration_minutes", "fare_amount", "tip_amount", "tip_percentage",
    "total_amount", "passenger_count", "avg_speed_mph",
)
_EXTREMES = ("trip_distance", "trip_duration_minutes")
VENDORS = "vendors"
# Sums are kept in decimals: adding and subtracting the same value leaves nothing behind.
_VALUE, _PART = "decimal(30,15)", "decimal(37,15)"
# Columns of silver trips that totals depend on.
MEASURED = (DAY, "VendorID", "payment_type", "is_weekend", *_SUMMED)


def _counted() -> dict[str, Column]:
    """What every row adds to the counts of its date: 0 or 1."""
    tests = {
        "trips": F.lit(True),
        "credit_card_trips": F.col("payment_type") == CREDIT_CARD,
        "cash_trips": F.col("payment_type") == CASH,
        "weekend_trips": F.col("is_weekend"),
    }
    tests |= {f"n_{name}": _exact(name, F.lit(1)).isNotNull() for name in _SUMMED}
    return {name: F.when(test, 1).otherwise(0) for name, test in tests.items()}


def _exact(name: str, weight: Column) -> Column:
    return (F.col(name).cast("double") * weight).try_cast(_VALUE)


def _sums(weight: Column) -> dict[str, Column]:
    """Sums and counts of rows taken ``weight`` times; a sum of nulls is no sum."""
    found = {name: F.coalesce(F.sum(one * weight), F.lit(0)).cast("long") for name, one in _counted().items()}
    return found | {f"sum_{name}": F.sum(_exact(name, weight)) for name in _SUMMED}


def _extended(some: Column) -> dict[str, Column]:
    """Extremes and vendors of the rows for which ``some`` holds."""
    found = {f"min_{name}": F.min(F.when(some, F.col(name))) for name in _EXTREMES}
    found |= {f"max_{name}": F.max(F.when(some, F.col(name))) for name in _EXTREMES}
    return found | {VENDORS: F.array_sort(F.collect_set(F.when(some, F.col("VendorID"))))}


def daily_totals(trips: DataFrame) -> DataFrame:
    """Totals per date of silver ``trips``; the vendors of a date are few.

    Sums hold 15 decimal places. What is no finite number is neither summed nor counted.
    """
    return rollup(trips, [DAY], _sums(F.lit(1)) | _extended(F.lit(True)))


def changed_totals(totals: DataFrame, changes: DataFrame, trips: DataFrame) -> tuple[DataFrame, list[date]]:
    """The new totals of the dates that ``changes`` touch, and these dates.

    ``changes`` is what ``snapshot_changes`` tells between the trips that ``totals`` describe and
    ``trips``, with the columns ``MEASURED``; a row counts as often as its ``_row_count`` says. A
    date without trips has no row any more. Dates are collected by the driver: they are bounded
    by the calendar, and prune the partitions of ``trips`` and ``totals`` that are read.
    The result is that of a rebuild.
    """
    added = F.col("_change_type").isin(*ADDED)
    weight = F.when(added, F.col("_row_count")).otherwise(-F.col("_row_count"))
    deltas = rollup(changes, [DAY], _sums(weight) | _extended(added) | {"removals": F.count_if(~added)})
    touched = {row[DAY]: row.removals for row in deltas.select(DAY, "removals").collect()}
    dates = sorted(touched)
    shrunk = [day for day in dates if touched[day]]

    reread = rollup(trips.filter(F.col(DAY).isin(shrunk)), [DAY], _extended(F.lit(True)))
    before = totals.filter(F.col(DAY).isin(dates))
    additive = [*_counted(), *(f"sum_{name}" for name in _SUMMED)]
    open_ended = list(_extended(F.lit(True)))
    both = (
        before.select(DAY, *(F.col(n).alias(f"_{n}") for n in (*additive, *open_ended)))
        .join(deltas, DAY, "full_outer")
        .join(reread.select(DAY, *(F.col(n).alias(f"_again_{n}") for n in open_ended)), DAY, "left")
    )

    def summed(name: str) -> Column:
        kind = _PART if name.startswith("sum_") else "long"
        before, delta = (F.coalesce(F.col(part).cast(kind), F.lit(0).cast(kind)) for part in (f"_{name}", name))
        total = before + delta
        if not name.startswith("sum_"):
            return total
        return F.when(summed(f"n_{name.removeprefix('sum_')}") > 0, total)

    def grown(name: str) -> Column:
        if name == VENDORS:
            none = F.array().cast("array<int>")
            return F.array_sort(F.array_union(F.coalesce(f"_{name}", none), F.coalesce(name, none)))
        return (F.least if name.startswith("min_") else F.greatest)(F.col(f"_{name}"), F.col(name))

    now = {name: summed(name) for name in additive}
    now |= {name: F.when(F.col("removals") > 0, F.col(f"_again_{name}")).otherwise(grown(name)) for name in open_ended}
    fresh = both.select(DAY, *(column.alias(name) for name, column in now.items()))
    return fresh.filter(F.col("trips") > 0).select(*totals.columns), dates


def _total(name: str, kind: str = "double") -> Column:
    return F.col(f"sum_{name}").cast(kind)


def _mean(name: str) -> Column:
    return ratio(_total(name), f"n_{name}")


def stats_of(totals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The daily trip statistics that ``totals`` stand for, in their columns and order."""
    days = totals.select(
        DAY,
        F.col("trips").alias("total_trips"),
        F.size(VENDORS).cast("long").alias("unique_vendors"),
        _mean("trip_distance").alias("avg_trip_distance"),
        _total("trip_distance").alias("total_trip_distance"),
        "min_trip_distance",
        "max_trip_distance",
        _mean("trip_duration_minutes").alias("avg_trip_duration"),
        F.col("min_trip_duration_minutes").alias("min_trip_duration"),
        F.col("max_trip_duration_minutes").alias("max_trip_duration"),
        _mean("fare_amount").alias("avg_fare_amount"),
        _total("fare_amount").alias("total_fare_amount"),
        _mean("tip_amount").alias("avg_tip_amount"),
        _mean("tip_percentage").alias("avg_tip_percentage"),
        _total("total_amount").alias("total_revenue"),
        _mean("passenger_count").alias("avg_passengers"),
        _total("passenger_count", "long").alias("total_passengers"),
        _mean("avg_speed_mph").alias("avg_speed"),
        "credit_card_trips",
        "cash_trips",
        "weekend_trips",
        stamp(as_of).alias("aggregation_timestamp"),
    )
    return extend(
        days,
        {
            "avg_fare_per_mile": ratio("total_fare_amount", "total_trip_distance", 2),
            "credit_card_percentage": percent("credit_card_trips", "total_trips"),
        },
    )


def kpis_of(totals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The daily key figures that ``totals`` stand for: one row a date is compared with the next."""
    days = totals.select(
        DAY,
        F.col("trips").alias("total_trips"),
        _total("passenger_count", "long").alias("total_passengers"),
        _total("trip_distance").alias("total_miles"),
        _total("total_amount").alias("total_revenue"),
        _total("fare_amount").alias("total_fare_revenue"),
        _total("tip_amount").alias("total_tip_revenue"),
        _mean("total_amount").alias("avg_revenue_per_trip"),
        _mean("trip_duration_minutes").alias("avg_trip_duration"),
        _mean("trip_distance").alias("avg_trip_distance"),
        _mean("avg_speed_mph").alias("avg_speed"),
        _mean("tip_percentage").alias("avg_tip_percentage"),
        _mean("passenger_count").alias("avg_passengers_per_trip"),
    )
    return compare_days(days, as_of)
