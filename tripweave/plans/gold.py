"""Gold datasets: reports over silver trips. Stored without order; see ``presentation``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.arithmetic import percent, percent_change, ratio
from tripweave.functions.clock import stamp
from tripweave.functions.labels import route_length, spending_segment
from tripweave.functions.measures import extend, rollup, rows
from tripweave.operators.ranking import (
    group_total,
    overall_dense_rank,
    overall_max,
    previous_row,
    rank_within,
    trailing_mean,
)
from tripweave.schemas import DAILY_KPI_COLUMNS, WEEKLY_TREND_COLUMNS

# Miles a trip is expected to cover when fully utilised.
EXPECTED_MILES_PER_TRIP = 10
FRESHNESS_HOURS = 24
MIN_ROUTE_TRIPS = 10
TREND_WEEKS = 4
RECENT_DAYS = (7, 30)
QUALITY_STATUS = "Good"


def daily_kpis(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Volume, revenue and service figures per day, compared with the day row before."""
    days = rollup(
        trips,
        ["pickup_date"],
        {
            "total_trips": rows(),
            "total_passengers": F.sum("passenger_count"),
            "total_miles": F.sum("trip_distance"),
            "total_revenue": F.sum("total_amount"),
            "total_fare_revenue": F.sum("fare_amount"),
            "total_tip_revenue": F.sum("tip_amount"),
            "avg_revenue_per_trip": F.avg("total_amount"),
            "avg_trip_duration": F.avg("trip_duration_minutes"),
            "avg_trip_distance": F.avg("trip_distance"),
            "avg_speed": F.avg("avg_speed_mph"),
            "avg_tip_percentage": F.avg("tip_percentage"),
            "avg_passengers_per_trip": F.avg("passenger_count"),
        },
    )
    return compare_days(days, as_of)


def compare_days(days: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The key figures of ``days``, a row each, with ratios and the change from the row before."""
    expected_miles = F.col("total_trips") * EXPECTED_MILES_PER_TRIP
    return extend(
        days,
        {
            "trips_change_pct": _change_from_previous("pickup_date", "total_trips"),
            "revenue_change_pct": _change_from_previous("pickup_date", "total_revenue"),
            "revenue_per_mile": ratio("total_revenue", "total_miles", 2),
            "utilization_rate": percent("total_miles", expected_miles),
            "last_updated": stamp(as_of),
            "data_freshness_hours": F.lit(FRESHNESS_HOURS),
        },
    ).select(*DAILY_KPI_COLUMNS)


def peak_hours(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Demand per hour of day, split by weekend; hours are ranked by their mean daily trips."""
    hours = rollup(
        trips,
        ["pickup_hour", "is_weekend", "time_of_day"],
        {
            "total_trips": rows(),
            "avg_fare": F.avg("fare_amount"),
            "avg_distance": F.avg("trip_distance"),
            "avg_duration": F.avg("trip_duration_minutes"),
            "avg_passengers": F.avg("passenger_count"),
            "total_revenue": F.sum("total_amount"),
            "days_observed": F.countDistinct("pickup_date"),
        },
    )
    return extend(
        hours,
        {
            "avg_trips_per_day": ratio("total_trips", "days_observed", 0),
            "avg_revenue_per_hour": ratio("total_revenue", "days_observed", 2),
        },
        {
            "demand_rank": rank_within(["is_weekend"], "avg_trips_per_day"),
            "last_updated": stamp(as_of),
        },
    )


def route_performance(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Every route with enough trips, ranked by its revenue per minute.

    Location ids may come from an open domain: no task ranks all routes. Calling this stores
    the aggregated routes, once, for the ranking.
    """
    ranked = overall_dense_rank(rated_routes(trips), "revenue_per_minute", "profitability_rank")
    return extend(
        ranked, {"route_type": route_length("avg_distance"), "last_updated": stamp(as_of)}
    )


def rated_routes(trips: DataFrame) -> DataFrame:
    """Revenue per mile and minute of every route with enough trips."""
    routes = rollup(
        trips,
        ["PULocationID", "DOLocationID"],
        {
            "trip_count": rows(),
            "avg_distance": F.avg("trip_distance"),
            "avg_duration": F.avg("trip_duration_minutes"),
            "avg_fare": F.avg("fare_amount"),
            "avg_tip": F.avg("tip_amount"),
            "avg_total_revenue": F.avg("total_amount"),
            "total_revenue": F.sum("total_amount"),
            "avg_speed": F.avg("avg_speed_mph"),
        },
    ).filter(F.col("trip_count") >= MIN_ROUTE_TRIPS)

    def revenue_per(mean: str) -> Column:
        return ratio("total_revenue", F.col(mean) * F.col("trip_count"), 2)

    return extend(
        routes,
        {
            "revenue_per_mile": revenue_per("avg_distance"),
            "revenue_per_minute": revenue_per("avg_duration"),
        },
    )


def customer_segments(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Spending per payment label, time of day and weekend, with revenue share and segment."""
    groups = rollup(
        trips,
        ["payment_type_name", "time_of_day", "is_weekend"],
        {
            "trip_count": rows(),
            "avg_distance": F.avg("trip_distance"),
            "avg_spend": F.avg("total_amount"),
            "avg_tip_pct": F.avg("tip_percentage"),
            "total_revenue": F.sum("total_amount"),
            "avg_passengers": F.avg("passenger_count"),
        },
    )
    return extend(
        groups,
        {
            "revenue_contribution_pct": percent("total_revenue", group_total([], "total_revenue")),
            "customer_segment": spending_segment("avg_spend", "avg_tip_pct", "trip_count"),
            "last_updated": stamp(as_of),
        },
    )


def weekly_trends(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Figures per Monday week, change from the week row before and four-row means."""
    weeks = rollup(
        trips.withColumn("week_start", F.date_trunc("week", "pickup_date")),
        ["week_start"],
        {
            "total_trips": rows(),
            "total_revenue": F.sum("total_amount"),
            "avg_revenue_per_trip": F.avg("total_amount"),
            "total_miles": F.sum("trip_distance"),
            "avg_miles_per_trip": F.avg("trip_distance"),
            "avg_tip_pct": F.avg("tip_percentage"),
            "active_days": F.countDistinct("pickup_date"),
        },
    )

    def recent_mean(value: str, digits: int) -> Column:
        return F.round(trailing_mean("week_start", value, TREND_WEEKS), digits)

    return extend(
        weeks,
        {
            "trips_wow_change_pct": _change_from_previous("week_start", "total_trips"),
            "revenue_wow_change_pct": _change_from_previous("week_start", "total_revenue"),
            "trips_4week_avg": recent_mean("total_trips", 0),
            "revenue_4week_avg": recent_mean("total_revenue", 2),
            "last_updated": stamp(as_of),
        },
    ).select(*WEEKLY_TREND_COLUMNS)


def revenue_breakdown(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Revenue by component per day, time of day and payment label, with mix percentages."""
    parts = {
        "base_fare_revenue": "fare_amount",
        "extra_charges_revenue": "extra",
        "mta_tax_revenue": "mta_tax",
        "tip_revenue": "tip_amount",
        "tolls_revenue": "tolls_amount",
        "surcharge_revenue": "improvement_surcharge",
        "total_revenue": "total_amount",
    }
    groups = rollup(
        trips,
        ["pickup_date", "time_of_day", "payment_type_name"],
        {name: F.sum(column) for name, column in parts.items()}
        | {"trip_count": rows(), "total_miles": F.sum("trip_distance")},
    )
    return extend(
        groups,
        {
            "base_fare_pct": percent("base_fare_revenue", "total_revenue"),
            "tip_pct": percent("tip_revenue", "total_revenue"),
            "avg_revenue_per_trip": ratio("total_revenue", "trip_count", 2),
            "avg_revenue_per_mile": ratio("total_revenue", "total_miles", 2),
            "last_updated": stamp(as_of),
        },
    )


def executive_summary(
    trips: DataFrame, daily_stats: DataFrame | None = None, as_of: datetime | None = None
) -> DataFrame:
    """One row: the latest day against the mean day of the 7 and 30 days before and itself.

    With stored ``daily_stats`` only the latest day's trips and the recent days' statistics
    are read: the latest date, taken from the statistics, prunes date partitions of both.
    Without them one pass over ``trips`` gives all figures per day first.
    """
    if daily_stats is None:
        summary = _summary_from_days(trips)
    else:
        summary = _summary_from_latest(trips, daily_stats)
    return extend(
        summary,
        {
            "trips_vs_7d_avg_pct": percent_change("trips_today", "avg_trips_7d"),
            "revenue_vs_7d_avg_pct": percent_change("revenue_today", "avg_revenue_7d"),
            "last_updated": stamp(as_of),
            "data_quality_status": F.lit(QUALITY_STATUS),
        },
    )


def _summary_from_latest(trips: DataFrame, daily_stats: DataFrame) -> DataFrame:
    latest = daily_stats.select(F.max("pickup_date")).scalar()
    today = trips.filter(F.col("pickup_date") == latest).agg(
        F.max("pickup_date").alias("report_date"),
        rows().alias("trips_today"),
        F.sum("total_amount").alias("revenue_today"),
        F.avg("total_amount").alias("avg_revenue_per_trip_today"),
    )
    recent = daily_stats.filter(F.col("pickup_date") >= F.date_sub(latest, max(RECENT_DAYS)))
    means = recent.withColumn("latest_date", latest).agg(*_recent_means())
    return today.crossJoin(F.broadcast(means))


def _summary_from_days(trips: DataFrame) -> DataFrame:
    days = rollup(
        trips,
        ["pickup_date"],
        {
            "total_trips": rows(),
            "total_revenue": F.sum("total_amount"),
            "mean_revenue": F.avg("total_amount"),
        },
    )
    # The window's input is one row per calendar day.
    dated = extend(days, {"latest_date": overall_max("pickup_date")})
    is_latest = F.col("pickup_date") == F.col("latest_date")

    def on_latest(value: str) -> Column:
        return F.max(F.when(is_latest, F.col(value)))

    return dated.agg(
        F.max("pickup_date").alias("report_date"),
        F.coalesce(on_latest("total_trips"), F.lit(0)).alias("trips_today"),
        on_latest("total_revenue").alias("revenue_today"),
        on_latest("mean_revenue").alias("avg_revenue_per_trip_today"),
        *_recent_means(),
    )


def _recent_means() -> list[Column]:
    """Means over the dates from ``days`` before the latest on: ``days + 1`` calendar days."""
    return [
        F.avg(
            F.when(
                F.col("pickup_date") >= F.date_sub("latest_date", days), F.col(f"total_{what}")
            )
        ).alias(f"avg_{what}_{days}d")
        for days in RECENT_DAYS
        for what in ("trips", "revenue")
    ]


def _change_from_previous(order: str, value: str) -> Column:
    return percent_change(value, previous_row(order, value))
