"""Silver datasets: validated trips and the summaries close to them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.arithmetic import percent, ratio
from tripweave.functions.clock import stamp
from tripweave.functions.labels import (
    PAYMENT_LABELS,
    RATE_LABELS,
    WEEKEND_DAYS,
    code_label,
    day_part,
    holds,
)
from tripweave.functions.measures import extend, rollup, rows
from tripweave.operators.dedupe import keep_first
from tripweave.operators.ranking import group_total, rank_within
from tripweave.operators.rules import SILVER_RULES, apply_expectations
from tripweave.schemas import LINEAGE_TIE_BREAK, SILVER_TRIP_COLUMNS, TRIP_KEY, TRIP_TIE_BREAK

CREDIT_CARD, CASH = 1, 2


def refine_trips(enriched: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Unsuspicious trips without duplicates, labelled, before the drop rules.

    Labels and ratios are added after the deduplication, so that its shuffle stays narrow.
    """
    unique = keep_first(enriched.filter(~F.col("is_suspicious")), TRIP_KEY, tie_break(enriched))
    return label_trips(unique, as_of)


def tie_break(trips: DataFrame) -> list[str]:
    """The order in which records sharing a key are compared."""
    return [*TRIP_TIE_BREAK, *(name for name in LINEAGE_TIE_BREAK if name in trips.columns)]


def label_trips(unique: DataFrame, as_of: datetime | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The silver columns of unique trips, and the columns ``keep`` as they are."""
    derived = {
        "payment_type_name": code_label("payment_type", PAYMENT_LABELS),
        "rate_code_name": code_label("RatecodeID", RATE_LABELS),
        "fare_per_mile": ratio("fare_amount", "trip_distance", 2),
        "tip_percentage": percent("tip_amount", "fare_amount"),
        "is_weekend": holds(F.col("pickup_day_of_week").isin(*WEEKEND_DAYS)),
        "time_of_day": day_part("pickup_hour"),
        "silver_processed_timestamp": stamp(as_of),
    }
    return unique.select(
        *(derived[n].alias(n) if n in derived else n for n in SILVER_TRIP_COLUMNS), *keep
    )


def silver_trips(enriched: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Refined trips that pass every drop rule.

    The rules come last on purpose: a duplicate that survives and then fails them is gone.
    """
    return apply_expectations(refine_trips(enriched, as_of), SILVER_RULES)


def daily_trip_stats(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Trips, distances, durations, fares, passengers and payment mix per day."""
    days = rollup(
        trips,
        ["pickup_date"],
        {
            "total_trips": rows(),
            "unique_vendors": F.countDistinct("VendorID"),
            "avg_trip_distance": F.avg("trip_distance"),
            "total_trip_distance": F.sum("trip_distance"),
            "min_trip_distance": F.min("trip_distance"),
            "max_trip_distance": F.max("trip_distance"),
            "avg_trip_duration": F.avg("trip_duration_minutes"),
            "min_trip_duration": F.min("trip_duration_minutes"),
            "max_trip_duration": F.max("trip_duration_minutes"),
            "avg_fare_amount": F.avg("fare_amount"),
            "total_fare_amount": F.sum("fare_amount"),
            "avg_tip_amount": F.avg("tip_amount"),
            "avg_tip_percentage": F.avg("tip_percentage"),
            "total_revenue": F.sum("total_amount"),
            "avg_passengers": F.avg("passenger_count"),
            "total_passengers": F.sum("passenger_count"),
            "avg_speed": F.avg("avg_speed_mph"),
            "credit_card_trips": F.count_if(F.col("payment_type") == CREDIT_CARD),
            "cash_trips": F.count_if(F.col("payment_type") == CASH),
            "weekend_trips": F.count_if("is_weekend"),
            "aggregation_timestamp": stamp(as_of),
        },
    )
    return extend(
        days,
        {
            "avg_fare_per_mile": ratio("total_fare_amount", "total_trip_distance", 2),
            "credit_card_percentage": percent("credit_card_trips", "total_trips"),
        },
    )


def hourly_location_stats(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Demand per day, hour and pickup zone; zones are ranked by trips within their hour."""
    hour = ["pickup_date", "pickup_hour"]
    zones = rollup(
        trips,
        [*hour, "PULocationID"],
        {
            "trip_count": rows(),
            "avg_distance": F.avg("trip_distance"),
            "avg_duration": F.avg("trip_duration_minutes"),
            "avg_fare": F.avg("fare_amount"),
            "avg_passengers": F.avg("passenger_count"),
            "unique_destinations": F.countDistinct("DOLocationID"),
            "aggregation_timestamp": stamp(as_of),
        },
    )
    return extend(zones, {"trips_rank": rank_within(hour, "trip_count")})


def payment_analysis(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Tips and fares per day, payment label and time of day, with the share of the day's revenue."""
    groups = rollup(
        trips,
        ["pickup_date", "payment_type_name", "time_of_day"],
        {
            "trip_count": rows(),
            "avg_tip_amount": F.avg("tip_amount"),
            "avg_tip_percentage": F.avg("tip_percentage"),
            "avg_fare_amount": F.avg("fare_amount"),
            "avg_total_amount": F.avg("total_amount"),
            "total_revenue": F.sum("total_amount"),
            "aggregation_timestamp": stamp(as_of),
        },
    )
    day_revenue = group_total(["pickup_date"], "total_revenue")
    return extend(groups, {"revenue_percentage": percent("total_revenue", day_revenue)})


def layer_pass_rate(
    enriched: DataFrame, trips: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """One row: records before and after cleaning, pass rate (0 without input) and drops."""
    before = enriched.agg(rows().alias("bronze_records"))
    after = trips.agg(rows().alias("silver_records"))
    passed = percent("silver_records", "bronze_records")
    return before.crossJoin(F.broadcast(after)).select(
        stamp(as_of).cast("date").alias("date"),
        "bronze_records",
        "silver_records",
        F.coalesce(passed, F.lit(0.0)).alias("pass_rate_percentage"),
        (F.col("bronze_records") - F.col("silver_records")).alias("records_dropped"),
        stamp(as_of).alias("check_timestamp"),
    )
