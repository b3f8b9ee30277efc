"""Bronze datasets: trips as ingested, with derived columns and daily quality figures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.arithmetic import ratio
from tripweave.functions.clock import minutes_between, stamp
from tripweave.functions.labels import holds
from tripweave.functions.measures import extend, rollup, rows
from tripweave.operators.rules import RAW_RULES, apply_expectations

# Above any of these a trip is suspicious.
MAX_MILES = 100
MAX_MINUTES = 180
MAX_MPH = 100
MAX_PASSENGERS = 6


def raw_trips(ingested: DataFrame) -> DataFrame:
    """Ingested trips that have a vendor and both times."""
    return apply_expectations(ingested, RAW_RULES)


def enrich_trips(raw: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Add duration, speed, calendar parts of the pickup and the suspicious flag."""
    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    minutes = F.col("trip_duration_minutes")
    speed = F.when(minutes > 0, ratio("trip_distance", minutes / 60)).otherwise(F.lit(0.0))
    suspicious = (
        (F.col("trip_distance") > MAX_MILES)
        | (minutes > MAX_MINUTES)
        | (F.col("avg_speed_mph") > MAX_MPH)
        | (F.col("passenger_count") > MAX_PASSENGERS)
    )
    return extend(
        raw,
        {"trip_duration_minutes": minutes_between(raw, pickup, dropoff)},
        {
            "avg_speed_mph": speed,
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup),
            "pickup_day_of_week": F.dayofweek(pickup),
        },
        {"is_suspicious": holds(suspicious), "bronze_processed_timestamp": stamp(as_of)},
    )


def daily_quality(enriched: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Records, suspicious records, means and pickup range per day, with a score."""
    days = rollup(
        enriched,
        ["pickup_date"],
        {
            "total_records": rows(),
            "suspicious_records": F.count_if("is_suspicious"),
            "avg_trip_distance": F.avg("trip_distance"),
            "avg_trip_duration": F.avg("trip_duration_minutes"),
            "avg_fare_amount": F.avg("fare_amount"),
            "earliest_pickup": F.min("tpep_pickup_datetime"),
            "latest_pickup": F.max("tpep_pickup_datetime"),
            "metric_timestamp": stamp(as_of),
        },
    )
    clean_share = 1 - ratio("suspicious_records", "total_records")
    return extend(days, {"data_quality_score": F.round(clean_share * 100, 2)})
