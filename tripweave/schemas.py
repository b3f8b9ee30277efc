"""Record layouts and column contracts shared by sources, transforms and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# The two source layouts, in file order.
_TRIP_FIELDS = (
    ("VendorID", "integer"),
    ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "integer"),
    ("trip_distance", "double"),
    ("RatecodeID", "integer"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "integer"),
    ("DOLocationID", "integer"),
    ("payment_type", "integer"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
)
_GEO_TRIP_FIELDS = (
    ("VendorID", "string"),
    ("tpep_pickup_datetime", "string"),
    ("tpep_dropoff_datetime", "string"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("pickup_longitude", "double"),
    ("pickup_latitude", "double"),
    ("RatecodeID", "string"),
    ("store_and_fwd_flag", "string"),
    ("dropoff_longitude", "double"),
    ("dropoff_latitude", "double"),
    ("payment_type", "string"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("total_amount", "double"),
)

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _layout(fields: tuple[tuple[str, str], ...], times: str = "timestamp") -> T.StructType:
    layout = T.StructType()
    for name, kind in fields:
        layout.add(name, times if kind == "timestamp" else kind, nullable=True)
    return layout


def trip_schema(zoned: bool = True) -> T.StructType:
    """The 17-field trip layout; ``zoned=False`` reads wall-clock times as ``timestamp_ntz``."""
    return _layout(_TRIP_FIELDS, "timestamp" if zoned else "timestamp_ntz")


TRIPS = trip_schema()
# Times as they stand in the file: a text that is no time is kept.
TRIPS_TEXT = _layout(_TRIP_FIELDS, "string")
TRIPS_GEO = _layout(_GEO_TRIP_FIELDS)

# Trips carry no identifier: these five columns together identify one.
TRIP_KEY = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
)

# Order in which records sharing a key are compared; the smallest survives, NULLs last.
TRIP_TIE_BREAK = (
    "total_amount",
    "fare_amount",
    "trip_distance",
    "VendorID",
    "RatecodeID",
    "payment_type",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "store_and_fwd_flag",
)
LINEAGE_TIE_BREAK = ("source_file", "ingestion_timestamp")

# The dataset's columns, in order.
SILVER_TRIP_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pickup_date",
    "pickup_hour",
    "pickup_day_of_week",
    "is_weekend",
    "time_of_day",
    "passenger_count",
    "trip_distance",
    "trip_duration_minutes",
    "avg_speed_mph",
    "PULocationID",
    "DOLocationID",
    "RatecodeID",
    "rate_code_name",
    "payment_type",
    "payment_type_name",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tip_percentage",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "fare_per_mile",
    "ingestion_timestamp",
    "silver_processed_timestamp",
)

# The dataset's columns, in order.
DAILY_KPI_COLUMNS = (
    "pickup_date",
    "total_trips",
    "trips_change_pct",
    "total_passengers",
    "total_miles",
    "total_revenue",
    "revenue_change_pct",
    "total_fare_revenue",
    "total_tip_revenue",
    "avg_revenue_per_trip",
    "revenue_per_mile",
    "avg_trip_duration",
    "avg_trip_distance",
    "avg_speed",
    "avg_tip_percentage",
    "avg_passengers_per_trip",
    "utilization_rate",
    "last_updated",
    "data_freshness_hours",
)

# The dataset's columns, in order.
WEEKLY_TREND_COLUMNS = (
    "week_start",
    "total_trips",
    "trips_wow_change_pct",
    "trips_4week_avg",
    "total_revenue",
    "revenue_wow_change_pct",
    "revenue_4week_avg",
    "avg_revenue_per_trip",
    "total_miles",
    "avg_miles_per_trip",
    "avg_tip_pct",
    "active_days",
    "last_updated",
)
