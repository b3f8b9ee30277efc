"""The registered queries: every dataset and operator, run over the given tables.

Clock columns are left out and times are wall-clock (``timestamp_ntz``), so that a result
depends on the tables only. Mean speeds are rounded here because they alone are not sums of
binary fractions, and would differ in the last digit with the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import stored_queries
from tripweave.operators.changes import snapshot_changes
from tripweave.operators.quality import QualityCheck, quality_by_table, quality_score
from tripweave.plans import gold, silver
from tripweave.config import PipelineConfig
from tripweave.plans.datasets import RULE_REPORT, Layers, rule_report, store_layers
from tripweave.plans.ingest_job import JOB_CHECK, JobLabels, clean_trips, ingest_trips
from tripweave.plans.presentation import in_reading_order, latest_days, quality_trend
from tripweave.schemas import TRIP_KEY, TRIPS, trip_schema
from tripweave.session import scratch_path
from tripweave.sinks import read_dataset, write_dataset
from tripweave.sources.lineitem_trips import load_lineitem_trips
from tripweave.sources.trip_files import csv_options, read_trips, with_ingestion_metadata
from tripweave.streaming.trip_stream import start_append, stream_trips

Query = Callable[[SparkSession, str], DataFrame]

_CLOCK = (
    "ingestion_timestamp",
    "bronze_processed_timestamp",
    "silver_processed_timestamp",
    "aggregation_timestamp",
    "metric_timestamp",
    "check_timestamp",
    "last_updated",
    "source_file",
)
_SPEED_MEANS = ("avg_speed",)


def _plain(df: DataFrame) -> DataFrame:
    """``df`` without clock columns, zoned times as wall-clock, mean speeds rounded."""
    shown = []
    for name, kind in df.dtypes:
        if name in _SPEED_MEANS:
            shown.append(F.round(name, 6).alias(name))
        elif kind == "timestamp" and name not in _CLOCK:
            shown.append(F.col(name).cast("timestamp_ntz").alias(name))
        elif name not in _CLOCK:
            shown.append(name)
    return df.select(*shown)


def _layers(spark: SparkSession, folder: str) -> Layers:
    trips = load_lineitem_trips(spark, folder)
    return Layers(with_ingestion_metadata(trips, from_files=False))


def _dataset(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return in_reading_order(_plain(_layers(spark, folder)[name]), name)

    return query


def _over_silver(report: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(report(_layers(spark, folder)["silver_taxi_trips"]))

    return query


def _shown(query: Query) -> Query:
    return lambda spark, folder: _plain(query(spark, folder))


def trips_source(spark: SparkSession, folder: str) -> DataFrame:
    return load_lineitem_trips(spark, folder)


def summary_from_daily_stats(spark: SparkSession, folder: str) -> DataFrame:
    """The summary over stored silver trips and daily statistics."""
    trips = _layers(spark, folder)["silver_taxi_trips"]
    trips = _by_date(spark, trips, "silver-trips")
    stats = _by_date(spark, silver.daily_trip_stats(trips), "daily-stats")
    return _plain(gold.executive_summary(trips, stats))


def _by_date(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    write_dataset(df, path=path, partition_by=["pickup_date"])
    return read_dataset(spark, df, path=path)


def silver_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_layers(spark, folder)["silver_data_quality"]).drop("date")


def pass_rate_trend(spark: SparkSession, folder: str) -> DataFrame:
    return quality_trend(_layers(spark, folder)["silver_data_quality"]).drop("date")


def latest_kpis_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(latest_days(_layers(spark, folder)["gold_daily_kpis"]))


def expectations(spark: SparkSession, folder: str) -> DataFrame:
    return rule_report(_layers(spark, folder))


def stored_expectations(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the rules as a stored run leaves them."""
    config = PipelineConfig(output_path=scratch_path(spark, "layers"))
    source = with_ingestion_metadata(load_lineitem_trips(spark, folder), from_files=False)
    ruled = ("bronze_taxi_raw", "bronze_taxi_enriched", "silver_taxi_trips")
    return store_layers(spark, config, source, only=ruled)[RULE_REPORT]


def job_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Trips whose times are text, some of it not a time."""
    trips = load_lineitem_trips(spark, folder)
    pickup = F.col("tpep_pickup_datetime").cast("string")
    text = trips.withColumns(
        {
            "tpep_pickup_datetime": F.when(F.col("PULocationID") == 7, F.lit("not a time"))
            .when(F.col("PULocationID") == 8, F.concat(pickup, F.lit(" PM")))
            .otherwise(pickup),
            "tpep_dropoff_datetime": F.col("tpep_dropoff_datetime").cast("string"),
        }
    )
    return _plain(clean_trips(text))


def job_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_score(load_lineitem_trips(spark, folder), JOB_CHECK)


def ingest_job(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the stand-alone job over the trips as gzip files, types inferred."""
    target = scratch_path(spark, "job")
    summary = ingest_trips(spark, _trip_csv(spark, folder), JobLabels("lineitem"), path=target)
    shown = ("status", "records_processed", "records_written", "quality_score")
    layout = "status string, records_processed long, records_written long, quality_score double"
    return spark.createDataFrame([tuple(summary[name] for name in shown)], layout)


def multi_table_quality(spark: SparkSession, folder: str) -> DataFrame:
    checks = {
        "orders": QualityCheck(("o_orderdate",), ("o_totalprice",)),
        "customer": QualityCheck(("c_custkey",), ("c_acctbal",)),
        "events": QualityCheck(("ts", "value"), ("value",)),
    }
    return quality_by_table(
        {name: (spark.read.parquet(f"{folder}/{name}.parquet"), c) for name, c in checks.items()}
    )


def _trip_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "trip-csv")
    trips = load_lineitem_trips(spark, folder)
    trips.write.options(**csv_options()).option("compression", "gzip").csv(path)
    return path


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return read_trips(spark, _trip_csv(spark, folder), trip_schema(zoned=False))


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """All trips through the file stream, two files per micro-batch."""
    schema = trip_schema(zoned=False)
    stream = stream_trips(spark, _trip_csv(spark, folder), schema, max_files_per_trigger=2)
    target, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-log")
    start_append(stream, target, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target).select(*TRIPS.names)


def partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Daily statistics written by pickup date and read back."""
    stats = _layers(spark, folder)["silver_daily_trip_stats"]
    return _plain(_by_date(spark, stats, "daily-stats"))


def changes_between_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Silver trips against themselves with some rate codes added, removed or repriced."""
    columns = [*TRIP_KEY, "VendorID", "RatecodeID", "fare_amount", "total_amount"]
    trips = _layers(spark, folder)["silver_taxi_trips"].select(*columns)
    old = trips.filter("RatecodeID <> 6")
    repriced = F.when(F.col("RatecodeID") == 5, F.col("fare_amount") + 1)
    new = trips.filter("RatecodeID <> 7").withColumn(
        "fare_amount", F.coalesce(repriced, F.col("fare_amount"))
    )
    return snapshot_changes(old, new, TRIP_KEY)


def queries() -> dict[str, Query]:
    return {
        "trips_source": trips_source,
        "bronze_raw": _dataset("bronze_taxi_raw"),
        "bronze_enriched": _dataset("bronze_taxi_enriched"),
        "bronze_quality": _dataset("bronze_data_quality_metrics"),
        "silver_trips": _dataset("silver_taxi_trips"),
        "daily_stats": _dataset("silver_daily_trip_stats"),
        "hourly_location_stats": _dataset("silver_hourly_location_stats"),
        "payment_analysis": _dataset("silver_payment_analysis"),
        "silver_quality": silver_quality,
        "daily_kpis": _dataset("gold_daily_kpis"),
        "peak_hours": _dataset("gold_peak_hours_analysis"),
        "route_performance": _dataset("gold_route_performance"),
        "route_performance_open_zones": _over_silver(gold.route_performance),
        "customer_segments": _dataset("gold_customer_segments"),
        "weekly_trends": _dataset("gold_weekly_trends"),
        "revenue_breakdown": _dataset("gold_revenue_breakdown"),
        "executive_summary": _dataset("gold_executive_summary"),
        "executive_summary_from_daily_stats": summary_from_daily_stats,
        "expectation_report": expectations,
        "expectation_report_stored": stored_expectations,
        "job_clean": job_clean,
        "job_quality": job_quality,
        "ingest_job": ingest_job,
        "multi_table_quality": multi_table_quality,
        "latest_kpis_topk": latest_kpis_topk,
        "quality_trend": pass_rate_trend,
        "stream_ingest": stream_ingest,
        "csv_roundtrip": csv_roundtrip,
        "partitioned_sink": partitioned_sink,
        "snapshot_changes": changes_between_snapshots,
    } | {name: _shown(query) for name, query in stored_queries.queries().items()}
