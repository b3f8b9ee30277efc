"""Registered queries that store, stream or bring up to date, over the given tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.config import PipelineConfig
from tripweave.operators.changes import snapshot_changes
from tripweave.operators.rules import RAW_RULES, observed
from tripweave.plans.daily_totals import DAY, MEASURED, changed_totals, daily_totals, kpis_of, stats_of
from tripweave.plans.datasets import DATASETS, RULE_REPORT, Layers, store_layers
from tripweave.plans.ingest_job import JobLabels, clean_trips, ingest_trips, with_job_metadata
from tripweave.schemas import TRIP_KEY, TRIPS, TRIPS_GEO, trip_schema
from tripweave.session import scratch_path
from tripweave.sinks import read_dataset, write_dataset, write_partitions
from tripweave.sources.lineitem_trips import load_lineitem_trips
from tripweave.sources.trip_files import csv_options, with_ingestion_metadata
from tripweave.streaming.trip_layers import PERIOD, StreamedLayers, stream_source
from tripweave.streaming.trip_stream import REPORTS_KEPT, Intake, start_append, stream_trips, streamed_rule_report

_WALL_CLOCK = trip_schema(zoned=False)


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    trips = load_lineitem_trips(spark, folder)
    return Layers(with_ingestion_metadata(trips, from_files=False))["silver_taxi_trips"]


# Line items whose trips make a file of a streamed folder, at most: one task writes it.
LINES_IN_FILE = 3_000_000


def _files(spark: SparkSession, folder: str, least: int) -> int:
    """In how many files the trips of ``folder`` are written, ``least`` or as many as they fill."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()  # from the footers alone
    return max(least, -(-lines // LINES_IN_FILE))


def _csv(spark: SparkSession, rows: DataFrame, path: str | None = None, compression: str = "none") -> str:
    path = path or scratch_path(spark, "trip-csv")
    rows.write.mode("append").options(**csv_options(), compression=compression).csv(path)
    return path


def _damaged_lines(spark: SparkSession, folder: str) -> str:
    """Trip files in which the lines of four pickup zones do not fit the layout."""
    trips = load_lineitem_trips(spark, folder)
    text = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in trips.columns}
    zone, pickup = F.col("PULocationID"), "tpep_pickup_datetime"
    text[pickup] = F.when((zone == 7) & F.col(pickup).isNotNull(), "not a time").otherwise(text[pickup])
    text["passenger_count"] = F.when(zone == 10, "two").otherwise(text["passenger_count"])
    whole = F.concat_ws(",", *text.values())
    line = (
        F.when(zone == 8, F.concat(whole, F.lit(",surplus")))
        .when(zone == 9, F.concat_ws(",", *list(text.values())[:5]))
        .otherwise(whole)
    )
    path = scratch_path(spark, "damaged-csv")
    # A single column without quotes: its name is the header line.
    rows = trips.select(line.alias(",".join(trips.columns)))
    rows.write.options(header="true", sep="\u0001", quote="").csv(path)
    return path


def _stored_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    config = PipelineConfig(source_path=_damaged_lines(spark, folder), output_path=scratch_path(spark, "layers"))
    return store_layers(spark, config, only=("bronze_taxi_raw",))


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines that do not fit or break a raw rule, as a stored run keeps them."""
    rejected = _stored_raw(spark, folder)["bronze_taxi_rejected"]
    times = [name for name, kind in rejected.dtypes if kind == "timestamp"]
    return rejected.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times}).select(
        *TRIPS.names, "raw_line", F.array_join("failed_rules", ",").alias("failed_rules"), "kept"
    )


def damaged_lines_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts of the write of the same lines."""
    return _stored_raw(spark, folder)[RULE_REPORT]


def _totals_after_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of silver trips, stored, after some rate codes were added, removed or repriced."""
    trips = _silver(spark, folder).select(*dict.fromkeys((*TRIP_KEY, *MEASURED, "RatecodeID")))
    trips = _written(spark, trips, "silver")
    old = trips.filter("RatecodeID <> 6")
    repriced = F.when(F.col("RatecodeID") == 5, F.col("fare_amount") + 1).otherwise(F.col("fare_amount"))
    new = trips.filter("RatecodeID <> 7").withColumn("fare_amount", repriced)
    totals = _written(spark, daily_totals(old), "totals")
    fresh, dates = changed_totals(totals, snapshot_changes(old, new, TRIP_KEY), new)
    return totals.filter(~F.col(DAY).isin(dates)).unionByName(fresh)


def _written(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def daily_stats_from_changes(spark: SparkSession, folder: str) -> DataFrame:
    return stats_of(_totals_after_changes(spark, folder))


def daily_kpis_from_changes(spark: SparkSession, folder: str) -> DataFrame:
    return kpis_of(_totals_after_changes(spark, folder))


def streamed_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver trips of a stream that stops and goes on when more files have come."""
    layers = StreamedLayers(spark, scratch_path(spark, "streamed"), period="month")
    checkpoint, path = scratch_path(spark, "stream-log"), None
    # Pickup zones 1 to 8 and those from 9 on, as the fixture derives them from the supplier.
    for lot in ("l_suppkey % 20 + 1 < 9", "l_suppkey % 20 + 1 >= 9"):
        path = _csv(spark, load_lineitem_trips(spark, folder, lot), path, "gzip")
        layers.start(stream_source(spark, path, _WALL_CLOCK), checkpoint).awaitTermination()
    return layers.silver().drop(PERIOD)


def stream_expectations(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rule counts from the progress reports of a stream."""
    files = _files(spark, folder, 6)
    path = _csv(spark, load_lineitem_trips(spark, folder).repartition(files))
    stream = observed(stream_trips(spark, path, _WALL_CLOCK, max_files_per_trigger=2), RAW_RULES, "rules")
    kept = spark.conf.get(REPORTS_KEPT)
    # The session is to keep the report of every batch; one takes a file at least.
    spark.conf.set(REPORTS_KEPT, str(max(int(kept), files + 1)))
    try:
        query = start_append(stream, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-log"))
        query.awaitTermination()
    finally:
        spark.conf.set(REPORTS_KEPT, kept)
    return streamed_rule_report(spark, query, "rules", RAW_RULES, "bronze_taxi_raw")


def _streamed(spark: SparkSession, path: str, intake: Intake, every: str | None) -> DataFrame:
    stream = stream_trips(spark, path, _WALL_CLOCK, intake=intake)
    target = scratch_path(spark, "stream-out")
    query = start_append(stream, target, scratch_path(spark, "stream-log"), every=every)
    try:
        query.processAllAvailable() if every else query.awaitTermination()
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(target).select(*TRIPS.names)


def stream_on_an_interval(spark: SparkSession, folder: str) -> DataFrame:
    """All trips by a stream that looks for files every second, until none is left."""
    path = _csv(spark, load_lineitem_trips(spark, folder).repartition(_files(spark, folder, 4)))
    return _streamed(spark, path, Intake(max_files=3), "1 second")


def stream_with_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All trips by a stream of bounded batches that moves the files it has read."""
    path = _csv(spark, load_lineitem_trips(spark, folder).repartition(_files(spark, folder, 4)))
    return _streamed(spark, path, Intake(max_bytes=1 << 20, archive_to=scratch_path(spark, "archive")), None)


def touched_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Silver trips stored by month; then the months of one year anew, and one of them emptied."""
    month = F.date_trunc("month", "pickup_date").cast("date").alias("month")
    trips = _silver(spark, folder).select("pickup_date", "PULocationID", "fare_amount", "total_amount", month)
    path = scratch_path(spark, "by-month")
    write_dataset(trips, path=path, partition_by=["month"])
    stored = read_dataset(spark, trips, path=path)
    year = stored.filter("month >= DATE'1997-01-01' AND month < DATE'1998-01-01'")
    months = [row[0] for row in year.select("month").distinct().collect()]
    doubled = year.filter("month <> DATE'1997-05-01'").withColumn("fare_amount", F.col("fare_amount") * 2)
    write_partitions(_written(spark, doubled, "renewed"), "month", months, path=path)
    return read_dataset(spark, trips, path=path).drop("month")


def described_table(spark: SparkSession, folder: str) -> DataFrame:
    """Customer segments as a table, with what the catalog tells about it on every row."""
    trips = load_lineitem_trips(spark, folder)
    layers = Layers(with_ingestion_metadata(trips, from_files=False))
    (spec,) = (spec for spec in DATASETS if spec.name == "gold_customer_segments")
    spark.sql("CREATE SCHEMA IF NOT EXISTS tripweave_described")
    table = f"spark_catalog.tripweave_described.segments_{uuid.uuid4().hex}"
    write_dataset(layers[spec.name], table=table, comment=spec.comment, properties=spec.properties)
    told = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    detail = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    shown = {name: F.lit(told.get(name)).alias(name) for name in ("quality", "business_owner")}
    return spark.table(table).select("*", *shown.values(), F.lit(detail.get("Comment")).alias("comment"))


def job_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Constant columns of the ingestion job beside the identifying ones of each trip."""
    labelled = with_job_metadata(
        clean_trips(load_lineitem_trips(spark, folder)), JobLabels("lineitem"), datetime(2022, 2, 2, 2, 2, 2)
    )
    shown = ("data_source", "pipeline_stage", "data_classification", "business_domain", "ingestion_job", "processing_date")
    return labelled.select("PULocationID", "DOLocationID", "total_amount", *shown)


def geo_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with coordinates through the ingestion job, times and codes as text."""
    trips = load_lineitem_trips(spark, folder)
    made = {
        "pickup_longitude": F.col("PULocationID") / 4 - 74,
        "pickup_latitude": F.col("PULocationID") / 8 + 40,
        "dropoff_longitude": F.col("DOLocationID") / 4 - 74,
        "dropoff_latitude": F.col("DOLocationID") / 8 + 40,
    }
    rows = trips.select(*(made.get(f.name, F.col(f.name) if f.name in trips.columns else None).cast(f.dataType).alias(f.name) for f in TRIPS_GEO))
    target = scratch_path(spark, "geo")
    ingest_trips(spark, _csv(spark, rows), JobLabels("lineitem"), path=target, schema=TRIPS_GEO)
    stored = spark.read.parquet(target)
    pickup = F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime")
    return stored.select(*TRIPS_GEO.names, pickup, "passenger_count_clean", "data_quality_flag")


def queries() -> dict:
    return {
        "rejected_lines": rejected_lines,
        "damaged_lines_report": damaged_lines_report,
        "daily_stats_from_changes": daily_stats_from_changes,
        "daily_kpis_from_changes": daily_kpis_from_changes,
        "streamed_silver": streamed_silver,
        "stream_expectations": stream_expectations,
        "stream_on_an_interval": stream_on_an_interval,
        "stream_with_archive": stream_with_archive,
        "touched_dates": touched_dates,
        "described_table": described_table,
        "job_metadata": job_metadata,
        "geo_layout": geo_layout,
    }
