"""Streamed trips on their way into the stored layers, batch by batch.

Every micro-batch goes to the raw layer, and from there on to the silver trips of the dates it
touches. All that a batch writes replaces what the same batch wrote before, so a batch that
is repeated after a failure leaves the layers as if it had run once.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripweave.operators.dedupe import keep_first_grouped
from tripweave.operators.rules import (
    ENRICHED_RULES,
    RAW_RULES,
    REPORT_LAYOUT,
    SILVER_RULES,
    apply_expectations,
    expectation_report,
    rejected_rows,
)
from tripweave.plans import bronze, silver
from tripweave.session import scratch_path
from tripweave.sinks import write_dataset, write_partitions
from tripweave.schemas import TRIP_KEY, TRIPS
from tripweave.sources.trip_files import FITS_LAYOUT, RAW_LINE, csv_options, with_ingestion_metadata
from tripweave.streaming.trip_stream import Intake

# Columns by which layers are stored; not part of the datasets.
PERIOD, BATCH = "period", "batch"
_LISTED = "bronze_taxi_raw_periods"
_ARRIVAL = {**RAW_RULES, **FITS_LAYOUT}


def stream_source(
    spark: SparkSession, folder: str, schema: T.StructType = TRIPS, environment: str = "",
    as_of: datetime | None = None, intake: Intake = Intake(),
) -> DataFrame:
    """Unbounded trips of the CSV files in ``folder`` with file, time and environment.

    Lines that do not fit the layout stand in ``RAW_LINE``, as in the batch source.
    """
    lines = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())])
    reader = spark.readStream.schema(lines).options(**csv_options(), **intake.options())
    trips = reader.option("columnNameOfCorruptRecord", RAW_LINE).csv(folder)
    return with_ingestion_metadata(trips, environment, as_of)


@dataclass(frozen=True)
class StreamedLayers:
    """Raw and silver trips, rejected rows and rule counts below ``folder``, fed by one stream.

    One stream at a time may feed a folder. ``as_of`` fixes the clock columns. Layers are stored
    by ``period``, named by its first date: a day, or where days have few trips a month. Of
    a period that a batch touches, all silver trips are renewed. Raw trips stay as a batch brings
    them, in a folder a batch; the periods of every batch are listed beside them.
    """

    spark: SparkSession
    folder: str
    as_of: datetime | None = None
    period: str = "day"

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def start(self, stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Feed the layers from ``stream``: all that is at hand once, or ``every`` interval for good."""
        # Batches are numbered anew by every checkpoint.
        mark = f"{zlib.crc32(checkpoint.encode()):08x}"
        trigger = {"availableNow": True} if every is None else {"processingTime": every}
        return (
            stream.writeStream.foreachBatch(lambda batch, number: self.take(batch, f"{mark}-{number}"))
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    def take(self, batch: DataFrame, mark: str) -> list[date]:
        """Store one batch under its ``mark`` and renew the silver trips of its periods, which are returned.

        The batch is read from its files once, into the scratch folder; rules, dates and layers
        take their columns from there.
        """
        path = scratch_path(self.spark, "batch")
        batch.write.option("compression", "zstd").parquet(path)
        landed = self.spark.read.schema(batch.schema).parquet(path)
        raw = apply_expectations(landed, RAW_RULES).drop(RAW_LINE)
        enriched = bronze.enrich_trips(raw, self.as_of)
        counts = expectation_report(landed, _ARRIVAL, "bronze_taxi_raw").unionByName(
            expectation_report(enriched, ENRICHED_RULES, "bronze_taxi_enriched")
        )
        write_dataset(counts.coalesce(1), path=f"{self.path('rule_counts')}/{BATCH}={mark}")
        broken = rejected_rows(landed, _ARRIVAL)
        write_dataset(broken, path=f"{self.path('bronze_taxi_rejected')}/{BATCH}={mark}")
        rows = enriched.select(*raw.columns, self._period().alias(PERIOD))
        write_dataset(rows, path=f"{self.path('bronze_taxi_raw')}/{BATCH}={mark}")
        periods = rows.select(PERIOD).distinct()
        touched = [row[0] for row in periods.collect()]  # bounded by the calendar
        listed = self.spark.createDataFrame([(each,) for each in touched], periods.schema).coalesce(1)
        write_dataset(listed, path=f"{self.path(_LISTED)}/{BATCH}={mark}")
        self.renew(sorted(touched))
        return sorted(touched)

    def renew(self, touched: list[date]) -> None:
        """Silver trips of the periods ``touched``, from all raw trips of these periods."""
        if not touched:
            return
        listed = self._stored(_LISTED).filter(F.col(PERIOD).isin(touched)).select(BATCH).distinct()
        batches = [row[0] for row in listed.collect()]
        trips = self.raw().filter(F.col(BATCH).isin(batches) & F.col(PERIOD).isin(touched)).drop(BATCH)
        plain = bronze.enrich_trips(trips, self.as_of).filter(~F.col("is_suspicious")).select(*trips.columns)
        # What follows from other columns is derived once more behind the shuffle, instead of crossing it.
        unique = keep_first_grouped(plain, TRIP_KEY, silver.tie_break(plain), PERIOD)
        refined = silver.label_trips(bronze.enrich_trips(unique, self.as_of), self.as_of, (PERIOD,))
        kept = apply_expectations(refined, SILVER_RULES)
        write_partitions(kept, PERIOD, touched, path=self.path("silver_taxi_trips"), dealt=True)

    def _period(self) -> Column:
        return F.date_trunc(self.period, "pickup_date").cast("date")

    def _stored(self, name: str) -> DataFrame:
        stored = self.spark.read.parquet(self.path(name))
        return stored.withColumn(PERIOD, F.col(PERIOD).cast("date"))

    def raw(self) -> DataFrame:
        """The raw layer with the period and the batch of every trip; filters on the batch open its folder only."""
        return self._stored("bronze_taxi_raw")

    def silver(self) -> DataFrame:
        """Silver trips of all batches so far, with their partition column."""
        return self._stored("silver_taxi_trips")

    def rule_report(self) -> DataFrame:
        """Passed and failed rows of the rules that look at single rows, over all batches so far."""
        counted = self.spark.read.schema(REPORT_LAYOUT).parquet(f"{self.path('rule_counts')}/*")
        return counted.groupBy("dataset", "rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
