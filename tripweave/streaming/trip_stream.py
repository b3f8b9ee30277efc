"""Trip files as a stream: each new file is read once, results survive a restart."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripweave.functions.clock import stamp
from tripweave.operators.rules import REPORT_LAYOUT, Rules, observed_lines
from tripweave.schemas import TRIPS
from tripweave.sources.trip_files import csv_options

# Setting for how many progress reports of a stream a session keeps.
REPORTS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


@dataclass(frozen=True)
class Intake:
    """How much a batch takes in, and what becomes of the files after it.

    ``max_files`` or ``max_bytes`` bound a batch; of the two only one may be given. Files
    that a completed batch has read move to ``archive_to``, below it by their own path: a folder
    outside the one that is watched, on the same storage. Without it they stay, and are
    remembered.
    """

    max_files: int | None = None
    max_bytes: int | None = None
    archive_to: str | None = None

    def options(self) -> dict[str, str]:
        found = {}
        if self.max_files is not None:
            found["maxFilesPerTrigger"] = str(self.max_files)
        if self.max_bytes is not None:
            found["maxBytesPerTrigger"] = str(self.max_bytes)
        if self.archive_to is not None:
            found |= {"cleanSource": "archive", "sourceArchiveDir": self.archive_to}
        return found


def stream_folder(source_path: str) -> str:
    """Folder watched for the batch source ``source_path``."""
    return source_path.removesuffix(".csv.gz")


def stream_trips(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = TRIPS,
    max_files_per_trigger: int | None = None,
    as_of: datetime | None = None,
    intake: Intake | None = None,
) -> DataFrame:
    """Unbounded trips of the CSV files in ``folder``, with their ingestion time."""
    options = (intake or Intake(max_files=max_files_per_trigger)).options()
    reader = spark.readStream.schema(schema).options(**csv_options(), **options)
    return reader.csv(folder).withColumn("ingestion_timestamp", stamp(as_of))


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
) -> StreamingQuery:
    """Append ``stream`` to ``path``: all files at hand once, or ``every`` interval for good.

    ``checkpoint`` and ``path`` belong on storage shared by the cluster: together they make a
    restarted query go on where it stopped, without losing or repeating files.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def streamed_rule_report(spark: SparkSession, query: StreamingQuery, watch: str, rules: Rules, dataset: str) -> DataFrame:
    """Rule counts of a run of ``query``, whose stream is ``observed`` under the name ``watch``.

    They come from the progress reports of the run's batches, of which a session keeps the last
    ``REPORTS_KEPT``: a run that has lost some is an error.
    """
    told = [p for p in query.recentProgress if watch in p.observedMetrics]
    numbers = {p.batchId for p in told}
    if numbers and len(numbers) <= max(numbers) - min(numbers):
        raise ValueError(f"of {max(numbers) - min(numbers) + 1} batches only {len(numbers)} are still reported")
    latest = {p.batchId: p.observedMetrics[watch].asDict() for p in told}
    totals = dict.fromkeys(("seen", *(f"passed_{i}" for i in range(len(rules)))), 0)
    for counts in latest.values():
        for name in totals:
            totals[name] += counts[name]
    return spark.createDataFrame(observed_lines(totals, rules, dataset), REPORT_LAYOUT)
