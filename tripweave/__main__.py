"""Command line: store all datasets, run the stand-alone ingestion, or score tables.

    python -m tripweave layers --source-path /data/trips.csv.gz --output-path /lake/trips
    python -m tripweave ingest --source-path /data/trips.csv.gz --data-source trips_public \\
        --catalog spark_catalog --schema default --table trips_bronze
    python -m tripweave check --tables trips_bronze,other_table --critical id,ts
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from tripweave.config import PipelineConfig, table_path
from tripweave.operators.quality import QualityCheck, quality_by_table
from tripweave.plans.datasets import DATASETS, STREAM, store_layers
from tripweave.plans.ingest_job import JobLabels, ingest_trips
from tripweave.schemas import TRIPS, TRIPS_GEO, TRIPS_TEXT
from tripweave.session import size_session


LAYOUTS = {"text": TRIPS_TEXT, "typed": TRIPS, "geo": TRIPS_GEO, "infer": None}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tripweave")
    commands = top.add_subparsers(dest="command", required=True)

    layers = commands.add_parser("layers", help="store every dataset")
    for name in ("catalog", "schema", "source-path", "environment", "output-path", "time-zone"):
        layers.add_argument(f"--{name}")
    layers.add_argument("--table-format", help="storage format (default: parquet)")

    ingest = commands.add_parser("ingest", help="clean and score trip files into one table")
    ingest.add_argument("--source-path", required=True)
    ingest.add_argument("--data-source", required=True, help="label of the records' origin")
    target = ingest.add_mutually_exclusive_group(required=True)
    target.add_argument("--table")
    target.add_argument("--path")
    ingest.add_argument(
        "--layout",
        choices=LAYOUTS,
        default="text",
        help="text keeps times as they stand in the file; typed stores what is no time as NULL",
    )

    check = commands.add_parser("check", help="quality scores of several tables")
    check.add_argument("--tables", required=True, type=_names, help="names, comma-separated")
    check.add_argument("--critical", default=[], type=_names, help="columns scored by NULLs")
    check.add_argument("--non-negative", default=[], type=_names)
    for command in (ingest, check):
        command.add_argument("--catalog", default="spark_catalog")
        command.add_argument("--schema", default="default")
    return top


def _names(text: str) -> list[str]:
    return text.split(",")


def _check_of(
    table: str, df: DataFrame, critical: list[str], non_negative: list[str]
) -> QualityCheck:
    """The check of ``df``; a column that it lacks is an error, not a perfect score."""
    lacking = [name for name in (*critical, *non_negative) if name not in df.columns]
    if lacking:
        raise ValueError(f"table {table} lacks the columns to check: {', '.join(lacking)}")
    return QualityCheck(critical, non_negative)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    given = vars(parser().parse_args(argv))
    command = given.pop("command")
    spark = SparkSession.builder.appName(f"tripweave-{command}").getOrCreate()
    if command == "layers":
        settings = {name: value for name, value in given.items() if value is not None}
        config = PipelineConfig.from_session(spark, **settings)
        if not config.source_path:
            raise ValueError("give --source-path or set source_path in the session")
        size_session(spark, config.source_path, config.time_zone)
        print(config.describe())
        print("datasets      ", *(spec.name for spec in DATASETS), STREAM)
        store_layers(spark, config)
        return
    if command == "check":
        tables = {
            name: spark.table(table_path(given["catalog"], given["schema"], name))
            for name in given["tables"]
        }
        wanted = (given["critical"], given["non_negative"])
        scores = quality_by_table(
            {name: (df, _check_of(name, df, *wanted)) for name, df in tables.items()}
        )
        scores.show(n=len(tables) * sum(map(len, wanted)), truncate=False)
        return
    size_session(spark, given["source_path"])
    table = given["table"]
    summary = ingest_trips(
        spark,
        given["source_path"],
        JobLabels(given["data_source"]),
        table=table and table_path(given["catalog"], given["schema"], table),
        path=given["path"],
        schema=LAYOUTS[given["layout"]],
    )
    for name, value in summary.items():
        print(f"{name:<18} {value}")


if __name__ == "__main__":
    main()
