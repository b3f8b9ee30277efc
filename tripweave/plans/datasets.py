"""The datasets with their inputs, rules and table properties, and how to build or store them."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripweave.config import PipelineConfig
from tripweave.operators.rules import (
    ENRICHED_RULES,
    RAW_RULES,
    REPORT_LAYOUT,
    SILVER_RULES,
    Rules,
    apply_expectations,
    expectation_report,
    observed,
    observed_lines,
    rejected_rows,
    told,
)
from tripweave.plans import bronze, gold, silver
from tripweave.sinks import read_dataset, write_dataset
from tripweave.sources.trip_files import FITS_LAYOUT, RAW_LINE, read_trips, with_ingestion_metadata
from tripweave.streaming.trip_stream import stream_folder, stream_trips


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset: ``build(*inputs, as_of)`` gives its rows, then ``rules`` apply by ``mode``.

    ``lazy_inputs`` replace ``inputs`` where nothing is stored and fewer inputs cost less.
    ``rejects`` names the dataset in which a stored run keeps the rows that break a rule or,
    read from files, do not fit the layout.
    """

    name: str
    comment: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    rejects: str = ""
    rules: Rules = field(default_factory=dict)
    mode: str = "warn"
    lazy_inputs: tuple[str, ...] = ()

    def candidates(
        self, layers: Mapping[str, DataFrame], as_of: datetime | None, lazy: bool = False
    ) -> DataFrame:
        """Rows before the rules."""
        names = self.lazy_inputs if lazy and self.lazy_inputs else self.inputs
        return self.build(*(layers[name] for name in names), as_of=as_of)

    def rows(
        self, layers: Mapping[str, DataFrame], as_of: datetime | None, lazy: bool = False
    ) -> DataFrame:
        rows = self.candidates(layers, as_of, lazy)
        return apply_expectations(rows, self.rules, self.mode).drop(RAW_LINE)

    def counted_rules(self, rows: DataFrame) -> Rules:
        """The rules, and whether lines fit the layout where ``rows`` tell; that one only warns."""
        return {**self.rules, **FITS_LAYOUT} if RAW_LINE in rows.columns else self.rules


def _unchanged(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return df


# Name of the source in the mapping handed to the specs.
SOURCE = "trips_source"
STREAM = "bronze_taxi_streaming"
RULE_REPORT = "rule_report"
DESCRIPTIONS = "dataset_descriptions"

_DAY = ("pickup_date",)
_OWNED = "business_owner"

# In dependency order.
DATASETS = (
    DatasetSpec(
        "bronze_taxi_raw",
        "Trips as ingested",
        _unchanged,
        (SOURCE,),
        {"quality": "bronze"},
        rules=RAW_RULES,
        mode="drop",
        rejects="bronze_taxi_rejected",
    ),
    DatasetSpec(
        "bronze_taxi_enriched",
        "Trips with derived columns and a suspicious flag",
        bronze.enrich_trips,
        ("bronze_taxi_raw",),
        {"quality": "bronze"},
        rules=ENRICHED_RULES,
    ),
    DatasetSpec(
        "bronze_data_quality_metrics",
        "Quality figures per day of the enriched trips",
        bronze.daily_quality,
        ("bronze_taxi_enriched",),
        {"quality": "metrics"},
    ),
    DatasetSpec(
        "silver_taxi_trips",
        "Validated trips without duplicates",
        silver.refine_trips,
        ("bronze_taxi_enriched",),
        {"quality": "silver"},
        partition_by=_DAY,
        rules=SILVER_RULES,
        mode="drop",
    ),
    DatasetSpec(
        "silver_daily_trip_stats",
        "Trip statistics per day",
        silver.daily_trip_stats,
        ("silver_taxi_trips",),
        {"quality": "silver"},
        partition_by=_DAY,
    ),
    DatasetSpec(
        "silver_hourly_location_stats",
        "Trip statistics per hour and pickup zone",
        silver.hourly_location_stats,
        ("silver_taxi_trips",),
        {"quality": "silver"},
        partition_by=_DAY,
    ),
    DatasetSpec(
        "silver_payment_analysis",
        "Tips and fares by payment type and time of day",
        silver.payment_analysis,
        ("silver_taxi_trips",),
        {"quality": "silver"},
    ),
    DatasetSpec(
        "silver_data_quality",
        "Records before and after cleaning",
        silver.layer_pass_rate,
        ("bronze_taxi_enriched", "silver_taxi_trips"),
        {"quality": "metrics"},
    ),
    DatasetSpec(
        "gold_daily_kpis",
        "Daily key figures with day-over-day change",
        gold.daily_kpis,
        ("silver_taxi_trips",),
        {"quality": "gold", _OWNED: "analytics_team", "refresh_schedule": "daily"},
    ),
    DatasetSpec(
        "gold_peak_hours_analysis",
        "Demand by hour of day",
        gold.peak_hours,
        ("silver_taxi_trips",),
        {"quality": "gold", _OWNED: "operations_team"},
    ),
    DatasetSpec(
        "gold_route_performance",
        "Revenue by route",
        gold.route_performance,
        ("silver_taxi_trips",),
        {"quality": "gold", _OWNED: "strategy_team"},
    ),
    DatasetSpec(
        "gold_customer_segments",
        "Spending segments",
        gold.customer_segments,
        ("silver_taxi_trips",),
        {"quality": "gold", _OWNED: "marketing_team"},
    ),
    DatasetSpec(
        "gold_weekly_trends",
        "Weekly figures with week-over-week change",
        gold.weekly_trends,
        ("silver_taxi_trips",),
        {"quality": "gold", _OWNED: "analytics_team"},
    ),
    DatasetSpec(
        "gold_revenue_breakdown",
        "Revenue by component",
        gold.revenue_breakdown,
        ("silver_taxi_trips",),
        {"quality": "gold", _OWNED: "finance_team"},
    ),
    DatasetSpec(
        "gold_executive_summary",
        "Latest day against recent days",
        gold.executive_summary,
        ("silver_taxi_trips", "silver_daily_trip_stats"),
        {"quality": "gold", _OWNED: "executive_team", "sla": "1_hour"},
        lazy_inputs=("silver_taxi_trips",),
    ),
)


_SPECS = {spec.name: spec for spec in DATASETS}


def open_source(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """Trips of the configured CSV source with ingestion metadata."""
    trips = read_trips(spark, config.source_path, keep_lines=True)
    return with_ingestion_metadata(trips, config.environment, config.as_of)


def open_stream(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """The streaming counterpart of the source, as an unstored view."""
    stream = stream_trips(spark, stream_folder(config.source_path), as_of=config.as_of)
    stream.createOrReplaceTempView(STREAM)
    return stream


class Layers(Mapping[str, DataFrame]):
    """Every dataset as a lazy DataFrame over ``source``, planned when first asked for.

    Nothing is stored or run, but that route ranks store their routes. Datasets share their
    inputs' plans but not their results: where several are wanted, ``store_layers`` computes
    each of them once.
    """

    def __init__(self, source: DataFrame, as_of: datetime | None = None):
        self._planned = {SOURCE: source}
        self._as_of = as_of

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = _SPECS[name].rows(self, self._as_of, lazy=True)
        return self._planned[name]

    def __iter__(self) -> Iterator[str]:
        return iter((SOURCE, *_SPECS))

    def __len__(self) -> int:
        return len(_SPECS) + 1


def store_layers(
    spark: SparkSession,
    config: PipelineConfig,
    source: DataFrame | None = None,
    only: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """Store every dataset, or ``only`` those named, and read it back for the ones after it.

    Each dataset is computed once: the eleven that use silver trips scan the stored table,
    pruned to their columns, instead of repeating the deduplication. ``RULE_REPORT`` is stored
    beside them: passed and failed rows of every rule, counted by the writes themselves. Only
    where a write counted other rows than it stored (a stage ran twice after executors were lost)
    are the rules counted by a scan. ``rejects`` are read in a second pass, made only if there
    are any. Below a folder the datasets' comments and properties are stored as
    ``DESCRIPTIONS``; tables carry their own.
    """
    layers = {SOURCE: open_source(spark, config) if source is None else source}
    specs = [spec for spec in DATASETS if only is None or spec.name in only]
    if config.output_path is None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {config.catalog}.{config.schema}")
    report = []
    for spec in specs:
        rows = spec.candidates(layers, config.as_of)
        rules = spec.counted_rules(rows)
        if not rules:
            layers[spec.name] = _store(spark, config, spec.name, rows, spec)
            continue
        watch = Observation()
        seen = observed(rows, rules, watch, spec.rules if spec.mode == "drop" else {})
        kept = apply_expectations(seen, spec.rules, spec.mode).drop(RAW_LINE)
        layers[spec.name] = _store(spark, config, spec.name, kept, spec)
        lines = _report_lines(told(watch), layers[spec.name], rows, rules, spec.name)
        report += [(*line, spec.mode if line[1] in spec.rules else "warn") for line in lines]
        if spec.rejects:
            broken = _rejects(spec, rows, rules)
            if not any(failed for *_, failed in lines):
                broken = spark.createDataFrame([], broken.schema)
            layers[spec.rejects] = _store(spark, config, spec.rejects, broken)
    if report:
        lines = spark.createDataFrame(report, f"{REPORT_LAYOUT}, mode string")
        layers[RULE_REPORT] = _store(spark, config, RULE_REPORT, lines)
    if config.output_path is not None:
        described = [(spec.name, spec.comment, dict(spec.properties)) for spec in specs]
        layout = "dataset string, comment string, properties map<string, string>"
        _store(spark, config, DESCRIPTIONS, spark.createDataFrame(described, layout))
    return layers


def _report_lines(
    counts: Mapping[str, int] | None, stored: DataFrame, rows: DataFrame, rules: Rules, name: str
) -> list[tuple]:
    """The lines that a write counted, or those of a scan if it did not count what is stored.

    Files know their number of rows, so that comparing costs no scan.
    """
    if counts is not None and counts["kept"] == stored.count():
        return observed_lines(counts, rules, name)
    return [tuple(row) for row in expectation_report(rows, rules, name).collect()]


def _rejects(spec: DatasetSpec, rows: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule or do not fit the layout, as far as they could be read.

    ``raw_line`` is the text of a line that does not fit, ``failed_rules`` names what was broken,
    ``kept`` rows are in the dataset all the same.
    """
    if RAW_LINE not in rows.columns:
        rows = rows.withColumn(RAW_LINE, F.lit(None).cast("string"))
    dropping = F.array(*(F.lit(name) for name in spec.rules))
    return rejected_rows(rows, rules).withColumn("kept", ~F.arrays_overlap("failed_rules", dropping))


def _store(
    spark: SparkSession,
    config: PipelineConfig,
    name: str,
    rows: DataFrame,
    spec: DatasetSpec | None = None,
) -> DataFrame:
    if config.output_path is None:
        target = {"table": config.table(name)}
        described = {"comment": spec.comment, "properties": spec.properties} if spec else {}
    else:
        target = {"path": f"{config.output_path.rstrip('/')}/{name}"}
        described = {}
    partition_by = spec.partition_by if spec else ()
    write_dataset(rows, fmt=config.table_format, partition_by=partition_by, **described, **target)
    return read_dataset(spark, rows, fmt=config.table_format, **target)


def rule_report(layers: Mapping[str, DataFrame], as_of: datetime | None = None) -> DataFrame:
    """Passed and failed rows of every rule of every dataset that has rules."""
    reports = []
    for spec in DATASETS:
        if spec.rules:
            rows = spec.candidates(layers, as_of)
            reports.append(expectation_report(rows, spec.counted_rules(rows), spec.name))
    return reduce(DataFrame.unionByName, reports)
