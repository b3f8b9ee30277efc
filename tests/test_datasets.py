import datetime as dt

import pytest

from tests.conftest import values
from tripweave.config import PipelineConfig, get_config, table_path
from tripweave.plans.datasets import (
    DATASETS,
    DESCRIPTIONS,
    RULE_REPORT,
    SOURCE,
    STREAM,
    Layers,
    open_source,
    open_stream,
    rule_report,
    store_layers,
)
from tripweave.plans.ingest_job import JobLabels, clean_trips, ingest_trips, with_job_metadata
from tripweave.schemas import TRIPS, TRIPS_GEO
from tripweave.session import cluster_conf, input_bytes, scratch_path
from tripweave.sinks import write_dataset
from tripweave.sources.lineitem_trips import load_lineitem_trips
from tripweave.sources.trip_files import csv_options, with_ingestion_metadata

AS_OF = dt.datetime(2022, 2, 2, 2, 2, 2)

# Rows and columns of each dataset over the sf 0.001 fixture.
SIZES = {
    "bronze_taxi_raw": (5978, 20),
    "bronze_taxi_enriched": (5978, 27),
    "bronze_data_quality_metrics": (2267, 10),
    "silver_taxi_trips": (4511, 29),
    "silver_daily_trip_stats": (2105, 24),
    "silver_hourly_location_stats": (4489, 11),
    "silver_payment_analysis": (4264, 11),
    "silver_data_quality": (1, 6),
    "gold_daily_kpis": (2105, 19),
    "gold_peak_hours_analysis": (48, 14),
    "gold_route_performance": (196, 15),
    "gold_customer_segments": (40, 12),
    "gold_weekly_trends": (357, 13),
    "gold_revenue_breakdown": (4264, 17),
    "gold_executive_summary": (1, 12),
}


@pytest.fixture(scope="module")
def trip_csv(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "trips")
    load_lineitem_trips(spark, small).write.options(**csv_options()).csv(path)
    return path


@pytest.fixture(scope="module")
def layers(spark, trip_csv):
    return Layers(open_source(spark, PipelineConfig(source_path=trip_csv, as_of=AS_OF)), AS_OF)


def test_inventory(layers):
    assert [spec.name for spec in DATASETS] == list(SIZES)
    assert set(layers) == {SOURCE, *SIZES}
    for name, (_, width) in SIZES.items():
        assert len(layers[name].columns) == width, name
    assert {spec.name for spec in DATASETS if spec.partition_by} == {
        "silver_taxi_trips",
        "silver_daily_trip_stats",
        "silver_hourly_location_stats",
    }


@pytest.fixture(scope="module")
def few_days(spark, small):
    """Trips of some weeks only, so that date partitions stay few."""
    trips = load_lineitem_trips(spark, small).filter("tpep_pickup_datetime < '1995-02-20'")
    return with_ingestion_metadata(trips, "dev", AS_OF, from_files=False)


def _same(stored, lazy):
    assert {*stored} == {SOURCE, *SIZES, "bronze_taxi_rejected", RULE_REPORT}
    told = values(rule_report(lazy, AS_OF), "*")
    assert sorted(values(stored[RULE_REPORT].drop("mode"), "*")) == sorted(told)
    for name in SIZES:
        assert stored[name].dtypes == lazy[name].dtypes, name
        assert stored[name].count() == lazy[name].count(), name
    assert stored["silver_taxi_trips"].count() > 50
    for name in ("gold_executive_summary", "silver_data_quality", "gold_customer_segments"):
        assert sorted(map(str, values(stored[name], "*"))) == sorted(
            map(str, values(lazy[name], "*"))
        ), name


def test_stored_as_tables(spark, few_days):
    config = PipelineConfig("spark_catalog", "trips_test", as_of=AS_OF)
    stored = store_layers(spark, config, few_days)
    _same(stored, Layers(few_days, AS_OF))

    table = "trips_test.gold_executive_summary"
    properties = dict(values(spark.sql(f"SHOW TBLPROPERTIES {table}"), "*"))
    assert (properties["sla"], properties["quality"]) == ("1_hour", "gold")
    detail = spark.sql("DESCRIBE EXTENDED trips_test.silver_taxi_trips")
    detail = dict(values(detail, "col_name", "data_type"))
    assert detail["Comment"] == "Validated trips without duplicates"


def test_stored_below_a_folder_and_again(spark, few_days, tmp_path):
    config = PipelineConfig(output_path=str(tmp_path / "v1.2.3"), as_of=AS_OF)
    lazy = Layers(few_days, AS_OF)
    _same(store_layers(spark, config, few_days), lazy)
    told = spark.read.parquet(f"{config.output_path}/{DESCRIPTIONS}").filter("properties['sla'] = '1_hour'")
    assert values(told, "dataset") == ["gold_executive_summary"]
    again = store_layers(spark, config, few_days)
    assert again["silver_taxi_trips"].count() == lazy["silver_taxi_trips"].count()


def test_write_needs_one_target(spark, tmp_path):
    with pytest.raises(ValueError, match="table or path"):
        write_dataset(spark.range(1))
    with pytest.raises(ValueError, match="keeps no comment"):
        write_dataset(spark.range(1), path=str(tmp_path / "x"), comment="lost")


def test_sizes(layers):
    for name, (size, _) in SIZES.items():
        assert layers[name].count() == size, name


def test_nothing_in_nothing_out(spark):
    """No dataset fails without input; the two one-row datasets keep their row."""
    source = with_ingestion_metadata(spark.createDataFrame([], TRIPS), from_files=False)
    empty = Layers(source, AS_OF)
    for name in SIZES:
        one_row = name in ("silver_data_quality", "gold_executive_summary")
        assert empty[name].count() == int(one_row), name
    assert all(row.passed == row.failed == 0 for row in rule_report(empty).collect())
    assert clean_trips(source).isEmpty()


def test_rule_report(layers):
    report = {
        (dataset, rule): (passed, failed)
        for dataset, rule, passed, failed in values(rule_report(layers), "*")
    }
    assert len(report) == 14 and report["bronze_taxi_raw", "fits_layout"] == (6221, 0)
    assert sum(report["bronze_taxi_raw", "valid_vendor"]) == 6221
    assert report["silver_taxi_trips", "logical_timestamps"] == (5428 - 132, 132)
    assert report["silver_taxi_trips", "valid_duration"] == (5428 - 132 - 21, 132 + 21)


def test_streaming_view(spark, trip_csv):
    stream = open_stream(spark, PipelineConfig(source_path=trip_csv + ".csv.gz"))
    assert stream.isStreaming and stream.columns == [*TRIPS.names, "ingestion_timestamp"]
    assert spark.table(STREAM).isStreaming


def test_config(spark):
    assert table_path("a", "b", "c") == "a.b.c"
    assert get_config(spark, "no_such_key", "x") == "x"
    spark.conf.set("schema_name", "from_session")
    try:
        config = PipelineConfig.from_session(spark, catalog="main")
    finally:
        spark.conf.unset("schema_name")
    assert config.table("t") == "main.from_session.t"
    assert "from_session" in config.describe()


def test_session_settings(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert cluster_conf(0)[key] == "1"
    assert cluster_conf(0, time_zone="Asia/Tokyo")["spark.sql.session.timeZone"] == "Asia/Tokyo"
    (tmp_path / "a.csv").write_text("12345")
    assert input_bytes(spark, str(tmp_path)) == 5
    assert int(cluster_conf(100 * 10**12)[key]) == 372_530
    assert int(cluster_conf(10**12)[key]) == 3726
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_clean_trips(spark):
    rows = spark.createDataFrame(
        [
            ("2020-02-03 04:05:06", "2020-02-03 05:05:06", 2.0, 1.0, 1.0),
            ("03/02/2020", None, 0.0, 1.0, 1.0),
            (None, "2020-02-03 05:05:06", None, 1.0, 1.0),
            ("2020-02-03 04:05:06", None, -1.0, 0.0, 1.0),
            ("2020-02-03 04:05:06", None, 1.0, 1.0, -1.0),
            ("2020-02-03 04:05:06", None, 1.0, None, None),
        ],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count double,"
        " trip_distance double, total_amount double",
    )
    clean = clean_trips(rows)
    assert values(clean, "pickup_month", "passenger_count_clean", "data_quality_flag") == [
        (2, 2.0, "CLEAN"),
        (None, 1.0, "SUSPICIOUS"),
        (None, 1.0, "SUSPICIOUS"),
        (2, 1.0, "SUSPICIOUS"),
        (2, 1.0, "SUSPICIOUS"),
        (2, 1.0, "CLEAN"),
    ]
    assert values(clean, "pickup_year", "pickup_day", "dropoff_datetime")[0] == (
        2020,
        3,
        dt.datetime(2020, 2, 3, 5, 5, 6),
    )
    labelled = with_job_metadata(clean, JobLabels("yellow_trips"), AS_OF)
    assert labelled.columns[-7:] == [
        "ingestion_timestamp",
        "data_source",
        "pipeline_stage",
        "data_classification",
        "business_domain",
        "ingestion_job",
        "processing_date",
    ]
    assert labelled.first().processing_date == AS_OF.date()


@pytest.mark.parametrize("schema", [None, TRIPS])
def test_ingest_job(spark, trip_csv, tmp_path, schema):
    path = str(tmp_path / "out")
    labels = JobLabels("yellow_trips")
    summary = ingest_trips(spark, trip_csv, labels, path=path, schema=schema, as_of=AS_OF)
    nulls = spark.read.parquet(path).filter("tpep_pickup_datetime IS NULL").count()
    assert nulls > 0
    assert summary == {
        "status": "success",
        "records_processed": 6221,
        "records_written": 6221,
        "quality_score": pytest.approx(100 - 2 * 100 * nulls / 6221),
        "target_path": path,
    }


def test_ingest_job_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest_trips(spark, str(tmp_path / "none"), JobLabels("x"), path=str(tmp_path / "out"))



def test_ingest_job_with_coordinates(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        ",".join(TRIPS_GEO.names) + "\n"
        "1,2015-01-15 19:05:39,2015-01-15 19:23:42,0,1.59,-73.99,40.75,1,N,-73.97,40.75,"
        "1,12,1,0.5,3.25,0,17.05\n"
    )
    path = str(tmp_path / "out")
    ingest_trips(spark, str(tmp_path / "in.csv"), JobLabels("x"), path=path, schema=TRIPS_GEO)
    row = spark.read.parquet(path).first()
    assert (row.VendorID, row.pickup_longitude, row.passenger_count_clean) == ("1", -73.99, 1.0)
    assert (row.pickup_datetime, row.data_quality_flag) == (
        dt.datetime(2015, 1, 15, 19, 5, 39),
        "CLEAN",
    )
