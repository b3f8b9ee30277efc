"""What is brought up to date instead of being rebuilt: partitions, daily totals, streamed layers."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import values
from tests.test_plans import plan_of
from tests.test_sources import GOOD, HEADER
from tripweave import stored_queries
from tripweave.operators import dedupe
from tripweave.operators.changes import snapshot_changes
from tripweave.operators.rules import RAW_RULES, expectation_report, observed, told
from tripweave.plans import gold, silver
from tripweave.plans.daily_totals import MEASURED, changed_totals, daily_totals, kpis_of, stats_of
from tripweave.plans.datasets import Layers
from tripweave.schemas import TRIP_KEY, TRIPS
from tripweave.sinks import write_dataset, write_partitions
from tripweave.sources.lineitem_trips import load_lineitem_trips
from tripweave.sources.trip_files import csv_options, with_ingestion_metadata
from tripweave.streaming import trip_layers
from tripweave.streaming.trip_layers import StreamedLayers, stream_source
from tripweave.streaming.trip_stream import Intake, start_append, stream_trips, streamed_rule_report

AS_OF = dt.datetime(2022, 2, 2, 2, 2, 2)
JANUARY = "tpep_pickup_datetime < '1995-01-20'"


def day(n):
    return dt.date(2020, 1, n)


def rows_of(spark, *days):
    return spark.createDataFrame([(i, day(d)) for i, d in enumerate(days)], "id int, d date")


def modified(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_only_touched_partitions_of_a_folder_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "out")
    write_partitions(rows_of(spark, 1, 1, 2, 3), "d", [day(1), day(2), day(3)], path=path)
    before = modified(path)
    write_partitions(rows_of(spark, 2, 2, 2), "d", [day(2), day(3)], path=path)
    found = spark.read.parquet(path).groupBy("d").count().orderBy("d")
    assert values(found, "*") == [(day(1), 2), (day(2), 3)]  # the third has no rows any more
    after = modified(path)
    untouched = {p for p in before if "d=2020-01-01" in p}
    assert untouched and all(after[p] == before[p] for p in untouched)
    assert not {p for p in before if p not in untouched} & set(after)


def test_only_touched_partitions_of_a_table_are_rewritten(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS increments")
    table = "increments.some"
    write_dataset(rows_of(spark, 1, 1, 2, 3), table=table, partition_by=["d"], comment="Kept", properties={"a": "b"})
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_partitions(rows_of(spark, 2, 2, 2).select("d", "id"), "d", [day(2), day(3)], table=table)
    assert values(spark.table(table).groupBy("d").count().orderBy("d"), "*") == [(day(1), 2), (day(2), 3)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    assert dict(values(spark.sql(f"SHOW TBLPROPERTIES {table}"), "*"))["a"] == "b"


def test_a_table_is_not_replaced_by_its_own_rows(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS increments")
    for name in ("increments.own", "spark_catalog.increments.own"):
        write_dataset(rows_of(spark, 1, 2), table=name)
        with pytest.raises(ValueError, match="read from it"):
            write_dataset(spark.table("increments.own").filter("id = 0"), table=name)
        assert spark.table("increments.own").count() == 2
    write_dataset(rows_of(spark, 1).withColumn("more", F.lit(1)), table="increments.own", partition_by=["d"])
    assert spark.table("increments.own").columns == ["id", "more", "d"]


@pytest.fixture(scope="module")
def trips(spark, small):
    source = load_lineitem_trips(spark, small).filter("tpep_pickup_datetime < '1995-04-01'")
    layers = Layers(with_ingestion_metadata(source, from_files=False), AS_OF)
    return spark.createDataFrame(layers["silver_taxi_trips"].toArrow())


def like(found, wanted):
    """Equal rows; means of speeds but for their last digits."""
    def plain(df):
        return sorted(
            tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect()
        )
    assert found.columns == wanted.columns and found.dtypes == wanted.dtypes
    assert plain(found) == plain(wanted)


def test_totals_give_the_daily_reports(trips):
    totals = daily_totals(trips)
    like(stats_of(totals, AS_OF), silver.daily_trip_stats(trips, AS_OF))
    like(kpis_of(totals, AS_OF), gold.daily_kpis(trips, AS_OF))


CHANGES = {
    "nothing": (lambda t: t, lambda t: t),
    "rows added": (lambda t: t.filter("PULocationID <> 3"), lambda t: t),
    "rows removed": (lambda t: t, lambda t: t.filter("PULocationID <> 3")),
    "rows repriced": (lambda t: t, lambda t: t.withColumn("fare_amount", F.col("fare_amount") + F.col("PULocationID") % 2)),
    "values become null": (lambda t: t, lambda t: t.withColumn("tip_percentage", F.lit(None).cast("double"))),
    "values were null": (lambda t: t.withColumn("VendorID", F.lit(None).cast("int")), lambda t: t),
    "from nothing": (lambda t: t.limit(0), lambda t: t),
    "to nothing": (lambda t: t, lambda t: t.limit(0)),
    "extremes move": (lambda t: t, lambda t: t.withColumn("trip_distance", F.when(F.col("PULocationID") < 5, F.lit(0.25)).otherwise(F.col("trip_distance")))),
    "repeated rows": (lambda t: t.unionAll(t.filter("PULocationID = 2")), lambda t: t.unionAll(t.filter("PULocationID = 4"))),
}


@pytest.mark.parametrize("name", CHANGES)
def test_changed_totals_equal_a_rebuild(trips, name):
    old, new = (change(trips) for change in CHANGES[name])
    columns = list(dict.fromkeys((*TRIP_KEY, *MEASURED)))
    changes = snapshot_changes(old.select(*columns), new.select(*columns), TRIP_KEY)
    totals = daily_totals(old)
    fresh, dates = changed_totals(totals, changes, new)
    merged = totals.filter(~F.col("pickup_date").isin(dates)).unionByName(fresh)
    like(merged, daily_totals(new))
    assert bool(dates) == (name != "nothing")


def test_only_dates_that_lost_rows_are_read_again(spark, trips, tmp_path):
    path, kept = str(tmp_path / "trips"), str(tmp_path / "totals")
    write_dataset(trips, path=path, partition_by=["pickup_date"])
    write_dataset(daily_totals(trips), path=kept, partition_by=["pickup_date"])
    stored = spark.read.parquet(path)
    first, second = (r[0] for r in trips.select("pickup_date").distinct().orderBy("pickup_date").limit(2).collect())
    one = trips.filter(F.col("pickup_date").isin(first, second)).select(*MEASURED).dropDuplicates(["pickup_date"])
    kind = F.when(F.col("pickup_date") == F.lit(first), "delete").otherwise("insert")
    changes = one.withColumns({"_change_type": kind, "_row_count": F.lit(1)})
    fresh, dates = changed_totals(spark.read.parquet(kept), changes, stored)
    assert dates == [first, second]
    plan = plan_of(fresh)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    trip_scan, total_scan = (next(x for x in scans if word in x) for word in ("VendorID", "sum_fare"))
    assert f"pickup_date" in trip_scan and str(first) in trip_scan and str(second) not in trip_scan
    assert "fare_amount" not in trip_scan.split("ReadSchema")[1]
    assert str(first) in total_scan and str(second) in total_scan


BAD_LINES = [GOOD.replace("2019-01-01 00:46:40", "yesterday"), "," * 16, GOOD + ",surplus", GOOD]


def test_streamed_layers_equal_a_batch(spark, small, tmp_path):
    files, out, log = (str(tmp_path / name) for name in ("in", "out", "log"))
    source = load_lineitem_trips(spark, small).filter(JANUARY)
    layers = StreamedLayers(spark, out, AS_OF)

    def run(rows):
        if rows is not None:
            rows.coalesce(2).write.mode("append").options(**csv_options()).csv(files)
        layers.start(stream_source(spark, files, as_of=AS_OF), log).awaitTermination()

    run(source.filter("PULocationID < 9"))
    first = layers.silver().count()
    run(source.filter("PULocationID >= 9"))
    run(None)  # nothing new
    lazy = Layers(with_ingestion_metadata(source, "", AS_OF, from_files=False), AS_OF)
    wanted, found = lazy["silver_taxi_trips"], layers.silver()
    assert {r.period.day for r in layers.raw().select("period").distinct().collect()} != {1}
    assert 0 < first < found.count() == wanted.count()
    assert found.select(*wanted.columns).exceptAll(wanted).isEmpty()
    assert layers.raw().count() == lazy["bronze_taxi_raw"].count()
    counted = {r[:2]: r[2:] for r in values(layers.rule_report(), "dataset", "rule", "passed", "failed")}
    plain = expectation_report(lazy["trips_source"], RAW_RULES, "bronze_taxi_raw")
    assert counted.items() >= {r[:2]: r[2:] for r in values(plain, "*")}.items()

    # A batch that runs again changes nothing.
    before = sorted(values(layers.raw().drop("source_file"), "*"), key=str)
    again = with_ingestion_metadata(source.filter("PULocationID < 9"), "", AS_OF, from_files=False)
    marks = sorted({r.batch for r in layers.raw().select("batch").collect()})
    layers.take(again.withColumn("raw_line", F.lit(None).cast("string")), marks[0])
    assert sorted(values(layers.raw().drop("source_file"), "*"), key=str) == before
    assert layers.silver().count() == wanted.count()


def test_a_streamed_date_may_lose_its_last_trip(spark, trips_of, tmp_path):
    """A later file holds the smaller copy of the only trip, and that copy fails a rule."""
    layers = StreamedLayers(spark, str(tmp_path / "out"), AS_OF)

    def batch(total, fare):
        rows = with_ingestion_metadata(trips_of({"total_amount": total, "fare_amount": fare}), "", AS_OF, False)
        return rows.withColumn("raw_line", F.lit(None).cast("string"))

    layers.take(batch(13.25, 10.0), "x-0")
    assert layers.silver().count() == 1
    layers.take(batch(1.0, -2.0), "x-1")
    assert layers.silver().count() == 0 and layers.raw().count() == 2


def test_streamed_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([HEADER, *BAD_LINES]) + "\n")
    layers = StreamedLayers(spark, str(tmp_path / "out"))
    layers.start(stream_source(spark, str(tmp_path / "in")), str(tmp_path / "log")).awaitTermination()
    rejected = spark.read.parquet(layers.path("bronze_taxi_rejected"))
    found = {r.raw_line: set(r.failed_rules) for r in rejected.collect()}
    assert found == {
        BAD_LINES[0]: {"valid_pickup_time", "fits_layout"},
        BAD_LINES[2]: {"fits_layout"},
        None: {"valid_vendor", "valid_pickup_time", "valid_dropoff_time"},
    }
    assert layers.raw().count() == 2 and layers.silver().count() == 1


def test_counts_of_the_write_and_of_the_stream(spark, small, tmp_path):
    source = load_lineitem_trips(spark, small).filter("PULocationID < 5")
    wanted = sorted(values(expectation_report(source, RAW_RULES, "raw"), "*"))
    watch = Observation()
    observed(source, RAW_RULES, watch).filter("PULocationID = 3").write.parquet(str(tmp_path / "some"))
    counts = told(watch)
    gone = Observation()
    observed(source, RAW_RULES, gone).filter("false").write.parquet(str(tmp_path / "none"))
    assert told(gone) is None  # the plan had no use for the rows
    assert [counts[f"passed_{i}"] for i in range(3)] == [p for _, rule, p, _ in values(expectation_report(source, RAW_RULES, "raw"), "*")]

    files, out, log = (str(tmp_path / name) for name in ("in", "out", "log"))
    source.repartition(3).write.options(**csv_options()).csv(files)
    stream = observed(stream_trips(spark, files, max_files_per_trigger=1), RAW_RULES, "rules")
    query = start_append(stream, out, log)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    assert sorted(values(streamed_rule_report(spark, query, "rules", RAW_RULES, "raw"), "*")) == wanted


def test_files_are_archived_and_bytes_bound_a_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "abcd":
        (tmp_path / "in" / f"{name}.csv").write_text(f"{HEADER}\n{GOOD}\n")
    size = (tmp_path / "in" / "a.csv").stat().st_size
    intake = Intake(max_bytes=size + 1, archive_to=str(tmp_path / "done"))
    query = start_append(stream_trips(spark, str(tmp_path / "in"), intake=intake), str(tmp_path / "out"), str(tmp_path / "log"))
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 4
    assert spark.read.schema(TRIPS).parquet(str(tmp_path / "out")).count() == 4
    # The last batch's file is cleaned up by a later run.
    assert len(list((tmp_path / "done").rglob("*.csv"))) >= 3


@pytest.mark.parametrize("name", ["stream_on_an_interval", "stream_with_archive", "stream_expectations"])
def test_files_of_a_streamed_folder_grow_in_number_not_in_size(spark, small, monkeypatch, name):
    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    write, written = stored_queries._csv, []

    def watched(spark, rows, path=None):
        path = write(spark, rows, path)
        written.append(spark.read.options(**csv_options()).csv(path).groupBy(F.input_file_name()).count().toPandas()["count"])
        return path

    monkeypatch.setattr(stored_queries, "_csv", watched)
    monkeypatch.setattr(stored_queries, "LINES_IN_FILE", lines // 8, raising=False)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        found = stored_queries.queries()[name](spark, small)
        assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "2"
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    trips = load_lineitem_trips(spark, small).count()
    assert len(written[0]) >= 8 and written[0].max() <= trips // 8 + 100
    assert trips == (found.count() if name != "stream_expectations" else found.selectExpr("passed + failed").first()[0])


def test_streamed_trips_are_shuffled_once(spark, trips_of, tmp_path, monkeypatch):
    """A batch is stored as it comes, and silver trips cross one shuffle, with columns as they were stored."""
    layers, plans = StreamedLayers(spark, str(tmp_path / "out"), AS_OF), []
    write = trip_layers.write_partitions

    def watched(rows, *args, **kwargs):
        plans.append(plan_of(rows))
        assert kwargs.get("dealt")
        return write(rows, *args, **kwargs)

    monkeypatch.setattr(trip_layers, "write_partitions", watched)
    for mark, days in (("x-0", (1, 2, 3)), ("x-1", (3, 4))):
        records = [{"tpep_pickup_datetime": dt.datetime(2020, 1, d, h), "tpep_dropoff_datetime": dt.datetime(2020, 1, d, h, 10)} for d in days for h in range(5)]
        rows = with_ingestion_metadata(trips_of(*records).repartition(4), "", AS_OF, False)
        layers.take(rows.withColumn("raw_line", F.lit(None).cast("string")), mark)
    assert len(plans) == 2 and layers.raw().count() == 25 and layers.silver().count() == 20
    for plan, batches in zip(plans, (["x-0"], ["x-0", "x-1"]), strict=True):
        assert plan.count("Exchange hashpartitioning") == plan.count("Exchange ") - plan.count("BroadcastExchange ") == 1
        shuffled = plan[plan.index("Exchange hashpartitioning") :].split("\n")[1]
        assert "avg_speed_mph" not in shuffled
        assert all(batch in plan for batch in batches)
    # One file for each date, though rows came from several tasks.
    files = list((tmp_path / "out" / "silver_taxi_trips").rglob("*.parquet"))
    assert len(files) == 4

    # Batches without trips of the renewed dates are not opened.
    layers.renew([day(4)])
    assert "x-1" in plans[-1] and "x-0" not in plans[-1]
    assert layers.silver().count() == 20


@pytest.mark.parametrize("size", [10, 40, 1_000_000])
def test_grouped_deduplication_equals_the_plain_one(spark, monkeypatch, size):
    """Groups of several parts, a null group, and a key and a null key that hold most rows of a group."""
    monkeypatch.setattr(dedupe, "ROWS_IN_PART", size)
    rows = [(g, g * 1000 + (k if k % 3 else 0), k % 7, float(k % 5)) for g in range(4) for k in range(60 * g + 1)]
    rows += [(9, None, k % 3, None) for k in range(50)] + [(None, k % 9, k, 0.0) for k in range(90)]
    df = spark.createDataFrame(rows, "g int, k int, a int, b double").repartition(5)
    wanted = dedupe.keep_first(df, ["g", "k"], ["a", "b"])
    found = dedupe.keep_first_grouped(df, ["g", "k"], ["a", "b"], "g")
    assert found.columns == wanted.columns
    assert sorted(values(found, "*"), key=str) == sorted(values(wanted, "*"), key=str)
    assert (" LeftAnti" in plan_of(found)) == (size <= 40)
