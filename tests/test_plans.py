"""Physical plans: what is shuffled, what is read, what stays in generated code."""

import re

import pytest

from tripweave import queries
from tripweave.operators.ranking import overall_dense_rank
from tripweave.plans import gold, silver
from tripweave.plans.datasets import Layers
from tripweave.sinks import write_dataset
from tripweave.sources.lineitem_trips import trips_from_lineitem
from tripweave.sources.trip_files import with_ingestion_metadata

# Above this size a method is interpreted: the JVM does not compile it.
JIT_METHOD_LIMIT = 8000


def plan_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def lines_below(plan, marker):
    """For each line with ``marker``, the operator it reads from, projections aside."""
    lines = plan.splitlines()
    below = []
    for i, line in enumerate(lines):
        if marker in line:
            below.append(next(x for x in lines[i + 1 :] if not x.lstrip("+-: ").startswith("Project")))
    return below


@pytest.fixture(scope="module")
def lazy(spark, small):
    trips = trips_from_lineitem(spark.read.parquet(f"{small}/lineitem.parquet"))
    return Layers(with_ingestion_metadata(trips, from_files=False))


@pytest.fixture(scope="module")
def stored(spark, lazy, tmp_path_factory):
    """Silver trips of some dates and their daily statistics, as date-partitioned files."""
    root = str(tmp_path_factory.mktemp("stored"))
    trips = lazy["silver_taxi_trips"].filter("pickup_date > '2001-10-20'")
    trips.repartition(1).write.partitionBy("pickup_date").parquet(f"{root}/trips")
    trips = spark.read.parquet(f"{root}/trips").select(*trips.columns)
    stats = silver.daily_trip_stats(trips)
    stats.repartition(1).write.partitionBy("pickup_date").parquet(f"{root}/stats")
    return trips, spark.read.parquet(f"{root}/stats").select(*stats.columns)


REPORTS = [
    silver.daily_trip_stats,
    silver.hourly_location_stats,
    silver.payment_analysis,
    gold.daily_kpis,
    gold.peak_hours,
    gold.rated_routes,
    gold.customer_segments,
    gold.weekly_trends,
    gold.revenue_breakdown,
    gold.executive_summary,
]


@pytest.mark.parametrize("report", REPORTS, ids=lambda report: report.__name__)
def test_trips_are_aggregated_before_they_are_shuffled(stored, report):
    plan = plan_of(report(stored[0]))
    for child in lines_below(plan, "Exchange hashpartitioning"):
        assert "HashAggregate" in child, child
    # One task sees aggregated rows only.
    for child in lines_below(plan, "Exchange SinglePartition"):
        assert "HashAggregate" in child or "Filter (trip_count >= 10)" in child, child
        assert "partial" not in child or "keys=[]" in child
    tail = plan[plan.rfind("Exchange") :]
    assert "partial_" in tail and "SinglePartition" not in tail


def test_reports_read_their_columns_only(stored):
    plan = plan_of(gold.customer_segments(stored[0]))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert "extra" not in schema and "fare_amount" not in schema


def test_deduplication_trims_before_the_shuffle(lazy):
    plan = plan_of(lazy["silver_taxi_trips"])
    assert plan.count("Exchange hashpartitioning") == 1
    (below,) = lines_below(plan, "Exchange hashpartitioning")
    assert "WindowGroupLimit" in below and "Partial" in below


def test_summary_prunes_date_partitions(stored):
    plan = plan_of(gold.executive_summary(*stored))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", plan)
    assert any("pickup_date = Subquery" in found for found in filters)
    assert any("pickup_date >= date_sub(Subquery" in found for found in filters)
    assert "Window" not in plan


def test_summary_opens_the_trips_of_one_date_only(stored):
    plan = plan_of(gold.executive_summary(*stored))
    scans = [x for x in re.findall(r"PartitionFilters: \[([^\]]*).*?ReadSchema: struct<([^>]*)", plan)]
    trips = [filters for filters, columns in scans if "total_amount:double" in columns]
    assert trips and all("pickup_date = Subquery" in filters for filters in trips)


def test_stored_rule_report_deduplicates_nothing(spark, small):
    report = queries.stored_expectations(spark, small)
    assert "WindowGroupLimit" not in plan_of(report) and report.count() == 13


def test_filters_reach_the_scan(lazy, stored):
    plan = plan_of(stored[0].filter("pickup_date = DATE'2001-11-01' AND fare_amount > 5"))
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_date = 2001-11-01", plan)
    assert "GreaterThan(fare_amount,5.0)" in plan


def test_overall_rank_has_no_single_task_over_the_rows(spark):
    rows = spark.range(1000).selectExpr("id", "round(id / 7, 2) v").repartition(4, "id")
    plan = plan_of(overall_dense_rank(rows, "v", "r"))
    for child in lines_below(plan, "Exchange SinglePartition"):
        assert "keys=[_range]" in child


def test_routes_are_aggregated_once(lazy):
    """The ranking reads stored routes: nothing of the trips is planned again."""
    plan = plan_of(lazy["gold_route_performance"])
    assert "WindowGroupLimit" not in plan and "lineitem" not in plan


def test_generated_methods_stay_compilable(spark, lazy):
    execution = lazy["bronze_taxi_enriched"]._jdf.queryExecution()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    stages = getattr(debug, "MODULE$").codegenStringSeq(execution.executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < JIT_METHOD_LIMIT


def test_no_python_in_any_plan(lazy):
    for name, df in lazy.items():
        assert not re.search("Python|Pandas|Arrow", plan_of(df)), name


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    """A date with nearly all rows gets several files; most others, not hashed to it, get one."""
    rows = spark.range(200_000).selectExpr(
        "if(id % 1000 = 0, date_add(DATE'2020-01-01', int(id / 1000) % 5), DATE'2021-01-01') d",
        "uuid() payload",
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1MB")
    try:
        write_dataset(rows, path=str(tmp_path / "out"), partition_by=["d"])
    finally:
        spark.conf.unset(size)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "out").glob("d=*")}
    hot = files.pop("d=2021-01-01")
    assert hot > 3 and len(files) == 5
    assert sorted(files.values())[2] == 1 and max(files.values()) <= hot
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200_000
