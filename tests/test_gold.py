import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import values
from tripweave.functions.labels import route_length, spending_segment
from tripweave.operators.ranking import overall_dense_rank
from tripweave.plans import bronze, gold, silver
from tripweave.plans.presentation import in_reading_order, latest_days, quality_trend
from tripweave.sources.trip_files import with_ingestion_metadata


def on(day: dt.date, minute=0, **other):
    """A ten-minute trip at ten o'clock; ``minute`` tells trips of a day apart."""
    start = dt.datetime(day.year, day.month, day.day, 10, minute)
    return {
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + dt.timedelta(minutes=10),
        **other,
    }


def day(n):
    """Day ``n`` after Monday 2020-01-06."""
    return dt.date(2020, 1, 6) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def silver_of(trips_of):
    def build(*records):
        raw = with_ingestion_metadata(trips_of(*records), from_files=False)
        return silver.silver_trips(bronze.enrich_trips(raw))

    return build


def test_daily_kpis_compare_with_the_row_before(silver_of):
    trips = silver_of(
        on(day(0), 0, total_amount=10.0),
        on(day(0), 1, total_amount=30.0),
        on(day(5), 0, total_amount=50.0),
    )
    kpis = in_reading_order(gold.daily_kpis(trips), "gold_daily_kpis")
    assert len(kpis.columns) == 19
    assert values(
        kpis, "pickup_date", "total_trips", "trips_change_pct", "revenue_change_pct"
    ) == [(day(0), 2, None, None), (day(5), 1, -50.0, 25.0)]
    assert values(kpis, "revenue_per_mile", "utilization_rate", "data_freshness_hours") == [
        (6.67, 30.0, 24),
        (16.67, 30.0, 24),
    ]


def test_change_from_zero_revenue_is_null(silver_of):
    trips = silver_of(on(day(0), total_amount=0.0), on(day(1), total_amount=5.0))
    kpis = gold.daily_kpis(trips).orderBy("pickup_date")
    assert values(kpis, "revenue_change_pct") == [None, None]


def test_peak_hours_rank_rounded_means(silver_of):
    ten = [on(day(d), m) for d in (0, 1) for m in range(2)]
    eleven = [
        trip
        | {
            "tpep_pickup_datetime": trip["tpep_pickup_datetime"] + dt.timedelta(hours=1),
            "tpep_dropoff_datetime": trip["tpep_dropoff_datetime"] + dt.timedelta(hours=1),
        }
        for trip in ten[:3]
    ]
    weekend = [on(day(5))]
    hours = gold.peak_hours(silver_of(*ten, *eleven, *weekend))
    assert len(hours.columns) == 14
    hours = in_reading_order(hours, "gold_peak_hours_analysis")
    assert values(
        hours, "is_weekend", "pickup_hour", "days_observed", "avg_trips_per_day", "demand_rank"
    ) == [(False, 10, 2, 2.0, 1), (False, 11, 2, 2.0, 1), (True, 10, 1, 1.0, 1)]


def test_routes_need_ten_trips(silver_of):
    trips = silver_of(
        *(on(day(0), m, PULocationID=1) for m in range(10)),
        *(on(day(0), m, PULocationID=2, total_amount=26.5) for m in range(12)),
        *(on(day(0), m, PULocationID=3) for m in range(9)),
    )
    routes = gold.route_performance(trips)
    assert len(routes.columns) == 15
    routes = in_reading_order(routes, "gold_route_performance")
    assert values(
        routes, "PULocationID", "trip_count", "revenue_per_mile", "revenue_per_minute",
        "profitability_rank", "route_type",
    ) == [
        (2, 12, 8.83, 2.65, 1, "Medium Distance"),
        (1, 10, 4.42, 1.33, 2, "Medium Distance"),
    ]


@pytest.mark.parametrize(
    ("miles", "label"),
    [
        (1.99, "Short Distance"),
        (2.0, "Medium Distance"),
        (5.0, "Long Distance"),
        (9.99, "Long Distance"),
        (10.0, "Extra Long Distance"),
        (None, "Extra Long Distance"),
    ],
)
def test_route_length(spark, miles, label):
    frame = spark.createDataFrame([(miles,)], "miles double")
    assert values(frame.select(route_length("miles").alias("label")), "label") == [label]


@pytest.mark.parametrize(
    ("spend", "tip", "trips", "label"),
    [
        (31.0, 15.01, 1, "Premium"),
        (31.0, 15.0, 101, "High Value"),
        (20.01, 50.0, 100, "Standard"),
        (20.01, None, 101, "High Value"),
        (31.0, None, 1, "Standard"),
        (9.99, 99.0, 500, "Budget"),
        (10.0, 99.0, 500, "Standard"),
    ],
)
def test_segments(spark, spend, tip, trips, label):
    frame = spark.createDataFrame([(spend, tip, trips)], "s double, t double, n long")
    assert values(frame.select(spending_segment("s", "t", "n").alias("x")), "x") == [label]


def test_segment_shares(silver_of):
    segments = gold.customer_segments(
        silver_of(
            on(day(0), 0, total_amount=30.0),
            on(day(0), 1, total_amount=10.0, payment_type=2),
        )
    )
    assert len(segments.columns) == 12
    segments = in_reading_order(segments, "gold_customer_segments")
    assert values(segments, "payment_type_name", "revenue_contribution_pct") == [
        ("Credit Card", 75.0),
        ("Cash", 25.0),
    ]


def test_weeks_start_on_monday_and_average_up_to_four_rows(silver_of):
    counts = [1, 2, 3, 4, 6]
    trips = silver_of(
        *(on(day(7 * w + 6 * (m % 2)), m) for w, n in enumerate(counts) for m in range(n)),
    )
    weeks = gold.weekly_trends(trips).orderBy("week_start")
    assert len(weeks.columns) == 13
    starts = [dt.datetime(2020, 1, 6) + dt.timedelta(weeks=w) for w in range(5)]
    assert values(weeks, "week_start") == starts
    assert values(weeks, "trips_wow_change_pct") == [None, 100.0, 50.0, 33.33, 50.0]
    assert values(weeks, "trips_4week_avg") == [1.0, 2.0, 2.0, 3.0, 4.0]
    assert values(weeks, "active_days") == [1, 2, 2, 2, 2]


def test_revenue_breakdown(silver_of):
    breakdown = gold.revenue_breakdown(
        silver_of(on(day(0), 0), on(day(0), 1, total_amount=6.75, tip_amount=0.0))
    )
    assert len(breakdown.columns) == 17
    row = in_reading_order(breakdown, "gold_revenue_breakdown").first()
    assert (row.base_fare_revenue, row.tip_revenue, row.total_revenue) == (20.0, 2.0, 20.0)
    assert (row.base_fare_pct, row.tip_pct) == (100.0, 10.0)
    assert (row.avg_revenue_per_trip, row.avg_revenue_per_mile) == (10.0, 3.33)


def summaries(trips):
    """Both ways to the summary: with the daily statistics, and from the trips alone."""
    stamp = dt.datetime(2020, 9, 9)
    return [
        gold.executive_summary(trips, silver.daily_trip_stats(trips), stamp),
        gold.executive_summary(trips, as_of=stamp),
    ]


def test_summary_ranges_include_both_ends(silver_of):
    trips = silver_of(
        on(day(40), 0, total_amount=10.0),
        on(day(40), 1, total_amount=20.0),
        on(day(33), 0, total_amount=60.0),
        on(day(32), 0, total_amount=70.0),
        on(day(10), 0, total_amount=80.0),
        on(day(9), 0, total_amount=999.0),
    )
    for summary in summaries(trips):
        assert len(summary.columns) == 12
        (row,) = summary.collect()
        assert (row.report_date, row.trips_today, row.revenue_today) == (day(40), 2, 30.0)
        assert row.avg_revenue_per_trip_today == 15.0
        assert (row.avg_trips_7d, row.avg_revenue_7d) == (1.5, 45.0)
        assert (row.avg_trips_30d, row.avg_revenue_30d) == (1.25, 60.0)
        assert (row.trips_vs_7d_avg_pct, row.revenue_vs_7d_avg_pct) == (33.33, -33.33)
        assert row.data_quality_status == "Good"


def test_summary_of_nothing_is_one_row(silver_of):
    for summary in summaries(silver_of({}).limit(0)):
        (row,) = summary.collect()
        assert row.trips_today == 0
        assert row.report_date is row.revenue_today is row.avg_trips_7d is None
        assert row.trips_vs_7d_avg_pct is None


@pytest.mark.parametrize("values_of", ["spread", "one value for most rows", "all alike"])
def test_overall_rank_equals_a_window_over_all_rows(spark, values_of):
    spread = F.round(F.pmod(F.col("id") * 7919, F.lit(101)) / 8 - 5, 2)
    value = {"spread": spread, "all alike": F.lit(1.5)}.get(
        values_of, F.when(F.col("id") % 3 > 0, F.lit(2.5)).otherwise(spread)
    )
    for place, special in enumerate(("NaN", "Infinity", "-Infinity", None, "-0.0", "0.0")):
        value = F.when(F.col("id") % 37 == place, F.lit(special).cast("double")).otherwise(value)
    frame = spark.range(400).select("id", value.alias("v"))
    plain = frame.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("v"))))
    ranked = overall_dense_rank(frame, "v", "r")
    assert plain.dtypes == ranked.dtypes
    assert sorted(values(plain, "id", "r")) == sorted(values(ranked, "id", "r"))
    assert overall_dense_rank(frame.limit(0), "v", "r").isEmpty()


def test_look_ups(silver_of, spark):
    kpis = gold.daily_kpis(silver_of(*(on(day(n)) for n in range(9))))
    assert values(latest_days(kpis), "pickup_date") == [day(n) for n in range(8, 1, -1)]
    rates = spark.createDataFrame(
        [(day(1), 90.0, 1), (day(2), 80.0, 2)],
        "date date, pass_rate_percentage double, records_dropped long",
    )
    assert values(quality_trend(rates), "records_dropped") == [2, 1]
