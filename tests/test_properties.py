"""Laws that hold for any trips, checked on random and on skewed ones."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import PLAIN_TRIP, values
from tripweave.operators.dedupe import keep_first
from tripweave.operators.rules import SILVER_RULES, apply_expectations, expectation_report
from tripweave.plans import bronze, gold, silver
from tripweave.plans.datasets import Layers
from tripweave.schemas import TRIP_KEY, TRIP_TIE_BREAK
from tripweave.sources.lineitem_trips import load_lineitem_trips
from tripweave.sources.trip_files import with_ingestion_metadata

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

maybe = lambda strategy: st.one_of(st.none(), strategy)
records = st.lists(
    st.fixed_dictionaries(
        {
            "tpep_pickup_datetime": st.integers(0, 3).map(
                lambda h: dt.datetime(2020, 1, 1) + dt.timedelta(hours=7 * h)
            ),
            "tpep_dropoff_datetime": st.integers(0, 3).map(
                lambda h: dt.datetime(2020, 1, 1, 1) + dt.timedelta(hours=7 * h)
            ),
            "passenger_count": maybe(st.integers(0, 2)),
            "DOLocationID": maybe(st.integers(1, 2)),
            "trip_distance": maybe(st.sampled_from([0.0, 0.5, 2.0, 120.0])),
            "fare_amount": maybe(st.sampled_from([-1.0, 0.0, 4.0, 600.0])),
            "total_amount": maybe(st.integers(-4, 40).map(lambda n: n / 4)),
        }
    ),
    min_size=1,
    max_size=40,
)


def sort_key(record):
    """The tie-break with NULLs last, as Python compares it."""
    return [(record[name] is None, record[name]) if record[name] is not None else (True, 0)
            for name in TRIP_TIE_BREAK]


@FEW
@given(records)
def test_deduplication_against_brute_force(trips_of, drawn):
    full = [PLAIN_TRIP | record for record in drawn]
    expected = {}
    for record in sorted(full, key=sort_key, reverse=True):
        expected[tuple(record[name] for name in TRIP_KEY)] = record
    once = keep_first(trips_of(*drawn), TRIP_KEY, TRIP_TIE_BREAK)
    found = {tuple(row[name] for name in TRIP_KEY): row.asDict() for row in once.collect()}
    assert found == expected

    again = keep_first(once, TRIP_KEY, TRIP_TIE_BREAK)
    assert again.exceptAll(once).isEmpty() and again.count() == len(expected)
    backwards = keep_first(trips_of(*reversed(drawn)), TRIP_KEY, TRIP_TIE_BREAK)
    assert backwards.exceptAll(once).isEmpty()


@FEW
@given(records)
def test_kept_and_violating_rows_make_up_the_input(trips_of, drawn):
    enriched = bronze.enrich_trips(with_ingestion_metadata(trips_of(*drawn), from_files=False))
    refined = silver.refine_trips(enriched)
    total, kept = refined.count(), apply_expectations(refined, SILVER_RULES)
    passed = " AND ".join(f"({rule})" for rule in SILVER_RULES.values())
    assert kept.count() + refined.filter(f"NOT coalesce({passed}, false)").count() == total
    for row in expectation_report(refined, SILVER_RULES, "silver").collect():
        assert row.passed + row.failed == total
        assert row.passed >= kept.count()


@pytest.fixture(scope="module")
def skewed(spark, small):
    """Trips of which a third share one key and most of the rest one day and one route."""
    trips = load_lineitem_trips(spark, small).limit(2000)
    one = F.lit(dt.datetime(1996, 5, 4, 9))
    copies = (
        trips.limit(1)
        .withColumns(
            {
                "VendorID": F.lit(1),
                "tpep_pickup_datetime": one.cast("timestamp_ntz"),
                "tpep_dropoff_datetime": (one + F.expr("INTERVAL 9 MINUTES")).cast("timestamp_ntz"),
                "passenger_count": F.lit(1),
                "trip_distance": F.lit(2.0),
                "PULocationID": F.lit(5),
                "DOLocationID": F.lit(6),
            }
        )
        .crossJoin(spark.range(4000))
        .withColumns({"fare_amount": F.col("id") % 50 + 1.0, "total_amount": F.col("id") + 1.0})
    )
    day = copies.withColumns(
        {
            "tpep_pickup_datetime": F.expr("tpep_pickup_datetime + make_dt_interval(0, 0, 0, id)"),
            "tpep_dropoff_datetime": F.expr("tpep_dropoff_datetime + make_dt_interval(0, 0, 0, id)"),
        }
    )
    union = trips.unionByName(copies.drop("id")).unionByName(day.drop("id"))
    return Layers(with_ingestion_metadata(union.repartition(6), from_files=False))


def test_hot_keys_lose_nothing(skewed):
    trips = skewed["silver_taxi_trips"]
    total, revenue = trips.agg(F.count(F.lit(1)), F.sum("total_amount")).first()
    assert total > 4000
    for report, count, money in (
        (silver.daily_trip_stats, "total_trips", "total_revenue"),
        (silver.payment_analysis, "trip_count", "total_revenue"),
        (gold.peak_hours, "total_trips", "total_revenue"),
        (gold.weekly_trends, "total_trips", "total_revenue"),
        (gold.revenue_breakdown, "trip_count", "total_revenue"),
        (gold.customer_segments, "trip_count", "total_revenue"),
    ):
        found = report(trips).agg(F.sum(count), F.sum(money)).first()
        assert tuple(found) == (total, revenue), report.__name__
    hot = trips.filter("PULocationID = 5 AND DOLocationID = 6 AND pickup_date = '1996-05-04'")
    assert hot.filter("tpep_pickup_datetime = '1996-05-04 09:00:00'").count() == 1
    assert values(hot.agg(F.min("total_amount")), "*") == [1.0]


def test_shares_add_up(skewed):
    trips = skewed["silver_taxi_trips"]
    (segments,) = values(
        gold.customer_segments(trips).agg(F.sum("revenue_contribution_pct")), "*"
    )
    assert segments == pytest.approx(100, abs=0.3)
    shares = silver.payment_analysis(trips).groupBy("pickup_date").agg(
        F.sum("revenue_percentage").alias("share")
    )
    assert shares.filter("abs(share - 100) > 0.1").isEmpty()
