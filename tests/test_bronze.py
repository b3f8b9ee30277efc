import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tripweave.functions.clock import minutes_between, whole_seconds
from tripweave.plans import bronze
from tripweave.sources.trip_files import with_ingestion_metadata


def at(hour, minute=0, second=0, day=1):
    return dt.datetime(2020, 1, day, hour, minute, second)


def enriched_of(trips_of, *records):
    return bronze.enrich_trips(with_ingestion_metadata(trips_of(*records), from_files=False))


def test_raw_needs_vendor_and_both_times(trips_of):
    raw = bronze.raw_trips(
        trips_of(
            {},
            {"VendorID": None},
            {"tpep_pickup_datetime": None},
            {"tpep_dropoff_datetime": None},
            {"passenger_count": None},
        )
    )
    assert values(raw, "passenger_count") == [1, None]


def test_layout(trips_of):
    enriched = enriched_of(trips_of, {})
    assert len(enriched.columns) == 27
    types = dict(enriched.dtypes)
    assert types["trip_duration_minutes"] == types["avg_speed_mph"] == "double"
    assert types["pickup_date"] == "date"
    assert types["pickup_hour"] == types["pickup_day_of_week"] == "int"
    assert types["is_suspicious"] == "boolean"


def test_duration_and_speed(trips_of):
    enriched = enriched_of(
        trips_of,
        {},
        {"tpep_dropoff_datetime": at(10)},
        {"tpep_dropoff_datetime": at(9, 55)},
        {"trip_distance": None},
    )
    assert values(enriched, "trip_duration_minutes", "avg_speed_mph") == [
        (10.0, pytest.approx(18.0)),
        (0.0, 0.0),
        (-5.0, 0.0),
        (10.0, None),
    ]


def test_calendar_parts(trips_of):
    saturday, sunday, monday = (
        {
            "tpep_pickup_datetime": at(23, 59, day=day),
            "tpep_dropoff_datetime": at(0, 9, day=day + 1),
        }
        for day in (4, 5, 6)
    )
    enriched = enriched_of(trips_of, saturday, sunday, monday)
    assert values(enriched, "pickup_date", "pickup_hour", "pickup_day_of_week") == [
        (dt.date(2020, 1, 4), 23, 7),
        (dt.date(2020, 1, 5), 23, 1),
        (dt.date(2020, 1, 6), 23, 2),
    ]


@pytest.mark.parametrize(
    ("record", "suspicious"),
    [
        ({}, False),
        ({"trip_distance": 100.0, "tpep_dropoff_datetime": at(13)}, False),
        ({"trip_distance": 100.5, "tpep_dropoff_datetime": at(13)}, True),
        ({"tpep_dropoff_datetime": at(13)}, False),
        ({"tpep_dropoff_datetime": at(13, 0, 1)}, True),
        ({"trip_distance": 100.0, "tpep_dropoff_datetime": at(11)}, False),
        ({"trip_distance": 100.0, "tpep_dropoff_datetime": at(10, 59)}, True),
        ({"passenger_count": 6}, False),
        ({"passenger_count": 7}, True),
        ({"passenger_count": None}, False),
        ({"trip_distance": None}, False),
        ({"trip_distance": None, "passenger_count": 7}, True),
    ],
)
def test_suspicious_limits(trips_of, record, suspicious):
    assert values(enriched_of(trips_of, record), "is_suspicious") == [suspicious]


def test_seconds_are_cut_on_each_side(spark):
    times = spark.sql(
        "SELECT TIMESTAMP_NTZ'2020-01-01 00:00:00.9' a, TIMESTAMP_NTZ'2020-01-01 00:00:01.1' b,"
        " TIMESTAMP'2020-01-01 00:00:00.9' c, TIMESTAMP'2020-01-01 00:00:01.1' d,"
        " TIMESTAMP_NTZ'1969-12-31 23:59:59.5' e"
    )
    found = times.select(
        minutes_between(times, "a", "b") * 60,
        minutes_between(times, "c", "d") * 60,
        whole_seconds(times, "e"),
    ).first()
    assert tuple(found) == (1.0, 1.0, -1)


def test_wall_clock_durations_ignore_daylight_saving(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = spark.sql(
            "SELECT TIMESTAMP_NTZ'2020-03-08 01:30:00' a, TIMESTAMP_NTZ'2020-03-08 03:30:00' b,"
            " TIMESTAMP'2020-03-08 01:30:00' c, TIMESTAMP'2020-03-08 03:30:00' d"
        )
        found = times.select(
            minutes_between(times, "a", "b"), minutes_between(times, "c", "d")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(found) == (120.0, 60.0)


def test_daily_quality(trips_of):
    quality = bronze.daily_quality(
        enriched_of(
            trips_of,
            {},
            {"passenger_count": 7},
            {"tpep_pickup_datetime": at(9)},
            {"tpep_pickup_datetime": at(9, day=2), "tpep_dropoff_datetime": at(10, day=2)},
        ),
        as_of=dt.datetime(2021, 1, 1),
    ).orderBy("pickup_date")
    assert quality.columns == [
        "pickup_date",
        "total_records",
        "suspicious_records",
        "avg_trip_distance",
        "avg_trip_duration",
        "avg_fare_amount",
        "earliest_pickup",
        "latest_pickup",
        "metric_timestamp",
        "data_quality_score",
    ]
    assert values(
        quality, "total_records", "suspicious_records", "earliest_pickup", "data_quality_score"
    ) == [(3, 1, at(9), 66.67), (1, 0, at(9, day=2), 100.0)]
    assert values(quality.select(F.year("metric_timestamp").alias("y")), "y") == [2021, 2021]
