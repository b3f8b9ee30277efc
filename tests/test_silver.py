import datetime as dt

import pytest

from tests.conftest import values
from tripweave.operators.dedupe import keep_first
from tripweave.plans import bronze, silver
from tripweave.schemas import SILVER_TRIP_COLUMNS
from tripweave.sources.trip_files import with_ingestion_metadata


def at(hour, minute=0, day=1):
    return dt.datetime(2020, 1, day, hour, minute)


@pytest.fixture(scope="module")
def silver_of(trips_of):
    def build(*records):
        raw = with_ingestion_metadata(trips_of(*records), from_files=False)
        return silver.silver_trips(bronze.enrich_trips(raw))

    return build


def test_layout(silver_of):
    trips = silver_of({})
    assert trips.columns == list(SILVER_TRIP_COLUMNS)
    assert len(trips.columns) == 29


@pytest.mark.parametrize(
    ("time", "label"),
    [
        (at(5, 59), "Night"),
        (at(6), "Morning"),
        (at(11, 59), "Morning"),
        (at(12), "Afternoon"),
        (at(17, 59), "Afternoon"),
        (at(18), "Evening"),
        (at(21, 59), "Evening"),
        (at(22), "Night"),
    ],
)
def test_time_of_day(silver_of, time, label):
    trip = {"tpep_pickup_datetime": time, "tpep_dropoff_datetime": time + dt.timedelta(minutes=9)}
    assert values(silver_of(trip), "time_of_day") == [label]


def test_weekend(silver_of):
    days = [
        {"tpep_pickup_datetime": at(10, day=d), "tpep_dropoff_datetime": at(11, day=d)}
        for d in (3, 4, 5, 6)
    ]
    trips = silver_of(*days).orderBy("pickup_date")
    assert values(trips, "is_weekend") == [False, True, True, False]


def test_labels(silver_of):
    codes = [None, 0, 1, 2, 3, 4, 5, 6, 7]
    trips = silver_of(
        *({"payment_type": c, "RatecodeID": c, "DOLocationID": i} for i, c in enumerate(codes))
    ).orderBy("DOLocationID")
    assert values(trips, "payment_type_name", "rate_code_name") == [
        ("Unknown", "Unknown"),
        ("Unknown", "Unknown"),
        ("Credit Card", "Standard"),
        ("Cash", "JFK"),
        ("No Charge", "Newark"),
        ("Dispute", "Nassau or Westchester"),
        ("Unknown", "Negotiated"),
        ("Unknown", "Group Ride"),
        ("Unknown", "Unknown"),
    ]


def test_ratios_round_half_up(silver_of):
    trips = silver_of({"fare_amount": 8.0, "tip_amount": 0.4101, "trip_distance": 6.4})
    assert values(trips, "fare_per_mile", "tip_percentage") == [(1.25, 5.13)]


@pytest.mark.parametrize(
    "record",
    [
        {"trip_distance": 0.0},
        {"trip_distance": None},
        {"trip_distance": 100.0, "tpep_dropoff_datetime": at(12)},
        {"passenger_count": 0},
        {"passenger_count": None},
        {"passenger_count": 7},
        {"fare_amount": 0.0},
        {"fare_amount": -1.0},
        {"fare_amount": 500.0},
        {"fare_amount": None},
        {"tpep_dropoff_datetime": at(10)},
        {"tpep_dropoff_datetime": at(9)},
        {"tpep_dropoff_datetime": at(13)},
        {"trip_distance": 80.0, "tpep_dropoff_datetime": at(11)},
        {"trip_distance": 90.0, "tpep_dropoff_datetime": at(11)},
    ],
)
def test_dropped(silver_of, record):
    assert silver_of(record).isEmpty()


def test_zero_divisors_are_no_error(silver_of):
    # A zero fare and a zero distance are divided by before the rules drop them.
    zero = {"fare_amount": 0.0, "trip_distance": 0.0}
    assert silver_of(zero, {"DOLocationID": 9}).count() == 1


def test_rules_come_after_deduplication(silver_of):
    # The cheaper copy wins the deduplication, then fails a rule: neither remains.
    cheap = {"total_amount": 1.0, "fare_amount": 0.0}
    assert silver_of({}, cheap).isEmpty()


def test_suspicious_copies_go_before_deduplication(silver_of):
    # The suspicious copy is smaller in the tie-break but was filtered out first.
    fast = {"total_amount": 1.0, "trip_distance": 99.0}
    assert values(silver_of({}, fast), "total_amount") == [13.25]


def test_one_whole_record_survives(silver_of):
    trips = silver_of(
        {"total_amount": 14.0, "tip_amount": 1.0},
        {"total_amount": 13.0, "tip_amount": 3.0},
        {"total_amount": None, "tip_amount": 0.0},
    )
    assert values(trips, "total_amount", "tip_amount") == [(13.0, 3.0)]


def test_null_keys_are_equal(spark):
    rows = spark.createDataFrame(
        [(None, 2), (None, 1), (1, None), (1, 5), (2, None)], "k int, v int"
    )
    kept = keep_first(rows, ["k"], ["v"]).orderBy("k")
    assert values(kept, "k", "v") == [(None, 1), (1, 5), (2, None)]


def test_daily_stats(silver_of):
    stats = silver.daily_trip_stats(
        silver_of(
            {},
            {"DOLocationID": 3, "payment_type": 2, "VendorID": 2, "trip_distance": 2.0},
            {"DOLocationID": 4, "payment_type": None, "passenger_count": 5},
        )
    )
    assert len(stats.columns) == 24
    row = stats.first()
    assert (row.total_trips, row.unique_vendors, row.total_passengers) == (3, 2, 7)
    assert (row.credit_card_trips, row.cash_trips, row.weekend_trips) == (1, 1, 0)
    assert (row.min_trip_distance, row.max_trip_distance, row.total_trip_distance) == (2, 3, 8)
    assert (row.avg_fare_per_mile, row.credit_card_percentage) == (3.75, 33.33)


def test_zones_are_ranked_densely_within_the_hour(silver_of):
    records = [
        {"PULocationID": zone, "DOLocationID": i}
        for zone, trips in ((1, 3), (2, 2), (3, 2), (4, 1))
        for i in range(trips)
    ]
    records.append({"tpep_pickup_datetime": at(9, 58), "PULocationID": 9})
    stats = silver.hourly_location_stats(silver_of(*records)).orderBy("PULocationID")
    assert len(stats.columns) == 11
    assert values(stats, "PULocationID", "trip_count", "unique_destinations", "trips_rank") == [
        (1, 3, 3, 1),
        (2, 2, 2, 2),
        (3, 2, 2, 2),
        (4, 1, 1, 3),
        (9, 1, 1, 1),
    ]


def test_payment_shares_of_the_day(silver_of):
    analysis = silver.payment_analysis(
        silver_of(
            {"total_amount": 30.0},
            {"DOLocationID": 3, "payment_type": 2, "total_amount": 10.0},
            {
                "tpep_pickup_datetime": at(10, day=2),
                "tpep_dropoff_datetime": at(11, day=2),
                "total_amount": 7.0,
            },
        )
    ).orderBy("pickup_date", "payment_type_name")
    assert len(analysis.columns) == 11
    assert values(analysis, "payment_type_name", "revenue_percentage") == [
        ("Cash", 25.0),
        ("Credit Card", 75.0),
        ("Credit Card", 100.0),
    ]


def test_pass_rate(trips_of):
    raw = with_ingestion_metadata(
        trips_of({}, {"fare_amount": 0.0}, {"DOLocationID": 3}), from_files=False
    )
    enriched = bronze.enrich_trips(raw)
    rate = silver.layer_pass_rate(enriched, silver.silver_trips(enriched), dt.datetime(2020, 5, 6))
    types = ["date", "bigint", "bigint", "double", "bigint", "timestamp"]
    assert [kind for _, kind in rate.dtypes] == types
    # The zero fare survives its duplicate, the plain trip, and is dropped afterwards.
    assert values(
        rate, "bronze_records", "silver_records", "pass_rate_percentage", "records_dropped"
    ) == [(3, 1, 33.33, 2)]
    assert rate.first().date == dt.date(2020, 5, 6)


def test_pass_rate_without_input(trips_of):
    enriched = bronze.enrich_trips(
        with_ingestion_metadata(trips_of({}).limit(0), from_files=False)
    )
    rate = silver.layer_pass_rate(enriched, silver.silver_trips(enriched))
    assert values(
        rate, "bronze_records", "silver_records", "pass_rate_percentage", "records_dropped"
    ) == [(0, 0, 0.0, 0)]
