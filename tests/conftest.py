from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

from tripweave.schemas import TRIPS

TABLES = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(TABLES / "sf0.001")


# A trip that passes every rule: Wednesday, 10 minutes, 3 miles.
PLAIN_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2020, 1, 1, 10, 0, 0),
    "tpep_dropoff_datetime": dt.datetime(2020, 1, 1, 10, 10, 0),
    "passenger_count": 1,
    "trip_distance": 3.0,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.25,
    "total_amount": 13.25,
}


@pytest.fixture(scope="session")
def trips_of(spark):
    """Trips from partial records: what a record leaves out is that of the plain trip."""

    def build(*records: dict) -> DataFrame:
        rows = [tuple((PLAIN_TRIP | record).values()) for record in records]
        return spark.createDataFrame(rows, TRIPS)

    return build


def values(df: DataFrame, *columns: str) -> list:
    """Rows as tuples (or plain values for one column), in the order of the DataFrame."""
    rows = [tuple(row) for row in df.select(*columns).collect()]
    return [row[0] for row in rows] if rows and len(rows[0]) == 1 else rows
