"""Trips derived from a ``lineitem`` table: test input that reaches every rule and label.

One trip per line item, plus a second one with a different fare for some of them. All
measures are binary fractions, so that their sums do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.schemas import TRIPS

_USED = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_shipdate",
)

# The expressions of the fixture, step by step.
_HELPERS = """
    l_orderkey AS k; l_partkey AS p; l_suppkey AS sup; l_linenumber AS ln; l_quantity AS q;
    floor(l_extendedprice / 1000) AS e; l_shipdate AS d
"""
_SECONDS = """
    ((k * 7 + ln * 5) % 24) * 3600 + (p % 60) * 60 AS pick_s;
    CASE WHEN p % 83 = 0 THEN 0 WHEN p % 79 = 0 THEN -300
        WHEN p % 73 = 0 AND k % 2 = 0 THEN 10800
        WHEN p % 73 = 0 THEN 12000
        ELSE (5 + (k + p) % 60) * 60 + (k % 4) * 15 END AS dur_s
"""
_BASE = """
    int(CASE WHEN p % 97 <> 0 THEN sup % 2 + 1 END) AS VendorID;
    CASE WHEN p % 89 <> 0 THEN timestampadd(SECOND, pick_s, d) END AS tpep_pickup_datetime;
    CASE WHEN p % 71 <> 0 THEN timestampadd(SECOND, pick_s + dur_s, d) END
        AS tpep_dropoff_datetime;
    CASE WHEN p % 41 = 0 THEN NULL WHEN p % 37 = 0 THEN 0 WHEN p % 31 = 0 THEN 7
        ELSE ln % 6 + 1 END AS passenger_count;
    CASE WHEN p % 67 = 0 THEN 0D WHEN p % 61 = 0 AND k % 2 = 0 THEN 100D
        WHEN p % 61 = 0 THEN 150D WHEN p % 59 = 0 THEN NULL WHEN sup % 4 = 0 THEN q / 16
        WHEN sup % 4 = 1 THEN q / 8 WHEN sup % 4 = 2 THEN q / 4 ELSE q / 2 END AS trip_distance;
    int(sup % 8) AS RatecodeID;
    if(k % 50 = 0, 'Y', 'N') AS store_and_fwd_flag;
    int(sup % 20 + 1) AS PULocationID;
    int(if(p = 7, 264, p % 20 + 1)) AS DOLocationID;
    int(k % 6) AS payment_type;
    CASE WHEN p % 53 = 0 THEN 600D WHEN p % 47 = 0 THEN 0D WHEN p % 43 = 0 THEN -5D
        WHEN k % 6 = 4 THEN 3D + (e % 8) * 0.5D WHEN k % 6 = 3 THEN 4D + (e % 40) * 0.5D
        ELSE 2.5D + e * 0.5D END AS fare_amount;
    (ln % 3) * 0.5D AS extra;
    0.5D AS mta_tax;
    if(sup % 10 = 0, 5.75D, 0D) AS tolls_amount;
    0.25D AS improvement_surcharge
"""
_COPIES = "if(p % 29 = 0, array(struct(trip, 0D), struct(trip, 1D)), array(struct(trip, 0D)))"
_FINAL = {
    "fare_amount": "trip.fare_amount + surplus",
    "tip_amount": "CASE trip.payment_type WHEN 1 THEN fare_amount * 0.25D"
    " WHEN 2 THEN fare_amount * 0.125D ELSE 0D END",
    "total_amount": "fare_amount + trip.extra + trip.mta_tax + tip_amount + trip.tolls_amount"
    " + trip.improvement_surcharge",
}


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The 17-column trip layout over ``lineitem``; a narrow step without a shuffle.

    Trips are the output of a generator, so filters on trips stay above it instead of being
    rewritten over the line items, which would repeat the expressions in every filter.
    """
    return _trips(lineitem.selectExpr(*_HELPERS.split(";")))


def _trips(used: DataFrame) -> DataFrame:
    return (
        used.selectExpr("*", *_SECONDS.split(";"))
        .selectExpr("p", f"struct({_BASE.replace(';', ',')}) AS trip")
        .selectExpr(f"inline({_COPIES}) AS (trip, surplus)")
        .selectExpr(*(f"{_FINAL.get(n, f'trip.{n}')} AS {n}" for n in TRIPS.names))
    )


def load_lineitem_trips(spark: SparkSession, folder: str, only: str = "true") -> DataFrame:
    """Trips of a folder's ``lineitem`` table, dealt over all cores; ``only`` of some line items.

    The given tables are files of one row group, which one task reads: what follows would run
    on one core up to its first shuffle. Trip files do not need this; it belongs to the fixture.
    """
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet").select(*_USED).filter(only)
    return _trips(lineitem.selectExpr(*_HELPERS.split(";")).repartition("k", "ln"))
