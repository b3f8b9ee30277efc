import datetime as dt
import gzip
from pathlib import Path

import pytest

from tests.conftest import values
from tripweave.schemas import TRIPS, TRIPS_GEO
from tripweave.sources.lineitem_trips import load_lineitem_trips
from tripweave.sources.trip_files import (
    csv_options,
    read_trips,
    read_trips_inferred,
    with_ingestion_metadata,
)
from tripweave.streaming.trip_stream import start_append, stream_folder, stream_trips

HEADER = ",".join(TRIPS.names)
GOOD = "1,2019-01-01 00:46:40,2019-01-01 00:53:20,1,1.50,1,N,151,239,1,7,0.5,0.5,1.65,0,0.3,9.95"


def test_layouts():
    assert len(TRIPS) == 17 and len(TRIPS_GEO) == 18
    assert all(field.nullable for field in (*TRIPS, *TRIPS_GEO))
    assert TRIPS["tpep_pickup_datetime"].dataType.typeName() == "timestamp"
    assert TRIPS_GEO["pickup_longitude"].dataType.typeName() == "double"


def test_gzip_file_with_bad_lines(spark, tmp_path):
    lines = [
        HEADER,
        GOOD,
        GOOD.replace("2019-01-01 00:46:40", "yesterday"),
        "," * 16,
        GOOD + ",surplus",
    ]
    with gzip.open(tmp_path / "trips.csv.gz", "wt") as file:
        file.write("\n".join(lines) + "\n")
    trips = read_trips(spark, str(tmp_path / "trips.csv.gz"))
    assert trips.schema == TRIPS
    good = dt.datetime(2019, 1, 1, 0, 46, 40)
    assert values(trips, "VendorID", "tpep_pickup_datetime", "total_amount") == [
        (1, good, 9.95),
        (1, None, 9.95),
        (None, None, None),
        (1, good, 9.95),
    ]


def test_columns_bind_by_position_unless_strict(spark, tmp_path):
    swapped = HEADER.replace("VendorID,tpep_pickup_datetime", "tpep_pickup_datetime,VendorID")
    (tmp_path / "trips.csv").write_text(f"{swapped}\n{GOOD}\n")
    assert values(read_trips(spark, str(tmp_path)), "VendorID") == [1]
    with pytest.raises(Exception, match="(?i)header"):
        read_trips(spark, str(tmp_path), strict_header=True).collect()


def test_inferred_types(spark, tmp_path):
    (tmp_path / "trips.csv").write_text(f"{HEADER}\n{GOOD}\n")
    types = dict(read_trips_inferred(spark, str(tmp_path)).dtypes)
    assert (types["VendorID"], types["tpep_pickup_datetime"]) == ("int", "timestamp")


def test_ingestion_metadata(spark, tmp_path):
    (tmp_path / "trips.csv").write_text(f"{HEADER}\n{GOOD}\n")
    scan = read_trips(spark, str(tmp_path))
    row = with_ingestion_metadata(scan, "dev", dt.datetime(2020, 1, 1)).first()
    assert len(row) == 20
    assert (row.environment, row.ingestion_timestamp) == ("dev", dt.datetime(2020, 1, 1))
    assert Path(row.source_file).name == "trips.csv"
    detached = spark.createDataFrame([tuple(scan.first())], TRIPS)
    assert with_ingestion_metadata(detached, from_files=False).first().source_file is None


def test_stream_folder():
    assert stream_folder("/data/trips.csv.gz") == "/data/trips"
    assert stream_folder("/data/trips") == "/data/trips"


def test_stream_equals_batch_and_reads_each_file_once(spark, small, tmp_path):
    files, out, log = (str(tmp_path / name) for name in ("in", "out", "log"))
    source = load_lineitem_trips(spark, small)
    source.repartition(5).write.options(**csv_options()).csv(files)

    def run():
        stream = stream_trips(spark, files, max_files_per_trigger=2)
        assert stream.isStreaming and len(stream.columns) == 18
        start_append(stream, out, log).awaitTermination()
        return spark.read.parquet(out)

    batch = read_trips(spark, files)
    assert batch.count() == 6221
    first = run().select(*TRIPS.names)
    assert batch.exceptAll(first).isEmpty() and first.exceptAll(batch).isEmpty()

    (Path(files) / "late.csv").write_text(f"{HEADER}\n{GOOD}\n")
    assert run().count() == 6222
    assert run().count() == 6222


def test_fixture_totals(spark, small):
    trips = load_lineitem_trips(spark, small)
    assert trips.columns == TRIPS.names
    row = trips.selectExpr(
        "count(*) n", "sum(total_amount) total", "sum(trip_distance) miles"
    ).first()
    assert tuple(row) == (6221, 252768.0625, 42021.625)


def test_stream_on_an_interval(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(f"{HEADER}\n{GOOD}\n")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    query = start_append(stream_trips(spark, str(tmp_path / "in")), out, log, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 1
