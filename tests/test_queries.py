"""Every registered query against its SQL twin in another engine, over whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from tripweave import oracle, queries

QUERIES, ORACLES = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def engine(small):
    connection = duckdb.connect()
    for table in Path(small).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, engine, small, name):
    found = QUERIES[name](spark, small).toArrow()
    wanted = engine.sql(ORACLES[name]).to_arrow_table()
    assert sorted((f.name, str(f.type)) for f in found.schema) == sorted(
        (f.name, str(f.type)) for f in wanted.schema
    )
    assert found.num_rows == wanted.num_rows > 0
    columns = ", ".join(f'"{column}"' for column in found.column_names)
    engine.register("found", found)
    engine.register("wanted", wanted)
    for left, right in (("found", "wanted"), ("wanted", "found")):
        extra = engine.execute(
            f"SELECT {columns} FROM {left} EXCEPT ALL SELECT {columns} FROM {right}"
        ).fetchall()
        assert not extra, (left, extra[:3])


def test_entry(spark):
    kpis = registered.entry(spark)
    assert kpis.count() == 2105 and "trips_change_pct" in kpis.columns
