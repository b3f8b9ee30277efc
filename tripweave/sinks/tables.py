"""Overwriting a table, a folder, or some partitions of either with a dataset."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.rules import told

_BUILT_IN = "spark_catalog"
_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def spread(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Even out the rows before a write, rows of one output partition together.

    Adaptive execution (on by default) splits a value with very many rows over several tasks,
    and lets small ones share a task.
    """
    return df.hint("rebalance", *partition_by)


def write_dataset(
    df: DataFrame,
    *,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    rebalance: bool = False,
) -> None:
    """Replace ``table`` or the folder ``path`` with ``df``, layout included.

    Rows are shuffled before the write only for ``partition_by`` or on ``rebalance``, which
    unevenly sized input needs; all else is written from the tasks that computed it. A table
    appears together with its comment and properties. A folder has no place for ``comment`` and ``properties``: giving them with
    ``path`` is an error.
    """
    if (table is None) == (path is None):
        raise ValueError("give either table or path")
    if path is not None and (comment is not None or properties):
        raise ValueError("a folder keeps no comment and no properties")
    rows = spread(df, partition_by) if partition_by or rebalance else df
    if path is None:
        _replace_table(rows, table, fmt, partition_by, comment, properties or {})
        return
    writer = rows.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_partitions(
    df: DataFrame,
    column: str,
    touched: Sequence[object],
    *,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    dealt: bool = False,
) -> None:
    """Replace the partitions ``touched`` of a stored dataset, and none but those, by ``df``.

    ``df`` holds rows of these values of ``column`` only; ``partition_by`` names all partition
    columns, ``column`` first (default: it alone). Each partition is replaced as a whole (of
    several columns: each combination that has rows). Touched values without rows end up empty.
    Their number is meant to be bounded, by the calendar for dates. A folder that is not there
    yet is made; a table must exist. Rows that are ``dealt`` by partition already are not
    shuffled again.
    """
    if (table is None) == (path is None):
        raise ValueError("give either table or path")
    columns = tuple(partition_by) or (column,)
    watch = Observation()
    rows = df.observe(watch, F.collect_set(F.col(column).cast("string")).alias("there"))
    rows = rows if dealt else spread(rows, columns)
    spark = df.sparkSession
    if path is not None:
        writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*columns).save(path)
    else:
        before = spark.conf.get(_DYNAMIC)
        spark.conf.set(_DYNAMIC, "dynamic")
        try:
            rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(_DYNAMIC, before)
    if len(columns) > 1:  # what a combination held before goes only where it has rows again
        return
    found = told(watch) or df.select(F.collect_set(F.col(column).cast("string")).alias("there")).first()
    for value in sorted({str(value) for value in touched} - set(found["there"])):
        if path is not None:
            df.drop(column).limit(0).write.format(fmt).mode("overwrite").save(f"{path}/{column}={value}")
        else:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = {_text(value)})")


def read_dataset(
    spark: SparkSession,
    like: DataFrame,
    *,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The stored dataset with the column order of ``like`` (stores put partition columns last)."""
    if table is not None:
        stored = spark.table(table)
    else:
        stored = spark.read.schema(like.schema).format(fmt).load(path)
    return stored.select(*like.columns)


def _replace_table(
    rows: DataFrame, table: str, fmt: str, partition_by: Sequence[str], comment: str | None, properties: Mapping[str, str]
) -> None:
    """One statement makes the table with all that describes it.

    Catalogs that can replace a table do so atomically. In the built-in one the old table is
    dropped first: a write that fails leaves no table, and never one without its description.
    """
    spark = rows.sparkSession
    *within, name = table.split(".")
    mark = f"rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(mark)
    parts = [f"USING {fmt}"]
    if partition_by:
        parts.append(f"PARTITIONED BY ({', '.join(partition_by)})")
    if comment is not None:
        parts.append(f"COMMENT {_text(comment)}")
    if properties:
        parts.append(f"TBLPROPERTIES ({', '.join(f'{_text(k)} = {_text(v)}' for k, v in properties.items())})")
    body = f"{' '.join(parts)} AS SELECT * FROM {mark}"
    catalog = within[0] if len(within) > 1 else spark.catalog.currentCatalog()
    try:
        if catalog != _BUILT_IN or spark.conf.get(f"spark.sql.catalog.{_BUILT_IN}", "builtin") != "builtin":
            spark.sql(f"CREATE OR REPLACE TABLE {table} {body}")
            return
        database = within[-1] if within else spark.catalog.currentDatabase()
        if f"Relation {_BUILT_IN}.{database}.{name}[" in rows._jdf.queryExecution().analyzed().toString():
            raise ValueError(f"{table} cannot be replaced by rows that are read from it")
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} {body}")
    finally:
        spark.catalog.dropTempView(mark)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
