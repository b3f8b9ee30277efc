"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.session import scratch_path

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
_SPACE = re.compile(rb"[\t-\r ]")
_RESIDENT: dict[Hashable, Any] = {}


def resident(owner: Hashable, build: Callable[[], Any]) -> Any:
    """What ``build`` gives, kept in this Python worker until another owner asks.

    Workers outlive their stage: without this the tables of one operator would stay in memory
    beside those of the next.
    """
    if owner not in _RESIDENT:
        _RESIDENT.clear()
        pa.default_memory_pool().release_unused()
        _RESIDENT[owner] = build()
    return _RESIDENT[owner]


def pieces(text: bytes, size: int = 1 << 18) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes; each but the last ends before ASCII white space."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + size) if at + size < len(text) else None
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: what is built on the result recomputes nothing before it, and a lost
    executor takes no part of it along.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shielded(df: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``df`` with only ``columns``, under names that nothing else has."""
    mark = uuid.uuid4().hex[:8]
    names = [f"{name}_{mark}" for name in columns]
    return df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True))), names


def blobs(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def content_key(*columns: str | Column) -> Column:
    """128 bits of a row's content: equal rows share it, others do not but by chance."""
    given = [F.col(c) if isinstance(c, str) else c for c in columns]
    shown = [F.coalesce(c.cast("string"), F.lit("\0null")) for c in given]
    joined = F.concat_ws("\0", *shown)
    return F.struct(
        F.xxhash64(*given).alias("a"), F.xxhash64(F.lit(7), F.crc32(joined), *given[::-1]).alias("b")
    )


def remainder(id_column: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)
