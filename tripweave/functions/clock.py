"""Time expressions for both zoned (``timestamp``) and wall-clock (``timestamp_ntz``) columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.schemas import TIME_FORMAT


def stamp(as_of: datetime | None) -> Column:
    """The given processing time, or the time of the query."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def whole_seconds(df: DataFrame, name: str) -> Column:
    """Seconds since the epoch, rounded down.

    Wall-clock columns are not cast to ``timestamp`` for this: the difference of two of them
    would depend on the session zone's daylight saving.
    """
    if not isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.unix_seconds(name)
    micros = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', {name})"
    return F.expr(f"floor({micros} / 1000000)")


def minutes_between(df: DataFrame, start: str, end: str) -> Column:
    """Minutes from ``start`` to ``end``, each cut to whole seconds first."""
    return (whole_seconds(df, end) - whole_seconds(df, start)) / 60


def parse_time(name: str) -> Column:
    """Time of a text column; unparsable text becomes NULL, times pass through."""
    return F.try_to_timestamp(F.col(name), F.lit(TIME_FORMAT))
