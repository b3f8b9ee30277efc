"""Settings of one pipeline run."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import datetime
from typing import ClassVar

from pyspark.sql import SparkSession


def get_config(spark: SparkSession, key: str, default: str | None = None) -> str | None:
    """Session setting ``key``, or ``default`` when it is unset or cannot be read."""
    try:
        value = spark.conf.get(key, default)
    except Exception:
        return default
    return default if value is None else value


def table_path(catalog: str, schema: str, table: str) -> str:
    """Three-part table name."""
    return ".".join((catalog, schema, table))


@dataclass(frozen=True)
class PipelineConfig:
    """Where trips come from, where datasets go and what is stamped on them.

    ``output_path`` stores every dataset below one folder; without it datasets become
    tables of ``catalog.schema``. ``time_zone`` decides on which date a zoned time falls. ``as_of`` fixes the clock columns (default: query time).
    """

    catalog: str = "spark_catalog"
    schema: str = "trips_dev"
    source_path: str = ""
    environment: str = ""
    time_zone: str = "UTC"
    output_path: str | None = None
    table_format: str = "parquet"
    as_of: datetime | None = None

    # The session keys the settings are read from.
    SESSION_KEYS: ClassVar[dict[str, str]] = {
        "catalog": "catalog_name",
        "schema": "schema_name",
        "source_path": "source_path",
        "environment": "environment_suffix",
    }

    @classmethod
    def from_session(cls, spark: SparkSession, **overrides) -> PipelineConfig:
        """Read the session keys; explicit ``overrides`` win."""
        found = {
            name: get_config(spark, key, getattr(cls, name))
            for name, key in cls.SESSION_KEYS.items()
        }
        return cls(**{**found, **overrides})

    def table(self, name: str) -> str:
        return table_path(self.catalog, self.schema, name)

    def describe(self) -> str:
        """Printable settings, one per line."""
        return "\n".join(f"{f.name:<13} {getattr(self, f.name)}" for f in fields(self))
