"""Trip files: CSV in batch, with provenance that only a file scan can give."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.clock import stamp
from tripweave.schemas import TIME_FORMAT, TRIPS


# Name of the column for the text of a line that does not fit the layout; fixed for readers and rules.
RAW_LINE = "raw_line"
FITS_LAYOUT = {"fits_layout": f"{RAW_LINE} IS NULL"}


def csv_options(strict_header: bool = False) -> dict[str, str]:
    """Reader options of the trip layout.

    A fixed schema binds to CSV columns by position; ``strict_header`` makes a file whose
    header differs from the schema fail instead.
    """
    return {
        "header": "true",
        "timestampFormat": TIME_FORMAT,
        "timestampNTZFormat": TIME_FORMAT,
        "enforceSchema": str(not strict_header).lower(),
    }


def read_trips(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRIPS,
    strict_header: bool = False,
    keep_lines: bool = False,
) -> DataFrame:
    """Typed batch scan of CSV files, compressed or not.

    With ``keep_lines`` a line that does not fit the layout (a value of another type, too few or
    too many values) stands in ``RAW_LINE`` as it is in the file; its other columns hold what
    could be read. The column is NULL for lines that fit, and costs nothing where it is not used.
    """
    reader = spark.read.options(**csv_options(strict_header))
    if keep_lines:
        schema = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", RAW_LINE)
    return reader.schema(schema).csv(path)


def read_trips_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan with inferred types: costs one more pass, and types depend on the data."""
    return spark.read.options(header="true", inferSchema="true").csv(path)


def with_ingestion_metadata(
    df: DataFrame,
    environment: str = "",
    as_of: datetime | None = None,
    from_files: bool = True,
) -> DataFrame:
    """Add ingestion time, source file and environment.

    The file name resolves only directly on a file scan; other inputs get NULL.
    """
    source = F.col("_metadata.file_path") if from_files else F.lit(None).cast("string")
    return df.select(
        "*",
        stamp(as_of).alias("ingestion_timestamp"),
        source.alias("source_file"),
        F.lit(environment).alias("environment"),
    )
