"""Session settings for large runs, and the shared folder for intermediate data."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_MIB = 1024 * 1024


def cluster_conf(
    input_bytes: int, target_partition_bytes: int = 256 * _MIB, time_zone: str = "UTC"
) -> dict[str, str]:
    """Settings sized to the input: enough initial shuffle partitions for AQE to coalesce.

    The deduplication shuffle moves about the whole input, so its initial partition number
    follows from the input size; smaller shuffles are coalesced at run time.
    """
    partitions = max(-(-input_bytes // target_partition_bytes), 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": time_zone,
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files at ``path`` as they are stored; reads their listing only."""
    files = spark.read.format("binaryFile").load(path).select("length")
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def size_session(spark: SparkSession, path: str, time_zone: str = "UTC") -> None:
    """Apply ``cluster_conf`` for the input at ``path`` to the running session."""
    for key, value in cluster_conf(input_bytes(spark, path), time_zone=time_zone).items():
        spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A machine-local folder stands in only for a local master without that setting: on a
    cluster executors could not reach it, and it would go with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = os.path.join(tempfile.gettempdir(), "tripweave-scratch")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
