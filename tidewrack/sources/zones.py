"""Zone tables: which stretch of time each stored file holds.

Layers with little data per hour are stored packed: a batch is ranged by time over files of ordinary
size instead of a folder for every hour, and a table beside it has one row per file with its first
and last time. A read of some hours opens the files that overlap them, without listing folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "batch string, file string, first timestamp, last timestamp, untimed bigint, records bigint"


def ranged(rows: DataFrame, time_column: str) -> DataFrame:
    """Rows dealt over tasks by batch and time.

    Bounds come from a sample and AQE merges small ranges, so a hot hour has many files and quiet
    hours share one. A hash breaks ties: one instant may hold any share of the rows.
    """
    tie = F.xxhash64(*[c for c in ("seq", "event_id") if c in rows.columns] or [time_column])
    return rows.withColumn("_tie", tie).repartitionByRange("batch", time_column, "_tie").drop("_tie").sortWithinPartitions("batch", time_column)


def write(spark: SparkSession, folder: str, target: str, time_column: str) -> None:
    """Store the zones of the files in an attempt's folder; reads the one column, combined per file on the map side."""
    files = spark.read.parquet(folder).select("batch", F.col("_metadata.file_path").alias("file"), F.col(time_column).cast("timestamp").alias("at"))
    zones = files.groupBy("batch", "file").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count_if(F.col("at").isNull()).alias("untimed"), F.count(F.lit(1)).alias("records")
    )
    zones.hint("rebalance").write.parquet(target)


def read(spark: SparkSession, targets: Iterable[str]) -> DataFrame:
    targets = list(targets)
    return spark.read.schema(SCHEMA).parquet(*targets) if targets else spark.createDataFrame([], SCHEMA)


def overlapping(zones: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """Zones of files that may hold rows from ``since`` on and before ``until``."""
    return zones.filter((F.col("last") >= F.lit(since)) & (F.col("first") < F.lit(until)))
