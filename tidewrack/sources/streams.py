"""Stream sources that yield ``payload, arrived_at, seq``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.schemas import RAW_SCHEMA
from tidewrack.sources.lake import is_folder


def payload_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON files of ``payload, arrived_at, seq`` as they appear in a folder."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def payload_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Kafka topic, newest records by default; offset is the arrival number.

    Needs Spark's Kafka connector on the class path.
    """
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**{"startingOffsets": "latest", **options})
        .load()
    )
    return source.select(
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("arrived_at"),
        # offsets repeat across partitions: put the partition in the high bits
        (F.shiftleft(F.col("partition").cast("bigint"), 48) + F.col("offset")).alias("seq"),
    )


def table_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream, whether it is stored as one file or as a folder."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
