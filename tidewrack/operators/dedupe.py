"""Keep-first de-duplication and skip-existing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewrack.schemas import ARRIVAL_ORDER
from tidewrack.session import shared_folder

#: Most places or ids of dropped rows that are sent to every task; more are joined by a shuffle.
FEW = 500_000


def keep_first(
    frame: DataFrame,
    keys: Sequence[str] = ("event_id",),
    order: Sequence[str] = ARRIVAL_ORDER,
) -> DataFrame:
    """First record per key in arrival order.

    The ``= 1`` filter lets Spark apply a group limit before the shuffle, so each map
    task sends at most one row per key and a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        frame.withColumn("_position", F.row_number().over(window))
        .filter("_position = 1")
        .drop("_position")
    )


def drop_rows(rows: DataFrame, gone: DataFrame, on: Sequence[str]) -> tuple[DataFrame, bool]:
    """``rows`` without those that match ``gone`` (written), and whether they stay in their tasks.

    Keys may be null; null matches null.
    """
    count = gone.count()
    if not count:
        return rows, True
    named = gone.select(*[F.col(name).alias(f"_gone_{name}") for name in on])
    match = [F.col(name).eqNullSafe(F.col(f"_gone_{name}")) for name in on]
    return rows.join(F.broadcast(named) if count <= FEW else named, match, "left_anti"), count <= FEW


def keep_first_stored(stored: DataFrame, keys: Sequence[str] = ("event_id",), order: Sequence[str] = ARRIVAL_ORDER) -> tuple[DataFrame, bool]:
    """``keep_first`` of Parquet rows as read from their files, and whether they stay in the tasks that read them.

    Keys are counted first; then only the rows of repeated keys are put in order, by their places in the files. So
    whole rows are neither sorted nor shuffled unless very many are dropped. A hot key has one row per
    task and step.
    """
    spark = stored.sparkSession
    placed = stored.withColumns({"_file": F.xxhash64("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    path = shared_folder(spark, "repeated-keys")
    repeated = placed.groupBy(*keys).count().filter("count > 1").select(*keys)
    repeated.write.parquet(path)
    repeated = spark.read.schema(repeated.schema).parquet(path).select(*[F.col(key).alias(f"_again_{key}") for key in keys])
    again = [F.col(key).eqNullSafe(F.col(f"_again_{key}")) for key in keys]
    copies = placed.select(*keys, "_file", "_row", F.struct(*order, "_file", "_row").alias("_at")).join(repeated, again, "left_semi")
    first = copies.groupBy(*[F.col(key).alias(f"_again_{key}") for key in keys]).agg(F.min("_at").alias("_first"))
    path = shared_folder(spark, "later-copies")
    later = copies.join(first, again).filter("_at <> _first").select("_file", "_row")
    later.write.parquet(path)
    kept, in_place = drop_rows(placed, spark.read.schema(later.schema).parquet(path), ("_file", "_row"))
    return kept.drop("_file", "_row"), in_place


def skip_existing(incoming: DataFrame, existing: DataFrame, key: str = "event_id") -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(existing.select(key), key, "left_anti")
