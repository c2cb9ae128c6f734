"""Key distribution, partition counts and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.calendar import PARTITION_COLUMNS
from tidewrack.sources.wire import stream_key


def distribute(events: DataFrame, dataset: str, partitions: int, salts: int = 1) -> DataFrame:
    """Spread records over partitions by stream key.

    ``salts`` > 1 splits every key over that many partitions, for keys too hot for one.
    """
    if salts <= 1:
        return events.repartition(partitions, stream_key(dataset))
    return events.repartition(partitions, stream_key(dataset), F.pmod(F.xxhash64("seq"), F.lit(salts)))


#: Parts of a mean partition that a hot key is cut into, and the most keys a sketch tracks for each partition.
SALTS_PER_PARTITION, TRACKED = 32, 16


def heavy_keys(events: DataFrame, dataset: str, partitions: int) -> dict[str, int]:
    """Stream keys with about half a mean partition of records or more, and their approximate counts.

    Found by Spark's mergeable sketch of frequent items: tasks send sketches of bounded size. A key with
    that many records is never missed, and there are at most twice as many as partitions.
    """
    tracked = partitions * TRACKED
    found = events.agg(
        F.count(F.lit(1)).alias("records"),
        F.call_function("approx_top_k", stream_key(dataset), F.lit(2 * partitions), F.lit(tracked)).alias("top"),
    ).first()
    least = found["records"] / (2 * partitions)
    return {row["item"]: row["count"] for row in found["top"] if row["count"] >= least and row["item"] is not None}


def distribute_adaptively(events: DataFrame, dataset: str, partitions: int) -> DataFrame:
    """Spread records over partitions by stream key; hot keys get salts by their share, other keys stay whole."""
    mean = max(1.0, events.count() / partitions)
    salts = {key: max(2, round(count / mean * SALTS_PER_PARTITION)) for key, count in heavy_keys(events, dataset, partitions).items()}
    salt = F.lit(0)
    if salts:
        # two entries a partition at most
        known = F.create_map(*[F.lit(part) for pair in salts.items() for part in pair])
        salt = F.coalesce(F.pmod(F.xxhash64("seq"), F.try_element_at(known, stream_key(dataset))).cast("int"), F.lit(0))
    return events.repartition(partitions, stream_key(dataset), salt)


def key_distribution(events: DataFrame, dataset: str, k: int = 20) -> DataFrame:
    """The k heaviest stream keys and their record counts."""
    return (
        events.groupBy(stream_key(dataset).alias("stream_key"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "stream_key")
        .limit(k)
    )


def partition_counts(frame: DataFrame) -> DataFrame:
    return frame.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("records"))


def retention_days(layer: str, profile: str = "dev") -> int | None:
    days = domain.RAW_RETENTION_DAYS[profile]
    if layer == "raw":
        return days
    return min(domain.QUARANTINE_RETENTION_CAP_DAYS, days) if layer == "quarantine" else None


def live_rows(frame: DataFrame, layer: str, as_of: Column, profile: str = "dev", time: str = "arrived_at") -> DataFrame:
    """Rows inside the layer's retention; every row where the layer never expires."""
    days = retention_days(layer, profile)
    if days is None:
        return frame
    return frame.filter(F.to_date(F.col(time)) >= F.date_sub(F.to_date(as_of), days))


def expired_days(frame: DataFrame, layer: str, as_of: Column, profile: str = "dev", time: str = "arrived_at") -> DataFrame:
    """Days past retention with their row counts: the partitions to drop."""
    days = retention_days(layer, profile)
    limit = F.date_sub(F.to_date(as_of), days) if days is not None else F.lit(None).cast("date")
    return (
        frame.filter(F.to_date(F.col(time)) < limit)
        .groupBy(F.to_date(F.col(time)).alias("day"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
