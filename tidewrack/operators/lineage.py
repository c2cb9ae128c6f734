"""Which layers each raw record reached, and what stands behind a gold cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.operators.gold import gold_amount
from tidewrack.functions.values import money


def trace(raw: DataFrame, bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Per raw record: bronze, silver and quarantine presence and its reasons.

    Layers are stacked and brought together once, by arrival time and number, which together are unique per record.
    """
    none = F.lit(None).cast("array<string>")

    def rows(layer: DataFrame, name: str, event_id: Column, reasons: Column) -> DataFrame:
        return layer.select("arrived_at", "seq", F.lit(name).alias("layer"), event_id.alias("event_id"), reasons.alias("reasons"))

    empty = F.lit(None).cast("string")
    stacked = rows(raw, "raw", F.col("event_id"), none)
    for layer, name in ((bronze, "bronze"), (silver, "silver")):
        stacked = stacked.unionByName(rows(layer, name, empty, none))
    stacked = stacked.unionByName(rows(quarantine, "quarantine", empty, F.col("reasons")))
    traced = stacked.groupBy("arrived_at", "seq").agg(
        F.max("event_id").alias("event_id"),
        F.bool_or(F.col("layer") == "raw").alias("in_raw"),
        *[F.bool_or(F.col("layer") == name).alias(f"in_{name}") for name in ("bronze", "silver", "quarantine")],
        F.max("reasons").alias("reasons"),
    )
    return traced.filter("in_raw").select("arrived_at", "seq", "event_id", "in_bronze", "in_silver", "in_quarantine", "reasons")


def lineage_summary(traced: DataFrame) -> DataFrame:
    """Records per arrival day and combination of layers reached."""
    return traced.groupBy(
        F.to_date("arrived_at").alias("arrival_date"),
        "in_bronze",
        "in_silver",
        "in_quarantine",
        F.array_join(F.coalesce("reasons", F.array().cast("array<string>")), "; ").alias("reasons"),
    ).agg(F.count(F.lit(1)).alias("records"))


def rows_behind(silver: DataFrame, cell: DataFrame, key: str) -> DataFrame:
    """Silver rows whose key is in ``cell``."""
    return silver.join(cell.select(key), key, "left_semi")


def reconcile(silver: DataFrame, gold: DataFrame, key: Column, name: str) -> DataFrame:
    """Recompute each gold cell from silver; ``difference`` is 0 when they agree."""
    recomputed = silver.groupBy(key.alias(name)).agg(
        F.count(F.lit(1)).alias("silver_rows"), money(F.sum(gold_amount())).alias("silver_volume")
    )
    return recomputed.join(gold, name, "full").select(
        name,
        "silver_rows",
        "transactions",
        "silver_volume",
        "volume",
        money(F.coalesce("silver_volume", F.lit(0)) - F.coalesce("volume", F.lit(0))).alias("difference"),
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per arrival day and layer, as one row per day with the balance check."""
    tagged = None
    for name, frame in layers.items():
        part = frame.select(F.to_date("arrived_at").alias("arrival_date"), F.lit(name).alias("layer"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = tagged.groupBy("arrival_date").agg(
        *[F.count_if(F.col("layer") == name).alias(name) for name in layers]
    )
    return counts.withColumn(
        "difference", F.col("raw") - F.col("bronze") - F.col("quarantine")
    )
