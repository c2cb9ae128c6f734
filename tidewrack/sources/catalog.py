"""Named tables for SQL: ``layer_dataset`` temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewrack import domain
from tidewrack.sources import lake as store
from tidewrack.sources.lake import Lake


def register(tables: dict[str, DataFrame]) -> None:
    """Register ``layer_dataset`` views and their aliases."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    for alias, target in domain.TABLE_ALIASES.items():
        if target in tables:
            tables[target].createOrReplaceTempView(alias)


def register_gold(gold: dict[str, DataFrame], silver: DataFrame | None = None) -> None:
    tables = {f"gold_{name}": frame for name, frame in gold.items()}
    if silver is not None:
        tables["silver_transactions"] = silver
    register(tables)


def register_lake(spark: SparkSession, lake: Lake, datasets: list[str]) -> list[str]:
    """Register what a lake has stored as ``bronze_``, ``silver_`` and ``gold_`` views.

    Gold views hold all datasets, told apart by their column ``dataset``.
    """
    tables = {
        f"{layer}_{name}": store.read_layer(spark, lake, layer, name)
        for layer in ("bronze", "silver")
        for name in datasets
        if store.stored_layer(spark, lake, layer, name)
    }
    for name in domain.GOLD_DATASETS:
        frame = store.read_gold_datasets(spark, lake, name)
        if frame is not None:
            tables[f"gold_{name}"] = frame
    register(tables)
    return sorted(tables)
