"""Observed field profiles, schema differences and compatibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.schemas import declared_fields


def declared_profile(spark: SparkSession, version: int) -> DataFrame:
    rows = ", ".join(f"('{n}', '{t}', {str(r).lower()})" for n, t, r in declared_fields(version))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(field, type, required)")


def field_profile(raw: DataFrame) -> DataFrame:
    """Rows per (schema_version, field, JSON type) actually seen in the payloads.

    Counted by the variant's own type text first; the few distinct texts are then
    reduced to JSON types.
    """
    document = F.try_parse_json(F.col("payload"))
    exploded = (
        raw.select(
            F.try_variant_get(document, "$.schema_version", "int").alias("schema_version"),
            document.alias("document"),
        )
        .lateralJoin(
            raw.sparkSession.tvf.variant_explode(F.col("document").outer())
        )
        .select(
            "schema_version", F.col("key").alias("field"), F.schema_of_variant("value").alias("seen")
        )
    )
    return (
        exploded.groupBy("schema_version", "field", "seen")
        .agg(F.count(F.lit(1)).alias("records"))
        .groupBy("schema_version", "field", _json_type(F.col("seen")).alias("type"))
        .agg(F.sum("records").alias("records"))
    )


def _json_type(seen: Column) -> Column:
    name = F.split_part(F.split_part(seen, F.lit("("), F.lit(1)), F.lit("<"), F.lit(1))
    return (
        F.when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), F.lit("number"))
        .when(name == "VOID", F.lit("null"))
        .otherwise(F.lower(name))
    )


def dominant_types(profile: DataFrame, version: int, required: list[str]) -> DataFrame:
    """Per field of one version, its most frequent type; ``required`` names are declared."""
    return (
        profile.filter(F.col("schema_version") == version)
        .groupBy("field")
        .agg(F.max(F.struct("records", "type")).alias("top"))
        .select(
            "field",
            F.col("top.type").alias("type"),
            F.col("field").isin(*required).alias("required"),
        )
    )


def diff_fields(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per field that was added, removed or changed type."""
    joined = left.select(
        "field", F.col("type").alias("left_type"), F.col("required").alias("left_required")
    ).join(
        right.select(
            "field", F.col("type").alias("right_type"), F.col("required").alias("right_required")
        ),
        "field",
        "full",
    )
    change = (
        F.when(F.col("left_type").isNull(), F.lit("added"))
        .when(F.col("right_type").isNull(), F.lit("removed"))
        .when(F.col("left_type") != F.col("right_type"), F.lit("changed"))
    )
    return (
        joined.withColumn("change", change)
        .filter("change IS NOT NULL")
        .select(
            "field",
            "change",
            "left_type",
            "right_type",
            F.coalesce("right_required", "left_required").alias("required"),
        )
    )


def classify(diff: DataFrame, strict: bool = True) -> DataFrame:
    """One-row compatibility class of a diff.

    ``strict``: any added or removed required field, or a type change, is BREAKING.
    Otherwise only-added-required counts as BACKWARD and only-removed-required as FORWARD.
    """
    counted = diff.agg(
        *[
            F.count_if(condition).alias(name)
            for name, condition in {
                "added": F.col("change") == "added",
                "removed": F.col("change") == "removed",
                "changed": F.col("change") == "changed",
                "added_required": (F.col("change") == "added") & F.col("required"),
                "removed_required": (F.col("change") == "removed") & F.col("required"),
            }.items()
        ]
    )
    added, removed = F.col("added"), F.col("removed")
    added_required, removed_required = F.col("added_required"), F.col("removed_required")
    breaking = F.col("changed") > 0
    if strict:
        breaking = breaking | (added_required > 0) | (removed_required > 0)
    else:
        breaking = breaking | ((added_required > 0) & (removed_required > 0))
    compatibility = (
        F.when(breaking, F.lit("BREAKING"))
        .when(added + removed == 0, F.lit("FULLY COMPATIBLE"))
        .when(added_required > 0, F.lit("BACKWARD COMPATIBLE"))
        .when(removed_required > 0, F.lit("FORWARD COMPATIBLE"))
        .when(removed == 0, F.lit("BACKWARD COMPATIBLE"))
        .otherwise(F.lit("FORWARD COMPATIBLE"))
    )
    return counted.select("added", "removed", "changed", compatibility.alias("compatibility"))


def union_versions(frames: list[DataFrame]) -> DataFrame:
    """Union of frames of different versions; fields a version lacks become null."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def field_set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("field").exceptAll(right.select("field"))
