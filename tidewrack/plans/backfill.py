"""Replay of raw partitions over a day range, resumable by a ledger."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions.calendar import expand_days
from tidewrack.operators import dedupe, quality
from tidewrack.plans import medallion
from tidewrack.session import shared_folder
from tidewrack.sources import lake as store
from tidewrack.sources.commits import PUBLISHED, QUARANTINED
from tidewrack.sources.lake import Lake

LEDGER_SCHEMA = "dataset string, day date, records bigint, skipped bigint, run string"


def plan(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day, both ends included."""
    if date.fromisoformat(end) < date.fromisoformat(start):
        raise ValueError("the last day must be on or after the first day")
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return expand_days(bounds, "first_day", "last_day")


def plan_of(events: DataFrame) -> DataFrame:
    """Every day between the first and the last arrival of a frame."""
    bounds = events.agg(
        F.to_date(F.min("arrived_at")).alias("first_day"),
        F.to_date(F.max("arrived_at")).alias("last_day"),
    )
    return expand_days(bounds, "first_day", "last_day")


def pending(days: DataFrame, ledger: DataFrame) -> DataFrame:
    """Planned days without a ledger row."""
    return days.join(ledger.select("day").distinct(), "day", "left_anti")


def read_ledger(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    path = lake.ledger_path(dataset)
    if not store.exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def status(days: DataFrame, ledger: DataFrame) -> DataFrame:
    """Checkpoint of a range: days done, next day, records, skipped, state."""
    joined = days.join(ledger, "day", "left")
    return joined.agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count_if(F.col("run").isNotNull()).alias("days_done"),
        F.min(F.when(F.col("run").isNull(), F.col("day"))).alias("next_day"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records"),
        F.coalesce(F.sum("skipped"), F.lit(0)).cast("bigint").alias("skipped"),
    ).withColumn(
        "status",
        F.when(F.col("next_day").isNull(), F.lit("completed")).otherwise(F.lit("running")),
    )


def run(
    spark: SparkSession, lake: Lake, dataset: str, start: str, end: str, dry_run: bool = False,
    gate: float | None = None,
) -> DataFrame:
    """Process the days of the range that the ledger lacks, as one distributed job.

    All layers are brought up to raw: records that bronze or quarantine lacks are stored,
    silver, gold and the quality report follow. Records another batch or
    stream has stored stay where they are, so nothing is doubled. Raw folders outside the
    range are not read. Rows of batches that the gate has quarantined stay out. With ``gate``, a range that
    scores below it is quarantined like any batch. The ledger is written last: after a failure the range is replayed,
    also under other dates.
    """
    days = plan(spark, start, end)
    ledger = read_ledger(spark, lake, dataset)
    if dry_run:
        return status(days, ledger)
    todo = pending(days, ledger)
    span = todo.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    if span["a"] is not None:
        _run_days(spark, lake, dataset, todo, str(span["a"]), str(span["b"]), gate)
    return status(days, read_ledger(spark, lake, dataset))


def _between(first: str, last: str) -> Column:
    return (F.col("arrived_at") >= F.to_timestamp(F.lit(first))) & (
        F.col("arrived_at") < F.to_timestamp(F.date_add(F.lit(last).cast("date"), 1))
    )


def _arrived(spark: SparkSession, lake: Lake, layer: str, dataset: str, first: str, last: str, without: str) -> DataFrame:
    """Arrival time and number of a layer's rows that arrived in the range, of all batches but one."""
    entries = [e for e in store.live_entries(spark, lake, layer, dataset) if e.batch != without]
    rows = store.read_entries(spark, lake, layer, dataset, entries, "arrived_at TIMESTAMP, seq BIGINT")
    return rows.filter(_between(first, last)).select("arrived_at", "seq")


def _run_days(
    spark: SparkSession, lake: Lake, dataset: str, todo: DataFrame, first: str, last: str, gate: float | None
) -> None:
    # raw is stored by arrival, so its batches' day ranges say which to open
    events = store.read_raw(spark, lake, dataset, store.partition_hours(first, last), first, last)
    # one row per calendar day of the range, so the broadcast is bounded by its length
    events = events.join(
        F.broadcast(todo.select(F.col("day").alias("_day"))),
        F.to_date("arrived_at") == F.col("_day"),
        "left_semi",
    )
    # stable name: a repeated range replaces its own files instead of adding to them
    batch_id = f"backfill-{first}-{last}"
    missing = events
    for layer in ("bronze", "quarantine"):
        missing = missing.join(_arrived(spark, lake, layer, dataset, first, last, batch_id), ["arrived_at", "seq"], "left_anti")
    # what is missing is stored first: both layers below are decided by it
    folder = f"{shared_folder(spark, 'backfill')}/missing"
    missing.write.parquet(folder)
    missing = spark.read.parquet(folder)
    store.write_batch(
        medallion.bronze(missing, dataset, F.col("arrived_at")), lake, "bronze", dataset, "ingested_at", batch_id
    )
    store.write_batch(
        quality.rejected_rows(missing, dataset), lake, "quarantine", dataset, "arrived_at", batch_id
    )
    report = quality.quality_report(events, dataset)
    store.write_report(report, lake, dataset)
    score = spark.read.schema(report.schema).json(lake.report_path(dataset)).first()["score"]
    state = PUBLISHED if gate is None or score >= gate else QUARANTINED
    # of all bronze rows of the days: a batch may have failed between bronze and silver. What the
    # gate has turned away stays away
    silver = lake.log(spark, "silver", dataset).live()
    barred = {name for name, entry in silver.items() if entry.state == QUARANTINED and name != batch_id}
    entries = [e for e in store.live_entries(spark, lake, "bronze", dataset) if e.batch not in barred]
    if entries:
        fresh = store.read_entries(spark, lake, "bronze", dataset, entries).filter(_between(first, last))
        fresh = medallion.without_folders(fresh.join(
            F.broadcast(todo.select(F.col("day").alias("_day"))), F.to_date("arrived_at") == F.col("_day"), "left_semi"
        ))
        medallion.add_to_silver(spark, lake, dataset, dedupe.keep_first(fresh), "ingested_at", batch_id, state)
    medallion.publish_gold(spark, lake, dataset)

    def stored_per_day(layer: str, name: str) -> DataFrame:
        entries = store.live_entries(spark, lake, layer, dataset)
        stored = store.read_entries(spark, lake, layer, dataset, entries, "arrived_at TIMESTAMP").filter(_between(first, last))
        return stored.groupBy(F.to_date("arrived_at").alias("day")).agg(
            F.count(F.lit(1)).alias(name)
        )

    done = (
        todo.join(stored_per_day("bronze", "accepted"), "day", "left")
        .join(stored_per_day("silver", "records"), "day", "left")
        .select(
            F.lit(dataset).alias("dataset"),
            "day",
            F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
            (F.coalesce("accepted", F.lit(0)) - F.coalesce("records", F.lit(0)))
            .cast("bigint")
            .alias("skipped"),
            F.lit(uuid.uuid4().hex).alias("run"),
        )
    )
    done.coalesce(1).write.mode("append").parquet(lake.ledger_path(dataset))
