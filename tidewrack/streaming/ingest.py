"""Landing, bronze, quarantine and silver streams.

Bronze and quarantine are two sinks over one flag: a row goes to exactly one of them. Each
sink has its own checkpoint and stores every micro-batch as a batch of the lake, in the
layout of the batch jobs: a retried micro-batch replaces its own files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewrack import domain
from tidewrack.operators import dedupe, enrich, quality
from tidewrack.plans import medallion
from tidewrack.sources import lake as store
from tidewrack.sources.commits import PUBLISHED, QUARANTINED
from tidewrack.sources.lake import Lake


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def landing(payloads: DataFrame, lake: Lake, dataset: str) -> DataStreamWriter:
    """Exact payloads to the raw layer, by arrival hour."""
    rows = payloads.select("payload", "arrived_at", "seq")
    return _file_sink(rows, lake, "raw", dataset, "arrived_at", "landing")


def bronze(events: DataFrame, lake: Lake, dataset: str) -> DataStreamWriter:
    """Accepted rows to Parquet in their event-time hour, however late they are."""
    rows = enrich.enrich(quality.accepted_rows(events, dataset), F.col("arrived_at"))
    return _file_sink(rows, lake, "bronze", dataset, "event_ts", "bronze")


def quarantine(events: DataFrame, lake: Lake, dataset: str) -> DataStreamWriter:
    rows = quality.rejected_rows(events, dataset).withColumn(
        "quarantine_reason", F.lit("schema_or_quality")
    )
    return _file_sink(rows, lake, "quarantine", dataset, "arrived_at", "quarantine")


def distinct_events(events: DataFrame, dataset: str, horizon: str = domain.DEDUP_HORIZON) -> DataFrame:
    """Accepted rows without repeats inside the horizon.

    Validation comes first: otherwise an invalid copy would shadow a later valid one.
    The watermark bounds the id state.
    """
    rows = enrich.derive(quality.accepted_rows(events, dataset), F.col("arrived_at"))
    return rows.withWatermark("event_ts", horizon).dropDuplicatesWithinWatermark(["event_id"])


def batch_name(batch: DataFrame, name: str, batch_id: int) -> str:
    """A micro-batch's name in the lake: the query's name, the id that its checkpoint gives it, and its number.

    The same after a restart, another for a second query or a new checkpoint.
    """
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}-{run}-{batch_id}"


def deduplicated(events: DataFrame, lake: Lake, dataset: str) -> DataStreamWriter:
    """Accepted rows, one per id over the whole stored history, to a Parquet table.

    Unlike ``distinct_events``, which forgets ids after its horizon and loses rows later than
    that, this keeps every valid row however late it is.
    """
    table = f"{dataset}_distinct"
    rows = enrich.derive(quality.accepted_rows(events, dataset), F.col("arrived_at"))

    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, "distinct", batch_id)
        medallion.add_new_ids(batch.sparkSession, lake, "bronze", table, dedupe.keep_first(batch), "event_ts", name)

    return rows.writeStream.foreachBatch(write).option(
        "checkpointLocation", lake.checkpoint_path(f"distinct-{dataset}")
    )


def _silver_batch(lake: Lake, dataset: str, name: str, gate: float | None):
    """Writer of one micro-batch of events: valid rows, enriched, to masked silver."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, state = batch.sparkSession, PUBLISHED
        if gate is not None:
            score = quality.quality_report(batch, dataset).first()["score"]
            state = PUBLISHED if score >= gate else QUARANTINED
        rows = enrich.enrich(quality.accepted_rows(batch, dataset), F.col("arrived_at"))
        medallion.add_to_silver(
            spark, lake, dataset, dedupe.keep_first(rows), "event_ts", batch_name(batch, name, batch_id), state
        )

    return write


def silver(events: DataFrame, lake: Lake, dataset: str, gate: float | None = None) -> DataStreamWriter:
    """Masked silver, one row per id over the whole history.

    Inside a micro-batch the first copy wins; ids stored by other batches, of this or
    any other writer, are skipped. A retried micro-batch replaces its own rows. With ``gate``, micro-batches
    that score below it are quarantined.
    """
    write = _silver_batch(lake, dataset, "silver", gate)
    return events.writeStream.foreachBatch(write).option(
        "checkpointLocation", lake.checkpoint_path(f"silver-{dataset}")
    )


def daily_gold(events: DataFrame, lake: Lake, dataset: str, gate: float | None = None) -> DataStreamWriter:
    """Silver plus all six gold tables, kept up by the sums of each micro-batch.

    Late events correct older dates. Stored silver is not read again.
    """
    write_silver = _silver_batch(lake, dataset, "gold", gate)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_silver(batch, batch_id)
        medallion.publish_gold(batch.sparkSession, lake, dataset)

    return events.writeStream.foreachBatch(write).option(
        "checkpointLocation", lake.checkpoint_path(f"gold-{dataset}")
    )


def _file_sink(
    rows: DataFrame, lake: Lake, layer: str, dataset: str, time_column: str, name: str
) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch, lake, layer, dataset, time_column, batch_name(batch, name, batch_id))

    return rows.writeStream.foreachBatch(write).option(
        "checkpointLocation", lake.checkpoint_path(f"{name}-{dataset}")
    )
