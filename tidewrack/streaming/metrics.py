"""Windowed metrics, alerts and quality of a stream."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidewrack.operators import anomaly, quality
from tidewrack.plans.gate import decide
from tidewrack.sources import lake as store
from tidewrack.sources.commits import CommitLog, Conflict, Entry, new_attempt
from tidewrack.sources.lake import Lake


def _table(lake: Lake, name: str) -> str:
    return lake.path("gold", name)


def _days(log: CommitLog) -> tuple[int, dict[str, Entry], dict[str, Entry]]:
    """(version, entry of each stored day, entry of the last micro-batch of each stream)."""
    version, live = log.state()
    return version, {n: e for n, e in live.items() if not n.startswith("_")}, {n: e for n, e in live.items() if n.startswith("_")}


def _read_days(spark: SparkSession, lake: Lake, name: str, entries: list[Entry], schema: StructType | None = None) -> DataFrame | None:
    if not entries:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{_table(lake, name)}/{entry.path}" for entry in entries])


def read_table(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A stored table by day (``{dataset}_windows``, ``{dataset}_alerts``) as last published."""
    _, days, _ = _days(lake.log(spark, "gold", name))
    found = _read_days(spark, lake, name, list(days.values()))
    if found is None:
        raise FileNotFoundError(f"nothing is published in gold/{name}")
    return found


def _write_days(frame: DataFrame, lake: Lake, name: str) -> dict[str, Entry]:
    """Write rows by their window's day; gives the entries of the days, not yet published."""
    attempt = new_attempt()
    folder = f"{_table(lake, name)}/attempt={attempt}"
    by_day = frame.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    by_day.hint("rebalance", "day").write.partitionBy("day").parquet(folder)
    days = [path.getName().removeprefix("day=") for path in store.folders(frame.sparkSession, f"{folder}/day=*")]
    return {day: Entry(day, f"attempt={attempt}/day={day}") for day in days}


def _merged(stored: DataFrame) -> DataFrame:
    """Windows from their parts, which add up."""
    merged = stored.groupBy("window_start", "window_end").agg(
        *[F.sum(c).alias(c) for c in ("events", "identified", "revenue", "errors", "unusual")],
        F.max("max_lag_micros").alias("max_lag_micros"),
    )
    return merged.withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))


def _add_windows(batch: DataFrame, lake: Lake, name: str, dataset: str, width: str, batch_id: int) -> list[date]:
    """Add a micro-batch's window totals to those of the days it touches; gives these days.

    The days' new totals and the number of the micro-batch are published together, so a
    micro-batch that comes again after that is known and adds nothing.
    """
    spark = batch.sparkSession
    log, stream = lake.log(spark, "gold", name), f"_{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}"
    part_entries = _write_days(anomaly.window_totals(batch, dataset, width), lake, f"{name}_parts")
    part = _read_days(spark, lake, f"{name}_parts", list(part_entries.values()))
    touched = [date.fromisoformat(day) for day in part_entries]
    while part is not None:
        version, days, streams = _days(log)
        if stream in streams and int(streams[stream].path) >= batch_id:
            return touched
        held = _read_days(spark, lake, name, [days[day] for day in part_entries if day in days], part.schema)
        new = _write_days(_merged(part if held is None else held.unionByName(part)), lake, name)
        try:
            log.commit([*new.values(), Entry(stream, str(batch_id))], expected=version)
        except Conflict:
            continue
        break
    return touched


def window_totals(events: DataFrame, lake: Lake, dataset: str, width: str = "5 minutes") -> DataStreamWriter:
    """Tumbling counters per arrival window, right after every micro-batch however late rows are.

    A micro-batch reads the windows of the days it touches, not the parts that earlier ones brought.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _add_windows(batch, lake, f"{dataset}_windows", dataset, width, batch_id)

    return events.writeStream.foreachBatch(write).option(
        "checkpointLocation", lake.checkpoint_path(f"windows-{dataset}")
    )


def alerts(
    events: DataFrame, lake: Lake, dataset: str, width: str = "5 minutes", look_back_minutes: int = 10
) -> DataStreamWriter:
    """Alerts, one per window and metric, kept right by every micro-batch.

    Each micro-batch adds its window totals. The days it touched, and those whose baselines reach
    back to them, are judged again from the totals and replaced at once.
    Duplicate rate needs the history of all ids and stays with the batch job.
    """
    windows, name = f"{dataset}_alerts_windows", f"{dataset}_alerts"
    reach = [timedelta(days=n) for n in range(look_back_minutes // 1440 + 2)]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = _add_windows(batch, lake, windows, dataset, width, batch_id)
        if not days:
            return
        judged = {day + step for day in days for step in reach}
        needed = {str(day - step) for day in judged for step in reach}
        log = lake.log(spark, "gold", name)
        while True:
            version, alerted, _ = _days(log)
            _, stored, _ = _days(lake.log(spark, "gold", windows))
            totals = _read_days(spark, lake, windows, [entry for day, entry in stored.items() if day in needed])
            found = anomaly.detect(anomaly.with_baseline(anomaly.metrics_of(totals, dataset), look_back_minutes))
            mine = sorted(str(day) for day in judged)
            new = _write_days(found.filter(F.date_format("window_start", "yyyy-MM-dd").isin(mine)), lake, name)
            try:
                log.commit(new.values(), [day for day in mine if day in alerted and day not in new], version)
                return
            except Conflict:
                continue

    return events.writeStream.foreachBatch(write).option(
        "checkpointLocation", lake.checkpoint_path(f"alerts-{dataset}")
    )


def batch_quality(events: DataFrame, lake: Lake, dataset: str) -> DataStreamWriter:
    """One scorecard per micro-batch, with the publish decision and warning."""
    path = lake.report_path(f"{dataset}_stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        _replace(decide(quality.quality_report(batch, dataset)), path, batch_id)

    return events.writeStream.foreachBatch(write).option(
        "checkpointLocation", lake.checkpoint_path(f"quality-{dataset}")
    )


def _replace(frame: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's rows so that a retry replaces them."""
    (
        frame.withColumn("batch", F.lit(str(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )
