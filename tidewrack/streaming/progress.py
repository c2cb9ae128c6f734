"""Progress of streams as a table: rates, how far a source is behind, rows dropped as too late."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tidewrack.sources.commits import CommitLog
from tidewrack.sources.lake import Lake, exists

PROGRESS_SCHEMA = (
    "query string, run string, batch bigint, at string, input_rows bigint, input_rows_per_second double, processed_rows_per_second double, "
    "offsets_behind bigint, dropped_by_watermark bigint, watermark string, duration_ms bigint"
)


def _offsets(text: str | dict | None) -> dict[str, int]:
    """Positions in a source, by partition: of topics, or the one of a file source."""
    try:
        found = json.loads(text) if isinstance(text, str) else text
    except ValueError:  # a source that doesn't tell writes no JSON
        return {}
    if isinstance(found, int):
        return {"": found}
    positions = {}
    for name, value in (found or {}).items():
        if isinstance(value, dict):
            positions |= {f"{name}/{partition}": at for partition, at in value.items()}
        elif isinstance(value, int):
            positions[name] = value
    return positions


def offsets_behind(latest: str | dict | None, reached: str | dict | None) -> int | None:
    """Records (or files) between what a source has and what was read; None where it doesn't say."""
    newest, read = _offsets(latest), _offsets(reached)
    if not newest:
        return None
    return sum(max(0, at - read.get(name, 0)) for name, at in newest.items())


class ProgressLog(StreamingQueryListener):
    """Stores one row for every micro-batch of the session's streams. Start it with ``spark.streams.addListener``.

    A row is a small file named after run and batch, written without a Spark job: a listener must not hold streams up.
    """

    def __init__(self, spark: SparkSession, lake: Lake) -> None:
        self.log = CommitLog(spark, f"{lake.root.rstrip('/')}/_progress")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        behind = [offsets_behind(source.latestOffset, source.endOffset) for source in progress.sources]
        row = {
            "query": progress.name or str(progress.id), "run": str(progress.runId), "batch": progress.batchId, "at": progress.timestamp,
            "input_rows": progress.numInputRows, "input_rows_per_second": progress.inputRowsPerSecond,
            "processed_rows_per_second": progress.processedRowsPerSecond,
            "offsets_behind": sum(b for b in behind if b is not None) if any(b is not None for b in behind) else None,
            "dropped_by_watermark": sum(state.numRowsDroppedByWatermark for state in progress.stateOperators),
            "watermark": progress.eventTime.get("watermark"), "duration_ms": progress.batchDuration,
        }
        self.log.publish(f"{row['run']}-{row['batch']:012d}-{progress.timestamp.replace(':', '')}.progress", row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, lake: Lake) -> DataFrame:
    path = f"{lake.root.rstrip('/')}/_progress"
    if not exists(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).option("pathGlobFilter", "*.progress").json(path)


def wait_for(spark: SparkSession, lake: Lake, batches: int, seconds: float = 30.0) -> None:
    """Wait until progress of so many micro-batches with input is stored: listeners hear of it a little later."""
    until = time.monotonic() + seconds
    while time.monotonic() < until:
        if read_progress(spark, lake).filter("input_rows > 0").count() >= batches:
            return
        time.sleep(0.2)
    raise TimeoutError(f"progress of {batches} batches is not there after {seconds} s")
