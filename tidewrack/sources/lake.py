"""Layer folders: writers that publish whole batches, and readers of what is published.

Rows of a write lie in ``root/layer/dataset/attempt=/batch=/year=/month=/day=/hour=``, where the
attempt is new for every write. The layer's commit log names the folders that count.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.calendar import PARTITION_COLUMNS, with_partitions
from tidewrack.schemas import GOLD_SCHEMAS, RAW_SCHEMA
from tidewrack.session import shuffles_dropped
from tidewrack.sources import zones
from tidewrack.sources.commits import PUBLISHED, QUARANTINED, CommitLog, Conflict, Entry, new_attempt
from tidewrack.sources.wire import parse_payloads

_JSON_LAYERS = ("raw", "quarantine")
# microseconds survive; the JSON default keeps milliseconds only
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: Stored text repeats its field names in every row and attempts stay until ``vacuum``: compressed it takes an eighth. Readers
#: tell by a file's name, so plain files stored before are read as well.
_TEXT_CODEC = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: A compressed file is read by one task, so it ends after so many rows.
TEXT_FILE_ROWS = 100_000


@dataclass(frozen=True)
class Lake:
    """Layers of datasets below a root, on storage all executors share.

    ``grain`` "day" leaves out the hour folders, for datasets with little data per hour. ``packed`` leaves out
    all time folders of Parquet layers: hours share files, found by the zone table; JSON layers have day folders.
    It is chosen when a lake is made; ``compact`` turns stored Parquet batches over.
    """

    root: str
    grain: str = "hour"
    packed: bool = False

    @property
    def partitions(self) -> tuple[str, ...]:
        return PARTITION_COLUMNS[: PARTITION_COLUMNS.index(self.grain) + 1]

    def stored_partitions(self, layer: str) -> tuple[str, ...]:
        """The time folders that a write makes."""
        if not self.packed:
            return self.partitions
        return PARTITION_COLUMNS[:3] if layer in _JSON_LAYERS else ()

    def zones_path(self, layer: str, dataset: str, attempt: str) -> str:
        return f"{self.root.rstrip('/')}/_zones/{layer}/{dataset}/attempt={attempt}"

    def path(self, layer: str, dataset: str) -> str:
        if layer not in domain.LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{dataset}"

    def report_path(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/quality/{dataset}"

    def ledger_path(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/ledger/{dataset}"

    def log(self, spark: SparkSession, layer: str, dataset: str) -> CommitLog:
        return CommitLog(spark, f"{self.root.rstrip('/')}/_log/{layer}/{dataset}")

    def checkpoint_path(self, query: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{query}"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(hadoop_path)


def folders(spark: SparkSession, pattern: str) -> list:
    """Stored folders that match a pattern; lists names only."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath() for status in system.globStatus(hadoop_path) or []]


def clear(spark: SparkSession, pattern: str) -> None:
    """Delete the folders that match a pattern."""
    for path in folders(spark, pattern):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(hadoop_path) and system.getFileStatus(hadoop_path).isDirectory()


def layer_format(layer: str) -> str:
    return "json" if layer in _JSON_LAYERS else "parquet"


def layer_options(layer: str) -> dict[str, str]:
    return {**JSON_OPTIONS, **_TEXT_CODEC, "maxRecordsPerFile": str(TEXT_FILE_ROWS)} if layer in _JSON_LAYERS else {}


def store_rows(
    rows: DataFrame, lake: Lake, layer: str, dataset: str, time_column: str, gather: bool = True, attempt: str | None = None,
    batches: list[str] | None = None,
) -> dict[str, Entry]:
    """Write rows, which have a column ``batch``, to an attempt of their own. Nobody reads it until it is published.

    ``gather`` brings rows of a partition together first, by a rebalance that keeps files near
    the advisory size: hours with little data share a task, a hot hour is split over many.
    Without it the rows are written where they are; right for rows read from a layer that has the
    same partitions. Row count and day range are observed while writing, per name in ``batches``
    (else only whether rows came is known, from the folders).
    """
    attempt = attempt or new_attempt()
    folder = f"{lake.path(layer, dataset)}/attempt={attempt}"
    stored = lake.stored_partitions(layer)
    packed_by = time_column if lake.packed and layer not in _JSON_LAYERS else None
    rows = with_partitions(rows.drop(*lake.partitions), time_column, stored)
    if gather:
        rows = zones.ranged(rows, time_column) if packed_by else rows.hint("rebalance", "batch", *stored)
    seen = Observation()
    day = F.to_date(time_column)
    counts = []
    for number, name in enumerate(batches or []):
        own = F.col("batch") == name
        counts += [F.count_if(own).alias(f"rows{number}"), F.min(F.when(own, day)).cast("string").alias(f"first{number}"), F.max(F.when(own, day)).cast("string").alias(f"last{number}")]
    if counts:
        rows = rows.observe(seen, *counts)
    with shuffles_dropped(rows.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .options(**layer_options(layer))
            .partitionBy("batch", *stored)
            .format(layer_format(layer))
            .save(folder)
        )
    found = []
    if packed_by or not counts:
        found = [path.getName().removeprefix("batch=") for path in folders(rows.sparkSession, f"{folder}/batch=*")]
    if packed_by and found:
        zones.write(rows.sparkSession, folder, lake.zones_path(layer, dataset, attempt), time_column)
    if not counts:
        return {name: Entry(name, f"attempt={attempt}/batch={name}", packed_by=packed_by) for name in found}
    got = seen.get
    return {
        name: Entry(name, f"attempt={attempt}/batch={name}" if got[f"rows{i}"] else "", PUBLISHED, got[f"rows{i}"], got[f"first{i}"], got[f"last{i}"], packed_by=packed_by)
        for i, name in enumerate(batches)
    }


def checked_name(batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r} is not a plain folder name")
    return batch_id


def write_batch(
    frame: DataFrame,
    lake: Lake,
    layer: str,
    dataset: str,
    time_column: str,
    batch_id: str,
    gather: bool = True,
) -> Entry:
    """Store one batch and publish it; a repeat replaces what the batch published before, at once.

    Readers see the old batch or the new one. The old files stay until ``vacuum`` takes them.
    Streams store their micro-batches the same way.
    """
    rows = frame.withColumn("batch", F.lit(checked_name(batch_id)))
    entry = store_rows(rows, lake, layer, dataset, time_column, gather, batches=[batch_id])[batch_id]
    lake.log(frame.sparkSession, layer, dataset).commit([entry])
    return entry


def overwrite_partitions(
    frame: DataFrame, lake: Lake, layer: str, dataset: str, time_column: str
) -> None:
    """Replace the partitions present in ``frame``; others stay.

    Rows of a replaced partition are carried by the batch ``rewritten-`` of the day range; batches that
    hold other partitions as well are written anew without the replaced ones.
    """
    spark = frame.sparkSession
    log = lake.log(spark, layer, dataset)
    version, live = log.state()
    fresh = with_partitions(frame.drop("batch", "attempt"), time_column, lake.partitions)
    # calendar folders of the frame: bounded by time, not by rows
    replaced = fresh.select(*lake.partitions).distinct()
    kept = {}
    if any(entry.path for entry in live.values()):
        old = read_entries(spark, lake, layer, dataset, list(live.values()))
        old = old.join(F.broadcast(replaced), list(lake.partitions), "left_anti").drop(*lake.partitions)
        kept = store_rows(old, lake, layer, dataset, time_column)
    new = store_rows(frame.drop("batch", "attempt", *lake.partitions).withColumn("batch", F.lit(f"rewritten-{new_attempt()}")), lake, layer, dataset, time_column)
    log.commit([*kept.values(), *new.values()], live, version)


def replace_layer(
    frame: DataFrame, lake: Lake, layer: str, dataset: str, time_column: str
) -> dict[str, Entry]:
    """Replace a whole layer, at once, by rows that bring their ``batch``."""
    log = lake.log(frame.sparkSession, layer, dataset)
    version, live = log.state()
    entries = store_rows(frame, lake, layer, dataset, time_column)
    log.commit(entries.values(), live, version)
    return entries


def visible(entry: Entry) -> bool:
    """Whether readers of a layer see a batch: it has rows and wasn't quarantined by the gate."""
    return bool(entry.path) and entry.state != QUARANTINED


def live_entries(spark: SparkSession, lake: Lake, layer: str, dataset: str, states: tuple[str, ...] | None = None, first: str | None = None, last: str | None = None) -> list[Entry]:
    """Published batches with rows, of the given states and overlapping a day range, from the log alone."""
    entries = [e for e in lake.log(spark, layer, dataset).live().values() if e.path and not e.batch.startswith("_")]
    entries = [e for e in entries if (e.state in states if states else visible(e))]
    if first is not None:
        entries = [e for e in entries if e.last_day is None or e.last_day >= first]
    if last is not None:
        entries = [e for e in entries if e.first_day is None or e.first_day <= last]
    return entries


def read_entries(spark: SparkSession, lake: Lake, layer: str, dataset: str, entries: list[Entry], schema: str | None = None) -> DataFrame:
    """Rows of some batches, with ``batch`` and the time folders as columns; opens only their folders."""
    root = lake.path(layer, dataset)
    entries = [entry for entry in entries if entry.path]
    foldered = lake.stored_partitions(layer) or lake.partitions
    if not entries:
        if schema is None:
            raise FileNotFoundError(f"nothing is published in {layer}/{dataset}")
        return spark.createDataFrame([], f"{schema}, {', '.join(f'{n} STRING' for n in ('batch', *foldered))}")
    rows = None
    for packed_by in sorted({entry.packed_by or "" for entry in entries}):
        names = ("attempt", "batch") if packed_by else ("attempt", "batch", *foldered)
        reader = spark.read.option("basePath", root).format(layer_format(layer))
        if schema is not None:
            reader = reader.schema(f"{schema}, {', '.join(f'{n} STRING' for n in names)}")
        part = reader.load([f"{root}/{entry.path}" for entry in entries if (entry.packed_by or "") == packed_by])
        if packed_by:
            part = with_partitions(part, packed_by, lake.partitions)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    for entry in entries:  # the few batches that an expiry cut in two
        if entry.hidden_before:
            expired = (F.col("batch") == entry.batch) & (F.col("attempt") == entry.attempt) & (_day_folder() < entry.hidden_before)
            rows = rows.filter(~expired)
    return rows.drop("attempt")


def read_entry(spark: SparkSession, lake: Lake, layer: str, dataset: str, entry: Entry, schema: str | None = None) -> DataFrame:
    return read_entries(spark, lake, layer, dataset, [entry], schema)


def land_raw(payloads: DataFrame, lake: Lake, dataset: str, batch_id: str) -> Entry:
    """Exact payload text with its arrival stamp, partitioned by arrival."""
    return write_batch(
        payloads.select("payload", "arrived_at", "seq"),
        lake, "raw", dataset, "arrived_at", batch_id,
    )


def read_raw(spark: SparkSession, lake: Lake, dataset: str, only: Column | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """Raw layer parsed to typed events. ``only`` filters partition columns first.

    Batches and streams land in the same layout, so both are read. A day range opens only
    the batches that overlap it.
    """
    stored = read_layer(spark, lake, "raw", dataset, RAW_SCHEMA.toDDL(), first=first, last=last)
    if only is not None:
        stored = stored.filter(only)
    return parse_payloads(stored.select("payload", "arrived_at", "seq"))


def read_layer(
    spark: SparkSession, lake: Lake, layer: str, dataset: str, schema: str | None = None,
    states: tuple[str, ...] | None = None, first: str | None = None, last: str | None = None,
) -> DataFrame:
    """Published rows of a layer; with ``states``, only of batches in these states."""
    entries = live_entries(spark, lake, layer, dataset, states, first, last)
    rows = read_entries(spark, lake, layer, dataset, entries, schema)
    return rows.drop("reasons") if layer == "bronze" else rows


def read_between(spark: SparkSession, lake: Lake, layer: str, dataset: str, since: datetime, until: datetime) -> DataFrame:
    """Published rows of a packed Parquet layer from ``since`` on and before ``until``, by the time it is ranged by.

    Opens the files whose zone overlaps; their names, not their rows, pass through the driver. Rows
    without a time are in no range. Batches in time folders raise: ``compact`` them first.
    """
    entries = live_entries(spark, lake, layer, dataset, first=str(since.date()), last=str(until.date()))
    root = lake.path(layer, dataset)
    packed = [entry for entry in entries if entry.packed_by]
    rest = [entry for entry in entries if not entry.packed_by]
    if rest:
        raise ValueError(f"{len(rest)} batches of {layer}/{dataset} are not packed; compact them first")
    known = zones.read(spark, sorted({lake.zones_path(layer, dataset, entry.attempt) for entry in packed}))
    wanted = {entry.path for entry in packed}
    files = [row["file"] for row in zones.overlapping(known, since, until).select("file").collect()]
    files = [file for file in files if "/".join(file.split("/")[-3:-1]) in wanted]
    if not files:
        return read_layer(spark, lake, layer, dataset).limit(0)
    rows = spark.read.option("basePath", root).parquet(*files)
    inside = F.lit(False)
    for column in sorted({entry.packed_by for entry in packed}):
        own = F.col("attempt").isin(sorted({entry.attempt for entry in packed if entry.packed_by == column}))
        inside = inside | (own & (F.col(column) >= F.lit(since)) & (F.col(column) < F.lit(until)))
    columns = {entry.packed_by for entry in packed}
    if len(columns) == 1:  # plain comparisons reach the scan
        column = F.col(columns.pop())
        inside = (column >= F.lit(since)) & (column < F.lit(until))
    rows = rows.filter(inside)
    for entry in packed:
        if entry.hidden_before:
            rows = rows.filter(~((F.col("batch") == entry.batch) & (F.to_date(entry.packed_by) < F.lit(entry.hidden_before).cast("date"))))
    return rows.drop("attempt", "reasons") if layer == "bronze" else rows.drop("attempt")


def compact(spark: SparkSession, lake: Lake, layer: str, dataset: str, time_column: str) -> int:
    """Store a Parquet layer's batches of time folders packed, under their names; gives how many.

    Published at once; a batch that somebody replaces meanwhile makes this start over. Layers with an id index
    are refused, since ids name the attempt that holds them: write those packed from the start.
    """
    if layer in _JSON_LAYERS:
        raise ValueError(f"{layer} holds text as it came and isn't packed")
    target = replace(lake, packed=True)
    log = lake.log(spark, layer, dataset)
    while True:
        version, live = log.state()
        if any(name.startswith("_") for name in live):
            raise ValueError(f"{layer}/{dataset} has an id index")
        old = [entry for entry in live.values() if entry.path and not entry.packed_by]
        if not old:
            return 0
        rows = read_entries(spark, replace(lake, packed=False), layer, dataset, old)
        new = store_rows(rows, target, layer, dataset, time_column)
        kept = [replace(e, path=new[e.batch].path if e.batch in new else "", hidden_before=None, packed_by=time_column) for e in old]
        try:
            log.commit(kept, expected=version)
        except Conflict:
            continue
        return len(old)


def stored_layer(spark: SparkSession, lake: Lake, layer: str, dataset: str) -> bool:
    """Whether a layer has published rows."""
    return bool(live_entries(spark, lake, layer, dataset))


def vacuum(spark: SparkSession, lake: Lake, layer: str, dataset: str, older_than_ms: int = 7 * 86_400_000) -> list[str]:
    """Delete attempts that no live batch uses and that nobody has written to for a while.

    The age spares writers that haven't published yet and readers that still hold an older version.
    """
    live = lake.log(spark, layer, dataset).live()
    used = {entry.attempt for entry in live.values()}
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    gone = []
    for path in folders(spark, f"{lake.path(layer, dataset)}/attempt=*"):
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        name = path.getName().removeprefix("attempt=")
        if name not in used and system.getFileStatus(path).getModificationTime() <= now - older_than_ms:
            system.delete(path, True)
            gone.append(name)
    for entry in live.values():
        if entry.hidden_before and not entry.packed_by:
            for day, folder in day_folders(spark, lake, layer, dataset, entry):
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                if day < entry.hidden_before and system.getFileStatus(path).getModificationTime() <= now - older_than_ms:
                    system.delete(path, True)
                    gone.append(f"{entry.attempt}/{day}")
    return gone


def write_gold(
    tables: dict[str, DataFrame], lake: Lake, dataset: str, version: int | None = None
) -> None:
    """Gold tables of one dataset, each replaced at once; other datasets stay.

    ``version`` orders writers: a table made from an older version doesn't replace one made from a newer.
    """
    for name, frame in tables.items():
        attempt = new_attempt()
        path = f"attempt={attempt}/dataset={dataset}"
        frame.write.parquet(f"{lake.path('gold', name)}/{path}")
        log = lake.log(frame.sparkSession, "gold", name)
        while True:
            at, live = log.state()
            if version is not None and dataset in live and (live[dataset].rows or 0) >= version:
                break
            try:
                log.commit([Entry(dataset, path, rows=version)], expected=at)
                break
            except Conflict:  # somebody published this table, perhaps for another dataset
                continue


def gold_version(spark: SparkSession, lake: Lake, dataset: str) -> int:
    """The oldest version that the dataset's gold tables were made from."""
    entries = [lake.log(spark, "gold", name).live().get(dataset) for name in domain.GOLD_DATASETS]
    return min((entry.rows or 0) if entry else 0 for entry in entries)


def gold_path(spark: SparkSession, lake: Lake, table: str, dataset: str) -> str | None:
    entry = lake.log(spark, "gold", table).live().get(dataset)
    return f"{lake.path('gold', table)}/{entry.path}" if entry else None


def read_gold(spark: SparkSession, lake: Lake, table: str, dataset: str = "transactions") -> DataFrame:
    path = gold_path(spark, lake, table, dataset)
    if path is None:
        return spark.createDataFrame([], GOLD_SCHEMAS[table])
    return spark.read.schema(GOLD_SCHEMAS[table]).parquet(path)


def read_gold_datasets(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    """A gold table with all datasets, told apart by their column ``dataset``; None if nothing is published."""
    live = lake.log(spark, "gold", table).live()
    paths = [f"{lake.path('gold', table)}/{entry.path}" for entry in live.values()]
    if not paths:
        return None
    return spark.read.option("basePath", lake.path("gold", table)).parquet(*paths).drop("attempt")


def write_report(report: DataFrame, lake: Lake, dataset: str) -> None:
    """The one-row report as a single JSON file."""
    report.coalesce(1).write.mode("overwrite").json(lake.report_path(dataset))


def _day_folder() -> Column:
    return F.concat_ws("-", "year", "month", "day")


def partition_hours(start: str, end: str) -> Column:
    """Partition filter for an inclusive day range; prunes folders, reads no data."""
    return (_day_folder() >= start) & (_day_folder() <= end)


def day_folders(spark: SparkSession, lake: Lake, layer: str, dataset: str, entry: Entry) -> list[tuple[str, str]]:
    """(day, folder) of a batch's stored days, from names alone."""
    if entry.packed_by:  # the days of its range, without folders
        if entry.first_day is None or entry.last_day is None:
            return []
        first, last = date.fromisoformat(entry.first_day), date.fromisoformat(entry.last_day)
        return [(str(first + timedelta(days=n)), "") for n in range((last - first).days + 1)]
    found = []
    for path in folders(spark, f"{lake.path(layer, dataset)}/{entry.path}/year=*/month=*/day=*"):
        parts = dict(part.split("=", 1) for part in path.toString().split("/") if "=" in part)
        found.append((f"{parts['year']}-{parts['month']}-{parts['day']}", path.toString()))
    return sorted(found)


def expire(spark: SparkSession, lake: Lake, layer: str, dataset: str, limit: str) -> list[tuple[str, str]]:
    """Drop a layer's day partitions before ``limit`` by names alone; gives the (batch, day) dropped.

    Batches that ended before are dropped from the log, a batch that goes on after it is marked. No
    data file is opened. What was dropped is kept in the ledger of ``expired``; files go with ``vacuum``.
    """
    log, ledger = lake.log(spark, layer, dataset), lake.log(spark, "expired", f"{layer}-{dataset}")
    while True:
        version, live = log.state()
        touched = [e for e in live.values() if e.path and not e.batch.startswith("_") and (e.first_day is None or e.first_day < limit) and (e.hidden_before or "") < limit]
        gone, marked, dropped = [], [], []
        for entry in touched:
            days = [day for day, _ in day_folders(spark, lake, layer, dataset, entry)]
            if entry.packed_by and not days:  # its range isn't known
                continue
            dropped += [(entry.batch, day) for day in days if (entry.hidden_before or "") <= day < limit]
            if all(day < limit for day in days):
                gone.append(entry.batch)
            elif days and days[0] < limit:
                marked.append(replace(entry, hidden_before=limit))
        if not gone and not marked:
            return []
        # the ledger first: a run that is lost in between lists them again under the same names
        ledger.commit([Entry(f"{batch}/{day}", "", "expired", first_day=day, last_day=day) for batch, day in dropped])
        try:
            log.commit(marked, gone, version)
        except Conflict:
            continue
        return dropped


def expired_partitions(spark: SparkSession, lake: Lake, layer: str, dataset: str) -> DataFrame:
    """The ledger of expired partitions: batch, day."""
    entries = lake.log(spark, "expired", f"{layer}-{dataset}").live().values()
    return spark.createDataFrame([(e.batch.rsplit("/", 1)[0], e.first_day) for e in entries], "batch string, day string")


def inventory(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count per (layer, dataset)."""
    counted = None
    for (layer, dataset), frame in tables.items():
        part = frame.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "records"
        )
        counted = part if counted is None else counted.unionByName(part)
    return counted


def stored_inventory(spark: SparkSession, lake: Lake, datasets: list[str]) -> DataFrame:
    """Row count of every stored table of the named datasets and of gold."""
    tables = {}
    for layer in domain.LAYERS:
        for dataset in domain.GOLD_DATASETS if layer == "gold" else datasets:
            if layer == "gold":
                frame = read_gold_datasets(spark, lake, dataset)
                if frame is not None:
                    tables[layer, dataset] = frame
            elif stored_layer(spark, lake, layer, dataset):
                if layer in _JSON_LAYERS:
                    # text lines are records here, so counting needs no JSON parsing
                    paths = [f"{lake.path(layer, dataset)}/{e.path}" for e in live_entries(spark, lake, layer, dataset)]
                    tables[layer, dataset] = spark.read.option("basePath", lake.path(layer, dataset)).text(paths)
                else:
                    tables[layer, dataset] = read_layer(spark, lake, layer, dataset)
    return inventory(tables)
