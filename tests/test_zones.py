"""Packed layers: files by time, reads by zone, compaction, expiry."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewrack.session import shared_folder
from tidewrack.sources import lake as store
from tidewrack.sources import zones
from tidewrack.sources.commits import CommitLog
from tidewrack.sources.lake import Lake

DATASET = "readings"


@pytest.fixture(scope="module")
def rows(spark):
    """1,000 hours; a third of the rows share one instant, a few have no time."""
    at = F.expr("CASE WHEN id % 3 = 0 THEN TIMESTAMP '2024-02-01 05:00:00' WHEN id % 500 = 1 THEN NULL ELSE TIMESTAMP '2024-01-01' + make_interval(0, 0, 0, 0, CAST(id % 1000 AS INT)) END")
    return spark.range(30_000).select(F.col("id").alias("seq"), at.alias("event_ts"), (F.col("id") % 7).alias("n"))


def packed(spark, label):
    return Lake(shared_folder(spark, label), "hour", packed=True)


def values(frame):
    return sorted((r["seq"], r["n"]) for r in frame.select("seq", "n").collect())


SINCE, UNTIL = datetime(2024, 1, 20, 6), datetime(2024, 1, 21, 18)


def test_reads_by_zone_equal_a_filter_and_open_few_files(spark, rows):
    lake = packed(spark, "zones-read")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write_batch(rows, lake, "bronze", DATASET, "event_ts", "b0")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    store.write_batch(rows.withColumn("seq", F.col("seq") + 100_000), lake, "bronze", DATASET, "event_ts", "b1")
    store.write_batch(rows.limit(0), lake, "bronze", DATASET, "event_ts", "empty")
    both = rows.unionByName(rows.withColumn("seq", F.col("seq") + 100_000))
    wanted = both.filter((F.col("event_ts") >= F.lit(SINCE)) & (F.col("event_ts") < F.lit(UNTIL)))
    found = store.read_between(spark, lake, "bronze", DATASET, SINCE, UNTIL)
    assert values(found) == values(wanted) and found.count() > 0
    entry = lake.log(spark, "bronze", DATASET).live()["b0"]
    table = zones.read(spark, [lake.zones_path("bronze", DATASET, entry.attempt)])
    assert table.agg(F.sum("records")).first()[0] == 30_000 and table.count() > 3
    assert table.agg(F.sum("untimed")).first()[0] == rows.filter("event_ts IS NULL").count()
    assert 0 < zones.overlapping(table, SINCE, UNTIL).count() < table.count()
    hot = datetime(2024, 2, 1, 5), datetime(2024, 2, 1, 6)
    assert store.read_between(spark, lake, "bronze", DATASET, *hot).count() == 2 * rows.filter("event_ts = TIMESTAMP '2024-02-01 05:00:00'").count()
    assert store.read_between(spark, lake, "bronze", DATASET, datetime(2030, 1, 1), datetime(2030, 1, 2)).count() == 0
    # readers see the columns of time folders
    hour = store.read_layer(spark, lake, "bronze", DATASET).filter("year = '2024' AND month = '01' AND day = '20' AND hour = '07'")
    assert values(hour) == values(both.filter("date_trunc('hour', event_ts) = TIMESTAMP '2024-01-20 07:00:00'"))


def test_compaction_keeps_rows_and_batches(spark, rows):
    lake = Lake(shared_folder(spark, "zones-compact"), "day")
    for name, part in (("b0", rows.filter("seq % 2 = 0")), ("b1", rows.filter("seq % 2 = 1"))):
        store.write_batch(part, lake, "bronze", DATASET, "event_ts", name)
    before = store.read_layer(spark, lake, "bronze", DATASET)
    kept, files = values(before), len(before.inputFiles())
    with pytest.raises(ValueError, match="not packed"):
        store.read_between(spark, lake, "bronze", DATASET, SINCE, UNTIL)
    assert store.compact(spark, lake, "bronze", DATASET, "event_ts") == 2
    after = store.read_layer(spark, lake, "bronze", DATASET)
    assert values(after) == kept and len(after.inputFiles()) < files / 5
    assert set(after.columns) == set(before.columns)
    assert store.compact(spark, lake, "bronze", DATASET, "event_ts") == 0
    store.write_batch(rows.filter("seq % 2 = 1 AND n = 3"), lake, "bronze", DATASET, "event_ts", "b1")  # in day folders again
    assert values(store.read_layer(spark, lake, "bronze", DATASET)) == values(rows.filter("seq % 2 = 0 OR n = 3"))
    assert store.compact(spark, lake, "bronze", DATASET, "event_ts") == 1
    assert values(store.read_between(spark, lake, "bronze", DATASET, SINCE, UNTIL)) == values(
        rows.filter("seq % 2 = 0 OR n = 3").filter((F.col("event_ts") >= F.lit(SINCE)) & (F.col("event_ts") < F.lit(UNTIL)))
    )


def test_compaction_starts_over_when_a_batch_is_replaced_meanwhile(spark, rows, monkeypatch):
    lake = Lake(shared_folder(spark, "zones-race"), "day")
    store.write_batch(rows, lake, "bronze", DATASET, "event_ts", "b0")
    commit, turns = CommitLog.commit, []

    def late(log, add, drop=(), expected=None):
        if expected is not None and not turns:
            turns.append(1)
            store.write_batch(rows.filter("n = 1"), lake, "bronze", DATASET, "event_ts", "b0")
        return commit(log, add, drop, expected)

    monkeypatch.setattr(CommitLog, "commit", late)
    assert store.compact(spark, lake, "bronze", DATASET, "event_ts") == 1
    assert turns and values(store.read_layer(spark, lake, "bronze", DATASET)) == values(rows.filter("n = 1"))


def test_layers_with_an_id_index_and_text_layers_are_refused(spark, rows):
    lake = Lake(shared_folder(spark, "zones-refused"), "day")
    with pytest.raises(ValueError, match="text"):
        store.compact(spark, lake, "raw", DATASET, "arrived_at")
    lake.log(spark, "silver", DATASET).commit([store.Entry("_pages", "attempt=x/pages=1")])
    with pytest.raises(ValueError, match="id index"):
        store.compact(spark, lake, "silver", DATASET, "event_ts")


def test_expiry_of_packed_batches(spark, rows):
    lake = packed(spark, "zones-expire")
    timed = rows.filter("event_ts IS NOT NULL")
    store.write_batch(timed.filter("event_ts < '2024-01-05'"), lake, "bronze", DATASET, "event_ts", "old")
    store.write_batch(timed.filter("event_ts >= '2024-01-05'"), lake, "bronze", DATASET, "event_ts", "cut")
    dropped = store.expire(spark, lake, "bronze", DATASET, "2024-01-10")
    assert {batch for batch, _ in dropped} == {"old", "cut"} and len(dropped) == 4 + 5
    assert values(store.read_layer(spark, lake, "bronze", DATASET)) == values(timed.filter("event_ts >= '2024-01-10'"))
    part = store.read_between(spark, lake, "bronze", DATASET, datetime(2024, 1, 8), datetime(2024, 1, 11))
    assert values(part) == values(timed.filter("event_ts >= '2024-01-10' AND event_ts < '2024-01-11'"))
    assert store.vacuum(spark, lake, "bronze", DATASET, 0) and part.count() > 0
