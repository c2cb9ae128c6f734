"""Streams over several micro-batches: equal to batch, restartable, late rows."""

import pytest
from pyspark.sql import functions as F

from tidewrack.operators import anomaly, gold, quality
from tidewrack.plans import medallion
from tidewrack.registry.queries import txn
from tidewrack.session import shared_folder
from tidewrack.sources import streams, wire
from tidewrack.sources import lake as store
from tidewrack.sources.lake import JSON_OPTIONS, Lake
from tidewrack.streaming import ingest, metrics

DATASET = "transactions"
STEP = 250


@pytest.fixture()
def landed(spark, sf):
    """A folder that receives the payloads in four files, in arrival order."""
    folder = shared_folder(spark, "test-stream-in")
    rows = wire.to_payload(txn(spark, sf)).persist()

    def land(number: int) -> None:
        part = rows.filter(F.col("seq").between(STEP * number, STEP * (number + 1) - 1))
        part.coalesce(1).write.mode("append").options(**JSON_OPTIONS).json(folder)

    land(0)
    yield folder, land
    rows.unpersist()


def stream(spark, folder):
    return wire.parse_payloads(streams.payload_files(spark, folder, max_files=1))


def test_bronze_and_quarantine_survive_a_restart(spark, sf, landed):
    folder, land = landed
    lake = Lake(shared_folder(spark, "test-stream"), "day")
    for number in (1, 2, 3, None):
        ingest.run_available(ingest.bronze(stream(spark, folder), lake, DATASET))
        ingest.run_available(ingest.quarantine(stream(spark, folder), lake, DATASET))
        if number is not None:
            land(number)
    # started once more with nothing new
    ingest.run_available(ingest.bronze(stream(spark, folder), lake, DATASET))
    events = txn(spark, sf)
    bronze = store.read_layer(spark, lake, "bronze", DATASET)
    wanted = medallion.bronze(events, DATASET, F.col("arrived_at"))
    columns = ["seq", "event_id", "amount_gbp", "event_ts", "country_name", "is_fraud"]
    assert bronze.select(columns).exceptAll(wanted.select(columns)).count() == 0
    assert bronze.count() == wanted.count()
    rejected = store.read_layer(spark, lake, "quarantine", DATASET)
    assert rejected.count() == quality.rejected_rows(events, DATASET).count()
    assert {r[0] for r in rejected.select("quarantine_reason").distinct().collect()} == {"schema_or_quality"}


def test_silver_and_gold_over_batches_equal_batch(spark, sf, landed):
    folder, land = landed
    for number in (1, 2, 3):
        land(number)
    lake = Lake(shared_folder(spark, "test-stream-gold"), "day")
    query = ingest.run_available(ingest.daily_gold(stream(spark, folder), lake, DATASET))
    assert query.lastProgress["batchId"] >= 3
    core = medallion.silver_core(txn(spark, sf), DATASET, F.col("arrived_at"))
    silver = store.read_layer(spark, lake, "silver", DATASET).select("seq", "event_id", "amount_gbp")
    assert silver.exceptAll(core.select("seq", "event_id", "amount_gbp")).count() == 0
    assert silver.count() == core.count()
    for name in gold.GOLD:
        got = store.read_gold(spark, lake, name)
        want = gold.GOLD[name](core)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_repeats_across_batches_are_dropped(spark, sf, landed):
    folder, land = landed
    land(1)
    land(0)  # the first file delivered twice
    land(2)
    lake = Lake(shared_folder(spark, "test-stream-dedup"), "day")
    ingest.run_available(ingest.deduplicated(stream(spark, folder), lake, DATASET))
    ids = store.read_layer(spark, lake, "bronze", f"{DATASET}_distinct").select("event_id")
    want = quality.accepted_rows(txn(spark, sf), DATASET).filter(F.col("seq") < 3 * STEP)
    assert ids.count() == ids.distinct().count() == want.select("event_id").distinct().count()


def late_payloads(spark, folder, batches):
    for rows in batches:
        values = ", ".join(f"('{i}', TIMESTAMP '{t}')" for i, t in rows)
        spark.sql(
            f"""SELECT '{{"event_id":"' || id || '","customer_id":"c","event_type":"payment","amount":1,"currency":"GBP","timestamp":"'
                || date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'") || '"}}' AS payload,
                TIMESTAMP '2026-01-03 00:00:00' AS arrived_at, 1L AS seq FROM VALUES {values} AS x(id, t)"""
        ).coalesce(1).write.mode("append").json(folder)


def test_late_rows(spark):
    """Every late row is kept; only the form with bounded state drops some, and counts them."""
    folder = shared_folder(spark, "test-late-in")
    late_payloads(
        spark, folder,
        [[("a", "2026-01-02 20:00:00")], [("b", "2026-01-02 21:00:00")],
         [("c", "2026-01-02 10:00:00"), ("d", "2026-01-01 01:00:00")]],
    )
    lake = Lake(shared_folder(spark, "test-late"), "day")
    ingest.run_available(ingest.bronze(stream(spark, folder), lake, DATASET))
    bronze = store.read_layer(spark, lake, "bronze", DATASET)
    assert {(r["event_id"], r["day"]) for r in bronze.collect()} == {
        ("a", "02"), ("b", "02"), ("c", "02"), ("d", "01")
    }
    ingest.run_available(ingest.deduplicated(stream(spark, folder), lake, DATASET))
    kept = store.read_layer(spark, lake, "bronze", f"{DATASET}_distinct")
    assert {r["event_id"] for r in kept.collect()} == {"a", "b", "c", "d"}
    bounded = ingest.distinct_events(stream(spark, folder), DATASET).select("event_id", "event_ts")
    query = ingest.run_available(
        bounded.writeStream.format("noop").option("checkpointLocation", lake.checkpoint_path("bounded"))
    )
    dropped = sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress for operator in progress["stateOperators"]
    )
    assert dropped == 1


def test_window_totals_and_quality_per_batch(spark, sf, landed):
    folder, land = landed
    for number in (1, 2, 3):
        land(number)
    lake = Lake(shared_folder(spark, "test-stream-metrics"), "day")
    ingest.run_available(metrics.window_totals(stream(spark, folder), lake, DATASET))
    found = metrics.read_table(spark, lake, f"{DATASET}_windows")
    want = anomaly.window_totals(txn(spark, sf), DATASET)
    assert found.exceptAll(want).count() == 0 and want.count() == found.count()
    ingest.run_available(metrics.batch_quality(stream(spark, folder), lake, DATASET))
    reports = spark.read.parquet(lake.report_path(f"{DATASET}_stream"))
    assert reports.count() == 4 and reports.agg(F.sum("records")).first()[0] == 1000


def test_alerts_over_batches(spark, sf, landed):
    folder, land = landed
    for number in (1, 2, 3):
        land(number)
    lake = Lake(shared_folder(spark, "test-stream-alerts"), "day")
    ingest.run_available(metrics.alerts(stream(spark, folder), lake, DATASET))
    found = metrics.read_table(spark, lake, f"{DATASET}_alerts")
    batch = anomaly.detect(anomaly.with_baseline(anomaly.anomaly_metrics(txn(spark, sf), DATASET)))
    want = batch.filter("metric <> 'duplicate_rate'").select("metric", "window_start", "severity")
    assert found.select("metric", "window_start", "severity").exceptAll(want).count() == 0
    assert found.count() == want.count()


def test_landing_is_exact(spark, landed):
    folder, _ = landed
    lake = Lake(shared_folder(spark, "test-landing"), "day")
    source = streams.payload_files(spark, folder)
    ingest.run_available(ingest.landing(source, lake, DATASET))
    kept = store.read_layer(spark, lake, "raw", DATASET).select("payload")
    assert kept.exceptAll(spark.read.json(folder).select("payload")).count() == 0 and kept.count() == STEP
