"""Stored layers: repeatable batches, invariants between layers, backfill, gate."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewrack.operators import gold, lineage, pii, quality
from tidewrack.plans import backfill, gate, medallion
from tidewrack.registry.queries import txn
from tidewrack.session import shared_folder
from tidewrack.sources import lake as store
from tidewrack.sources import wire
from tidewrack.sources.lake import Lake

DATASET = "transactions"


@pytest.fixture(scope="module")
def parts(spark, sf):
    """The events as two arrival batches of payloads."""
    rows = wire.to_payload(txn(spark, sf))
    return rows.filter("seq < 500"), rows.filter("seq >= 500")


@pytest.fixture(scope="module")
def stored(spark, parts):
    lake = Lake(shared_folder(spark, "test-lake"), "day")
    medallion.write_batch(spark, lake, DATASET, parts[0], "b1")
    medallion.write_batch(spark, lake, DATASET, parts[1], "b2")
    return lake


def read(spark, lake, layer):
    return store.read_layer(spark, lake, layer, DATASET)


def snapshot(spark, lake):
    return {
        (r["layer"], r["dataset"]): r["records"]
        for r in store.stored_inventory(spark, lake, [DATASET]).collect()
    }


def test_raw_is_bronze_plus_quarantine(spark, sf, stored):
    raw = {r[0] for r in read(spark, stored, "raw").select("seq").collect()}
    bronze = [r[0] for r in read(spark, stored, "bronze").select("seq").collect()]
    rejected = [r[0] for r in read(spark, stored, "quarantine").select("seq").collect()]
    assert len(bronze) + len(rejected) == len(raw) == 1000
    assert set(bronze) | set(rejected) == raw and not set(bronze) & set(rejected)


def test_raw_keeps_the_exact_payload(spark, sf, stored, parts):
    kept = read(spark, stored, "raw").select("seq", "payload")
    assert kept.exceptAll(parts[0].unionByName(parts[1]).select("seq", "payload")).count() == 0


def test_two_batches_equal_one_job(spark, sf, stored):
    whole = medallion.silver(txn(spark, sf), DATASET, F.col("arrived_at")).select("seq", "event_id", "email")
    silver = read(spark, stored, "silver").select("seq", "event_id", "email")
    assert silver.exceptAll(whole).count() == 0 and whole.exceptAll(silver).count() == 0
    assert silver.select("event_id").distinct().count() == silver.count() == 960


def test_gold_sums_to_silver(spark, stored):
    silver = read(spark, stored, "silver")
    total = silver.agg(F.sum(gold.gold_amount()).cast("decimal(18,2)")).first()[0]
    for name in ("daily_revenue", "customer_activity", "country_performance", "merchant_statistics"):
        row = store.read_gold(spark, stored, name).agg(F.sum("volume"), F.sum("transactions")).first()
        assert row[0] == total and row[1] == 960
    assert str(total) == "50277.20"
    wrong = lineage.reconcile(
        silver, store.read_gold(spark, stored, "customer_activity"), F.col("customer_id"), "customer_id"
    ).filter("difference <> 0 OR silver_rows <> transactions")
    assert wrong.count() == 0


def test_stored_silver_shows_no_clear_pii(spark, stored):
    assert pii.audit(read(spark, stored, "silver")).agg(F.sum("clear_values")).first()[0] == 0


def test_repeating_a_batch_changes_nothing(spark, stored, parts):
    before = snapshot(spark, stored)
    medallion.write_batch(spark, stored, DATASET, parts[0], "b1")
    assert snapshot(spark, stored) == before


def test_partition_filter_prunes_folders(spark, stored):
    frame = read(spark, stored, "silver").filter(store.partition_hours("2024-01-05", "2024-01-06"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    days = {(r["month"], r["day"]) for r in frame.select("month", "day").distinct().collect()}
    assert days == {("01", "05"), ("01", "06")}


def test_backfill_resume_and_dry_run(spark, sf, parts):
    lake = Lake(shared_folder(spark, "test-backfill"), "day")
    store.land_raw(parts[0].unionByName(parts[1]), lake, DATASET, "landed")
    dry = backfill.run(spark, lake, DATASET, "2024-01-01", "2024-01-02", dry_run=True).first()
    assert dry["status"] == "running" and dry["records"] == 0 and str(dry["next_day"]) == "2024-01-01"
    assert not store.exists(spark, lake.path("silver", DATASET))
    first = backfill.run(spark, lake, DATASET, "2024-01-01", "2024-01-01").first()
    assert first["status"] == "completed"
    second = backfill.run(spark, lake, DATASET, "2024-01-01", "2024-01-30").first()
    assert second["days_done"] == 30 and second["next_day"] is None and second["records"] == 960
    again = backfill.run(spark, lake, DATASET, "2024-01-01", "2024-01-30").first()
    assert again == second
    silver = read(spark, lake, "silver")
    assert silver.count() == silver.select("event_id").distinct().count() == 960


def test_backfill_plan(spark):
    assert backfill.plan(spark, "2026-09-01", "2026-09-07").count() == 7
    with pytest.raises(ValueError):
        backfill.plan(spark, "2026-09-02", "2026-09-01")


def test_gate_decides(spark, sf, stored):
    events = txn(spark, sf)
    lake = Lake(shared_folder(spark, "test-gate"), "day")
    assert gate.gated_publish(spark, lake, DATASET, events, "x", gate=101) == "QUARANTINE"
    assert read(spark, lake, "quarantine").count() == quality.rejected_rows(events, DATASET).count()
    assert not store.exists(spark, lake.path("gold", "daily_revenue"))
    # gold needs stored silver: publishing without it fails and quarantines once more
    with pytest.raises(Exception):
        gate.gated_publish(spark, lake, DATASET, events, "y")
    assert read(spark, lake, "quarantine").select("batch").distinct().count() == 2


def test_event_json_files(spark, tmp_path):
    (tmp_path / "year=2026").mkdir()
    (tmp_path / "year=2026" / "events.jsonl").write_text(
        '{"event_id":"a","amount":12.50,"timestamp":"2026-09-12T10:00:00Z","extra":1}\n'
        '{"event_id":"b","amount":"not-a-number"}\nbroken line\n'
    )
    rows = {r["event_id"]: r for r in wire.read_event_json(spark, str(tmp_path)).collect()}
    assert str(rows["a"]["amount"]) == "12.50" and rows["a"]["amount_raw"] == "12.50"
    assert rows["b"]["amount"] is None and rows["b"]["amount_raw"] == "not-a-number"
    assert rows[None]["_corrupt_record"] == "broken line"


def landed(spark, n):
    """Payloads of one day: text that repeats its field names, also null, broken, of many lines and not ASCII."""
    text = F.concat(F.lit('{"event_id":"evt-'), "id", F.lit('","customer_name":"Ana Łoś","address":"1 Harbour Street","level":"INFO"}'))
    odd = {1: F.lit(None).cast("string"), 2: F.lit("not json"), 3: F.lit('{"event_id":\n"a\\"b"}\r\n'), 4: F.lit("")}
    payload = F.when(F.col("id") == 0, F.lit("{}"))
    for number, value in odd.items():
        payload = payload.when(F.col("id") == number, value)
    arrived = F.timestamp_micros(F.lit(1_767_225_600_000_001) + F.col("id"))
    return spark.range(n).select(payload.otherwise(text).alias("payload"), arrived.alias("arrived_at"), F.col("id").alias("seq"))


def files_of(spark, lake, layer, entry):
    return [p for p in store.folders(spark, f"{lake.path(layer, DATASET)}/{entry.path}/*/*/*/part-*")]


def test_text_layers_are_stored_compressed(spark):
    rows = landed(spark, 4000)
    lake = Lake(shared_folder(spark, "test-text"), "day")
    entries = {"raw": store.land_raw(rows, lake, DATASET, "b0")}
    rejected = rows.withColumn("reasons", F.array(F.lit("MISSING customer_id"), F.lit("NEGATIVE amount")))
    entries["quarantine"] = store.write_batch(rejected, lake, "quarantine", DATASET, "arrived_at", "b0")
    for layer, written in (("raw", rows), ("quarantine", rejected)):
        back = store.read_layer(spark, lake, layer, DATASET, written.schema.toDDL()).select(*written.columns)
        assert back.exceptAll(written).count() == 0 and written.exceptAll(back).count() == 0
        plain = written.select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
        files = files_of(spark, lake, layer, entries[layer])
        stored = sum(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in files)
        assert files and stored < plain / 4
    assert {r["layer"]: r["records"] for r in store.stored_inventory(spark, lake, [DATASET]).collect()} == {"raw": 4000, "quarantine": 4000}


def test_plain_text_stored_before_is_read_beside_compressed(spark, monkeypatch):
    rows = landed(spark, 200)
    lake = Lake(shared_folder(spark, "test-plain"), "day")
    with monkeypatch.context() as before:
        before.setattr(store, "layer_options", lambda layer: store.JSON_OPTIONS)
        store.land_raw(rows.filter("seq < 90"), lake, DATASET, "b0")
    store.land_raw(rows.filter("seq >= 90"), lake, DATASET, "b1")
    back = store.read_layer(spark, lake, "raw", DATASET, "payload string, arrived_at timestamp, seq bigint")
    assert back.select("payload", "arrived_at", "seq").exceptAll(rows).count() == 0 and back.count() == 200


def test_a_hot_day_of_text_is_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(store, "TEXT_FILE_ROWS", 100)
    lake = Lake(shared_folder(spark, "test-hot-text"), "day")
    entry = store.land_raw(landed(spark, 1000).coalesce(1), lake, DATASET, "b0")
    assert len(files_of(spark, lake, "raw", entry)) >= 10
    assert store.read_layer(spark, lake, "raw", DATASET, "payload string, arrived_at timestamp, seq bigint").select("seq").distinct().count() == 1000


def test_a_layer_write_leaves_no_shuffle_files(spark):
    def shuffled():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return sum(p.stat().st_size for folder in folders for p in Path(folder).rglob("shuffle_*.data"))

    rows = landed(spark, 20_000)
    lake = Lake(shared_folder(spark, "test-shuffles"), "day")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(name, None)
    store.land_raw(rows, lake, DATASET, "b0")
    until = time.monotonic() + 20
    while shuffled() > before and time.monotonic() < until:  # dropped by a job of its own
        time.sleep(0.2)
    assert shuffled() <= before and spark.conf.get(name, None) == setting
