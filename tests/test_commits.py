"""Commit logs, the id index, gold from sums, batch states, keys, expiry: lost writers, races, many batches."""

import threading

import pytest
from pyspark.sql import functions as F

from tidewrack.operators import dedupe, gold, layout, warehouse
from tidewrack.plans import backfill, increments, medallion
from tidewrack.registry.queries import txn
from tidewrack.session import shared_folder
from tidewrack.sources import id_index, wire
from tidewrack.sources import lake as store
from tidewrack.sources.commits import PUBLISHED, QUARANTINED, CommitLog, Conflict, Entry
from tidewrack.sources.id_index import IdIndex
from tidewrack.sources.lake import Lake
from tidewrack.streaming import ingest, progress

DATASET = "transactions"


@pytest.fixture(scope="module")
def rows(spark, sf):
    path = f"{shared_folder(spark, 'commit-rows')}/rows"
    wire.to_payload(txn(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def core(spark, sf):
    path = f"{shared_folder(spark, 'commit-core')}/rows"
    medallion.bronze(txn(spark, sf), DATASET, F.col("arrived_at")).write.parquet(path)
    return spark.read.parquet(path)


def new_lake(spark, label):
    return Lake(shared_folder(spark, label), "day")


def sizes(spark, lake):
    """Rows a reader sees in each layer."""
    found = {}
    for layer in ("raw", "bronze", "quarantine", "silver"):
        found[layer] = store.read_layer(spark, lake, layer, DATASET).count() if store.stored_layer(spark, lake, layer, DATASET) else 0
    found["gold"] = store.read_gold(spark, lake, "daily_revenue").agg(F.coalesce(F.sum("transactions"), F.lit(0))).first()[0]
    return found


def test_log_versions_summaries_and_conflicts(spark):
    log = CommitLog(spark, f"{shared_folder(spark, 'log')}/log")
    assert log.state() == (0, {})
    for number in range(45):
        assert log.commit([Entry(f"b{number % 10}", f"attempt={number}/batch=x")]) == number + 1
    version, live = log.state()
    assert version == 45 and {e.path for e in live.values()} == {f"attempt={n}/batch=x" for n in range(35, 45)}
    assert log.state(as_of=12)[1]["b1"].attempt == "11" and len(log._names()[1]) == 2
    with pytest.raises(Conflict):
        log.commit([Entry("late", "")], expected=44)
    log.commit([], ["b0"], expected=45)
    assert "b0" not in log.live() and len(log.live()) == 9


def test_concurrent_commits_lose_nothing(spark):
    log = CommitLog(spark, f"{shared_folder(spark, 'log-race')}/log")

    def write(name):
        for number in range(8):
            log.commit([Entry(f"{name}-{number}", f"attempt={name}{number}")])

    threads = [threading.Thread(target=write, args=(name,)) for name in "abc"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    version, live = log.state()
    assert version == 24 and len(live) == 24


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["land_raw", "stage", "store_rows", "append_silver", "add", "publish", "write_gold"])
def test_a_batch_lost_after_any_step_is_resumed(spark, rows, monkeypatch, step):
    """Each reader sees the old or the new batch; the repeat gives what an undisturbed run gives."""
    lake = new_lake(spark, f"lost-{step}")
    first = rows.filter("seq < 500")
    medallion.write_batch(spark, lake, DATASET, first, "b0")
    old, whole = sizes(spark, lake), {"raw": 1000, "bronze": 967, "quarantine": 33, "silver": 960, "gold": 960}
    home = {"land_raw": store, "store_rows": store, "write_gold": store, "stage": medallion, "append_silver": medallion, "add": IdIndex, "publish": increments}[step]
    real = getattr(home, step)

    def lost(*args, **kwargs):
        real(*args, **kwargs)
        raise Killed

    monkeypatch.setattr(home, step, lost)
    with pytest.raises(Killed):
        medallion.write_batch(spark, lake, DATASET, rows, "b0")
    seen = sizes(spark, lake)
    assert all(seen[layer] in (old[layer], whole[layer]) for layer in seen)
    monkeypatch.setattr(home, step, real)
    medallion.write_batch(spark, lake, DATASET, rows, "b0")
    assert sizes(spark, lake) == whole


def test_a_reader_keeps_what_it_opened(spark, core):
    lake = new_lake(spark, "reader")
    store.write_batch(core.filter("seq < 300"), lake, "bronze", DATASET, "ingested_at", "b")
    opened = store.read_layer(spark, lake, "bronze", DATASET)
    before = opened.count()
    store.write_batch(core, lake, "bronze", DATASET, "ingested_at", "b")
    assert opened.count() == before and store.read_layer(spark, lake, "bronze", DATASET).count() == core.count()
    # what no batch uses goes once it is old enough
    assert store.vacuum(spark, lake, "bronze", DATASET) == []
    assert len(store.vacuum(spark, lake, "bronze", DATASET, older_than_ms=-60_000)) == 1
    assert store.read_layer(spark, lake, "bronze", DATASET).count() == core.count()


def test_two_writers_of_silver_never_store_an_id_twice(spark, core, monkeypatch):
    """Another writer publishes between this one's look-up and its publication."""
    lake = new_lake(spark, "race")
    unique = dedupe.keep_first(core)
    real, raced = IdIndex.unseen, []

    def unseen(self, frame, live, batch_id):
        found = real(self, frame, live, batch_id)
        if not raced:
            raced.append(True)
            medallion.add_new_ids(spark, lake, "silver", DATASET, unique.filter("seq < 400"), "ingested_at", "other")
        return found

    monkeypatch.setattr(IdIndex, "unseen", unseen)
    medallion.add_new_ids(spark, lake, "silver", DATASET, unique, "ingested_at", "mine")
    silver = store.read_layer(spark, lake, "silver", DATASET)
    assert silver.count() == silver.select("event_id").distinct().count() == unique.count()
    assert silver.filter("batch = 'mine'").agg(F.min("seq")).first()[0] >= 400


def test_streams_with_new_checkpoints_keep_each_others_rows(spark, rows):
    folder = f"{shared_folder(spark, 'two-in')}/in"
    rows.coalesce(1).write.options(**store.JSON_OPTIONS).json(folder)
    lake = new_lake(spark, "two-runs")
    from tidewrack.sources import streams

    for run in range(2):
        writer = ingest.bronze(wire.parse_payloads(streams.payload_files(spark, folder)), lake, DATASET)
        ingest.run_available(writer.option("checkpointLocation", lake.checkpoint_path(f"run-{run}")))
    assert store.read_layer(spark, lake, "bronze", DATASET).count() == 2 * 967


def test_id_index_reads_little_and_finds_all(spark, monkeypatch):
    """Twenty batches of 2,000 ids, 20 of each batch seen before: equal to an anti-join, reads don't grow with the history."""
    lake = new_lake(spark, "index")
    opened = []
    real_opened, real_maybes = IdIndex.opened, IdIndex.maybes

    def spy_opened(self, maybes, owners):
        found = real_opened(self, maybes, owners)
        opened.append((maybes.count(), maybes.select("bucket").distinct().count()))
        return found

    monkeypatch.setattr(IdIndex, "opened", spy_opened)
    expected = set()
    for number in range(20):
        ids = list(range(number * 2000 - 20, (number + 1) * 2000)) if number else list(range(2000))
        frame = spark.createDataFrame([(f"evt-{i}", i) for i in ids], "event_id string, seq long").withColumn("arrived_at", F.lit("2026-01-01").cast("timestamp"))
        entry = medallion.add_new_ids(spark, lake, "silver", DATASET, frame, "arrived_at", f"b{number}")
        assert entry.rows == len({f"evt-{i}" for i in ids} - expected) == 2000
        expected |= {f"evt-{i}" for i in ids}
    silver = store.read_layer(spark, lake, "silver", DATASET)
    assert silver.count() == silver.select("event_id").distinct().count() == 40_000
    # no stored id is missed; of new ids, about one in a hundred looks stored at most
    assert len(opened) == 19 and all(20 <= found <= 80 for found, _ in opened)
    assert sum(found for found, _ in opened[-5:]) <= 2 * sum(found for found, _ in opened[:5]) + 40
    log = lake.log(spark, "silver", DATASET).live()
    pages = int(log[id_index.PAGES].path.rsplit("=", 1)[1])
    assert 40_000 <= pages * id_index.IDS_PER_PAGE <= 8 * 40_000
    assert len(IdIndex(spark, lake, "silver", DATASET).ids.live()) < id_index.FOLD


def test_shrunk_and_quarantined_batches_free_their_ids(spark, core):
    lake = new_lake(spark, "free")
    unique = dedupe.keep_first(core)

    def add(frame, name, state=PUBLISHED):
        return medallion.add_new_ids(spark, lake, "silver", DATASET, frame, "ingested_at", name, state).rows

    whole = unique.count()
    assert add(unique, "a") == whole and add(unique, "b") == 0
    kept = add(unique.filter("seq % 2 = 0"), "a")
    assert add(unique, "b") == whole - kept
    add(unique.filter("seq % 2 = 0"), "a", QUARANTINED)
    assert add(unique, "b") == whole
    assert store.read_layer(spark, lake, "silver", DATASET).count() == whole


def test_gold_follows_by_sums_and_reads_new_batches_only(spark, sf, rows, monkeypatch):
    lake = new_lake(spark, "sums")
    parts = [rows.filter(F.col("seq") % 4 == n) for n in range(4)]
    for number, part in enumerate(parts[:3]):
        medallion.write_batch(spark, lake, DATASET, part, f"b{number}")
    read, real = [], store.read_entry

    def spy(session, at, layer, dataset, entry, schema=None):
        read.append((layer, entry.batch))
        return real(session, at, layer, dataset, entry, schema)

    def check():
        silver = store.read_layer(spark, lake, "silver", DATASET, states=(PUBLISHED,))
        for name in gold.GOLD:
            got, want = store.read_gold(spark, lake, name), gold.GOLD[name](silver)
            assert got.exceptAll(want).count() == 0 and got.count() == want.count(), name

    check()
    monkeypatch.setattr(store, "read_entry", spy)
    medallion.write_batch(spark, lake, DATASET, parts[3], "b3")
    assert {batch for layer, batch in read if layer == "silver"} == {"b3"}
    check()
    medallion.write_batch(spark, lake, DATASET, parts[1].filter("seq < 300"), "b1")  # shrunk
    check()
    medallion.write_batch(spark, lake, DATASET, parts[2], "b2", gate=101)  # fails now
    check()
    assert medallion.batch_states(spark, lake, DATASET).filter("state = 'quarantined'").collect()[0]["batch"] == "b2"
    assert increments.publish(spark, lake, DATASET) == 0
    medallion.rebuild_silver(spark, lake, DATASET)
    increments.publish(spark, lake, DATASET)
    check()
    assert "b2" not in {r["batch"] for r in store.read_layer(spark, lake, "silver", DATASET).select("batch").distinct().collect()}


def test_report_of_counts_equals_the_report(spark, sf, rows):
    from tidewrack.operators import quality

    lake = new_lake(spark, "report")
    stored = medallion.write_batch(spark, lake, DATASET, rows, "b0").first()
    want = quality.quality_report(txn(spark, sf), DATASET).first()
    assert {k: str(v) for k, v in stored.asDict().items()} == {k: str(v) for k, v in want.asDict().items()}


def test_raw_is_parsed_once_per_batch(spark, rows, monkeypatch):
    lake, parsed, real = new_lake(spark, "once"), [], wire.parse_payloads
    monkeypatch.setattr(wire, "parse_payloads", lambda raw: parsed.append(1) or real(raw))
    medallion.write_batch(spark, lake, DATASET, rows, "b0")
    assert len(parsed) == 1


def test_batches_without_rows(spark, rows):
    lake = new_lake(spark, "empty")
    none = rows.filter("seq < 0")
    report = medallion.write_batch(spark, lake, DATASET, none, "b0").first()
    assert report["records"] == 0 and sizes(spark, lake) == dict.fromkeys(("raw", "bronze", "quarantine", "silver", "gold"), 0)
    medallion.write_batch(spark, lake, DATASET, rows, "b1")
    medallion.write_batch(spark, lake, DATASET, none, "b1")  # shrinks to nothing
    assert sizes(spark, lake)["silver"] == sizes(spark, lake)["gold"] == 0


def test_keys_stay_and_racing_loads_agree(spark, monkeypatch):
    root = shared_folder(spark, "keys")
    registry = warehouse.KeyRegistry(spark, root)

    def countries(*codes):
        return spark.createDataFrame([(c,) for c in codes], "country string")

    first = {r["country"]: r["country_key"] for r in registry.register("country", countries("GB", "FR", "DE")).collect()}
    assert sorted(first.values()) == [1, 2, 3]
    real, raced = warehouse.dense_key, []

    def dense_key(*args):
        if not raced:
            raced.append(True)
            registry.register("country", countries("US", "IT"))
        return real(*args)

    monkeypatch.setattr(warehouse, "dense_key", dense_key)
    after = {r["country"]: r["country_key"] for r in registry.register("country", countries("US", "GB", "ES")).collect()}
    assert first.items() <= after.items() and sorted(after.values()) == [1, 2, 3, 4, 5, 6] and set(after) == {"GB", "FR", "DE", "US", "IT", "ES"}
    assert registry.register("country", countries("US")).count() == 6
    assert registry.register("customer", spark.createDataFrame([], "customer_id string")).count() == 0


def test_expiry_drops_by_names_and_vacuum_takes_the_files(spark, rows):
    lake = new_lake(spark, "expiry")
    store.land_raw(rows.filter("seq < 500"), lake, DATASET, "old")
    store.land_raw(rows.filter("seq >= 500"), lake, DATASET, "new")
    days = sorted(r[0] for r in store.read_raw(spark, lake, DATASET).select(F.to_date("arrived_at").cast("string")).distinct().collect())
    limit = days[len(days) // 2 + 3]
    dropped = store.expire(spark, lake, "raw", DATASET, limit)
    assert sorted({day for _, day in dropped}) == [d for d in days if d < limit]
    left = store.read_raw(spark, lake, DATASET)
    assert left.agg(F.min(F.to_date("arrived_at").cast("string"))).first()[0] == limit
    live = lake.log(spark, "raw", DATASET).live()
    assert "old" not in live and live["new"].hidden_before == limit
    assert store.expire(spark, lake, "raw", DATASET, limit) == []
    assert store.expired_partitions(spark, lake, "raw", DATASET).count() == len(dropped)
    before = left.count()
    gone = store.vacuum(spark, lake, "raw", DATASET, older_than_ms=-60_000)
    assert len(gone) == 1 + sum(batch == "new" for batch, _ in dropped) and store.read_raw(spark, lake, DATASET).count() == before
    # a repeat of the batch brings its days back, until the next expiry
    store.land_raw(rows.filter("seq >= 500"), lake, DATASET, "new")
    assert store.expire(spark, lake, "raw", DATASET, limit)


def test_day_range_opens_only_batches_that_overlap(spark, rows):
    lake = new_lake(spark, "zones")
    for number in range(4):
        store.land_raw(rows.filter(F.col("seq").between(250 * number, 250 * number + 249)), lake, DATASET, f"b{number}")
    entries = store.live_entries(spark, lake, "raw", DATASET)
    limit = sorted(e.first_day for e in entries)[2]
    assert {e.batch for e in store.live_entries(spark, lake, "raw", DATASET, first=limit)} < {e.batch for e in entries}
    only = store.read_raw(spark, lake, DATASET, store.partition_hours(limit, "9999-12-31"), limit, "9999-12-31")
    assert only.count() == store.read_raw(spark, lake, DATASET).filter(F.to_date("arrived_at") >= limit).count()


def test_backfill_below_the_gate_is_quarantined(spark, rows):
    lake = new_lake(spark, "backfill-gate")
    store.land_raw(rows, lake, DATASET, "landed")
    backfill.run(spark, lake, DATASET, "2024-01-01", "2024-01-30", gate=101)
    assert sizes(spark, lake)["silver"] == sizes(spark, lake)["gold"] == 0 and sizes(spark, lake)["bronze"] == 967


def test_offsets_behind():
    assert progress.offsets_behind('{"t":{"0":15,"1":7}}', '{"t":{"0":10,"1":7}}') == 5
    assert progress.offsets_behind('{"t":{"0":15,"1":7}}', None) == 22
    assert progress.offsets_behind({"logOffset": 3}, {"logOffset": 1}) == 2
    assert progress.offsets_behind("4", "3") == 1 and progress.offsets_behind(None, "3") is None


def test_salts_follow_the_sketch(spark):
    """A key with 40 % of the rows and one with 15 %: no partition gets twice the mean, other keys stay whole."""
    hot = F.when(F.col("id") % 100 < 40, "a").when(F.col("id") % 100 < 55, "b").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    events = spark.range(100_000).select(hot.alias("customer_id"), F.col("id").alias("seq"), F.col("id").cast("string").alias("event_id"))
    heavy = layout.heavy_keys(events, DATASET, 32)
    assert set(heavy) == {"a", "b"} and abs(heavy["a"] - 40_000) < 2_000
    spread = layout.distribute_adaptively(events, DATASET, 32).withColumn("at", F.spark_partition_id())
    assert spread.groupBy("at").count().agg(F.max("count")).first()[0] < 2 * 100_000 / 32
    places = spread.filter("customer_id NOT IN ('a', 'b')").groupBy("customer_id").agg(F.count_distinct("at").alias("n"))
    assert places.agg(F.max("n")).first()[0] == 1
    assert layout.distribute_adaptively(events.limit(0), DATASET, 4).count() == 0
