"""Raw to bronze, quarantine, silver and gold: as one lazy plan, and as stored jobs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.operators import dedupe, enrich, gold, pii, quality
from tidewrack.plans import increments
from tidewrack.schemas import RAW_SCHEMA
from tidewrack.sources import lake as store
from tidewrack.sources import wire
from tidewrack.sources.commits import PUBLISHED, QUARANTINED, Conflict, Entry
from tidewrack.sources.id_index import IdIndex
from tidewrack.sources.lake import Lake


def bronze(events: DataFrame, dataset: str, ingested_at: Column | None = None) -> DataFrame:
    return enrich.enrich(quality.accepted_rows(events, dataset), ingested_at)


def silver_core(events: DataFrame, dataset: str, ingested_at: Column | None = None) -> DataFrame:
    """Clear silver without country names: the input of gold."""
    return dedupe.keep_first(
        enrich.derive(quality.accepted_rows(events, dataset), ingested_at)
    )


def silver(
    events: DataFrame, dataset: str, ingested_at: Column | None = None, policy: str = "analyst"
) -> DataFrame:
    """Validate, then keep the first copy, then enrich and mask.

    The country join and masking come after de-duplication, so dropped copies cost
    nothing further.
    """
    kept = enrich.with_country_name(silver_core(events, dataset, ingested_at))
    return pii.apply_policy(kept, policy)


def layers(events: DataFrame, dataset: str, ingested_at: Column | None = None) -> dict[str, DataFrame]:
    """Every layer of one dataset as lazy frames."""
    core = silver_core(events, dataset, ingested_at)
    return {
        "raw": events,
        "bronze": bronze(events, dataset, ingested_at),
        "quarantine": quality.rejected_rows(events, dataset),
        "silver": silver(events, dataset, ingested_at),
        **{f"gold_{name}": frame for name, frame in gold.gold_tables(core).items()},
        "quality_report": quality.quality_report(events, dataset),
    }


def silver_from_bronze(stored: DataFrame) -> DataFrame:
    """Stored bronze (already valid and enriched) to masked silver."""
    kept = dedupe.keep_first(stored)
    return pii.apply_policy(kept, "analyst")


def stage(
    events: DataFrame, lake: Lake, dataset: str, batch_id: str, ingested_at: Column | None = None
) -> tuple[Entry, Entry, dict[str, int]]:
    """One read of raw for both sinks and the report: the batch's accepted and rejected rows, enriched, in one write.

    Gives the entries of both, not yet published, and the counts observed while writing. The write
    follows raw's partitions without a shuffle unless a stamp of its own is asked for.
    """
    stamp = F.col("arrived_at") if ingested_at is None else ingested_at
    good = F.coalesce(quality.is_accepted(dataset), F.lit(False))
    flagged = events.withColumns(
        {"batch": F.when(good, F.lit(batch_id)).otherwise(F.lit(f"{batch_id}.rejected")), "reasons": quality.reasons(dataset), "_risk": F.col("risk_score")}
    )
    counted = Observation()
    flagged = flagged.withColumns({"_complete": quality.is_complete(dataset), "_valid": quality.is_valid()})
    seen = flagged.observe(
        counted, F.count(F.lit(1)).alias("records"), F.count_if("_complete").alias("complete"), F.count_if("_valid").alias("valid"),
        F.count_if(F.col("batch") == batch_id).alias("good"),
    ).drop("_complete", "_valid")
    # a rejected row keeps the risk it came with
    risk = F.when(F.col("batch") == batch_id, F.col("risk_score")).otherwise(F.col("_risk"))
    rows = enrich.enrich(seen, stamp).withColumn("risk_score", risk).drop("_risk")
    names = [batch_id, f"{batch_id}.rejected"]
    gather = ingested_at is not None and not lake.packed  # ranging samples its input, which would count rows twice
    entries = store.store_rows(rows, lake, "bronze", dataset, "ingested_at", gather, batches=names)
    return entries[names[0]], entries[names[1]], counted.get


def write_batch(
    spark: SparkSession, lake: Lake, dataset: str, payloads: DataFrame, batch_id: str,
    ingested_at: Column | None = None, gate: float = domain.PUBLISH_GATE_SCORE,
) -> DataFrame:
    """Store one batch in all layers; repeating it gives the same lake.

    A batch whose score is below ``gate`` is quarantined in silver: neither its readers nor gold see it, and
    its ids count as not stored. Repeating the batch with better rows publishes it.

    Each stage reads what the previous stage stored, so a lost executor costs a
    stage's tasks and never the whole chain. Returns the batch's quality report.
    """
    landed = store.land_raw(payloads, lake, dataset, batch_id)
    raw = store.read_entry(spark, lake, "raw", dataset, landed, RAW_SCHEMA.toDDL())
    events = wire.parse_payloads(raw.select("payload", "arrived_at", "seq"))
    accepted, rejected, counts = stage(events, lake, dataset, batch_id, ingested_at)
    both = None
    for entry, good in ((accepted, True), (rejected, False)):
        if entry.path:
            part = store.read_entry(spark, lake, "bronze", dataset, entry).withColumn("good", F.lit(good))
            both = part if both is None else both.unionByName(part)
    lake.log(spark, "bronze", dataset).commit([accepted])
    refused = events.limit(0).withColumn("reasons", F.array().cast("array<string>"))
    if rejected.path:
        refused = store.read_entry(spark, lake, "bronze", dataset, rejected).select(*refused.columns)
    store.write_batch(refused, lake, "quarantine", dataset, "arrived_at", batch_id)
    ids = ["event_id", "arrived_at", "seq", "good"]
    report = quality.report_of_counts(events.limit(0).withColumn("good", F.lit(True)).select(ids) if both is None else both.select(ids), counts, dataset)
    store.write_report(report, lake, dataset)
    stored_report = spark.read.schema(report.schema).json(lake.report_path(dataset))
    state = PUBLISHED if stored_report.first()["score"] >= gate else QUARANTINED
    append_silver(spark, lake, dataset, batch_id, state)
    increments.publish(spark, lake, dataset)
    return stored_report


def without_folders(rows: DataFrame) -> DataFrame:
    return rows.drop("year", "month", "day", "hour", "batch", "reasons")


def append_silver(spark: SparkSession, lake: Lake, dataset: str, batch_id: str, state: str = PUBLISHED) -> None:
    """Add a bronze batch's new ids to silver; ids stored by other batches are skipped."""
    entry = lake.log(spark, "bronze", dataset).live()[batch_id]
    if not entry.path:
        lake.log(spark, "silver", dataset).commit([Entry(batch_id, "", state, 0)])
        return
    kept, in_place = dedupe.keep_first_stored(store.read_entry(spark, lake, "bronze", dataset, entry))
    # bronze has silver's partitions, so rows are written where they are; packed layers are ranged
    gather = lake.packed or not in_place
    add_new_ids(spark, lake, "silver", dataset, pii.apply_policy(without_folders(kept), "analyst"), "ingested_at", batch_id, state, gather)


def add_to_silver(
    spark: SparkSession, lake: Lake, dataset: str, unique: DataFrame, time_column: str, batch_id: str, state: str = PUBLISHED
) -> None:
    """Mask and store rows (one per id) whose id no other batch has stored."""
    add_new_ids(spark, lake, "silver", dataset, pii.apply_policy(unique, "analyst"), time_column, batch_id, state)


def add_new_ids(
    spark: SparkSession, lake: Lake, layer: str, dataset: str, unique: DataFrame, time_column: str, batch_id: str, state: str = PUBLISHED, gather: bool = True
) -> Entry:
    """Publish the rows (one per id) whose id no other live batch of the layer has stored.

    The publication holds only if no other writer has published since the ids were looked up; else they are looked
    up again. So writers of one layer never store an id twice.
    """
    log, index = lake.log(spark, layer, dataset), IdIndex(spark, lake, layer, dataset)
    store.checked_name(batch_id)
    while True:
        version, live = log.state()
        unseen, in_place = index.unseen(unique, live, batch_id)
        fresh = unseen.withColumn("batch", F.lit(batch_id))
        entry = store.store_rows(fresh, lake, layer, dataset, time_column, gather or not in_place, batches=[batch_id])[batch_id]
        add = [replace(entry, state=state)]
        if entry.path:
            others = sum(e.rows or 0 for e in live.values() if e.batch != batch_id)
            add.append(index.add(store.read_entry(spark, lake, layer, dataset, entry), entry.attempt, live, others + entry.rows))
        try:
            log.commit(add, expected=version)
        except Conflict:
            continue
        index.fold()
        return add[0]


def set_state(spark: SparkSession, lake: Lake, dataset: str, batch_id: str, state: str) -> None:
    """Publish or quarantine a silver batch. Only names change; gold follows with its next publication."""
    log = lake.log(spark, "silver", dataset)
    while True:
        version, live = log.state()
        if batch_id not in live:
            raise LookupError(f"silver/{dataset} has no batch {batch_id!r}")
        try:
            log.commit([replace(live[batch_id], state=state)], expected=version)
            return
        except Conflict:
            continue


def batch_states(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """The ledger of silver's batches: batch, state, rows and day range."""
    entries = [e for e in lake.log(spark, "silver", dataset).live().values() if not e.batch.startswith("_")]
    rows = [(e.batch, e.state, e.rows, e.first_day, e.last_day) for e in entries]
    return spark.createDataFrame(rows, "batch string, state string, rows long, first_day string, last_day string")


def rebuild_silver(spark: SparkSession, lake: Lake, dataset: str) -> None:
    """Full batch job bronze to silver, replacing the whole layer; quarantined batches stay out.

    Each row keeps the batch that brought it, so batches can be added or repeated afterwards.
    """
    log = lake.log(spark, "silver", dataset)
    version, live = log.state()
    barred = {name: entry for name, entry in live.items() if entry.state == QUARANTINED}
    entries = [entry for entry in store.live_entries(spark, lake, "bronze", dataset) if entry.batch not in barred]
    stored = store.read_entries(spark, lake, "bronze", dataset, entries)
    kept = silver_from_bronze(stored.drop("year", "month", "day", "hour", "reasons"))
    rebuilt = store.store_rows(kept, lake, "silver", dataset, "ingested_at")
    pages = []
    if rebuilt:
        written = store.read_entries(spark, lake, "silver", dataset, list(rebuilt.values()))
        sizes = {row["batch"]: row["count"] for row in written.groupBy("batch").count().collect()}  # one row per batch
        rebuilt = {name: replace(entry, rows=sizes[name]) for name, entry in rebuilt.items()}
        attempt = next(iter(rebuilt.values())).attempt
        pages = [IdIndex(spark, lake, "silver", dataset).add(written, attempt, live, sum(sizes.values()))]
    log.commit([*rebuilt.values(), *pages, *barred.values()], live.keys() - barred.keys(), version)


def publish_gold(spark: SparkSession, lake: Lake, dataset: str) -> None:
    """Published silver batches to the six gold tables."""
    increments.publish(spark, lake, dataset)
