"""Every operator as a named query ``(spark, table folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewrack import schemas
from tidewrack.functions.calendar import lag_micros, with_partitions
from tidewrack.functions.values import or_default
from tidewrack.operators import (
    anomaly,
    dedupe,
    drift,
    enrich,
    gold,
    layout,
    lineage,
    personas,
    pii,
    quality,
    warehouse,
)
from tidewrack.plans import backfill, gate, increments, medallion, observability
from tidewrack.session import configure, shared_folder
from tidewrack.sources import catalog, fixtures, streams, wire
from tidewrack.sources import lake as store
from tidewrack.sources.lake import Lake
from tidewrack.streaming import ingest, metrics, progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DATASET = "transactions"

BRONZE_COLUMNS = (
    "seq", "event_id", "customer_id", "event_type", "amount_raw", "amount", "currency", "country",
    "device", "event_ts", "arrived_at", "merchant_id", "merchant_category", "email", "phone",
    "ip_address", "customer_name", "address", "device_id", "service", "level", "schema_version",
    "risk_score", "country_name", "amount_gbp", "event_date", "event_hour", "is_fraud",
)


def query(function: Query) -> Query:
    """Register under the function's name, with the session settings applied."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return run


def plain(frame: DataFrame) -> DataFrame:
    """Show instants as UTC wall-clock values."""
    instants = [f.name for f in frame.schema if isinstance(f.dataType, T.TimestampType)]
    return frame.withColumns({n: F.col(n).cast("timestamp_ntz") for n in instants}) if instants else frame


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.transactions(spark, sf_dir)


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver_core(txn(spark, sf_dir), DATASET, F.col("arrived_at"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.bronze(txn(spark, sf_dir), DATASET, F.col("arrived_at"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire.to_payload(txn(spark, sf_dir))


def new_lake(spark: SparkSession, label: str, grain: str = "day", packed: bool = False) -> Lake:
    return Lake(shared_folder(spark, label), grain, packed)


def two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The payloads before the middle of the arrivals, and the rest."""
    rows = payloads(spark, sf_dir)
    first, last = rows.agg(F.min("arrived_at"), F.max("arrived_at")).first()
    middle = first + (last - first) / 2
    return rows.filter(F.col("arrived_at") < F.lit(middle)), rows.filter(F.col("arrived_at") >= F.lit(middle))


def loaded_lake(spark: SparkSession, sf_dir: str, label: str, grain: str = "day", packed: bool = False) -> Lake:
    """A lake that two batches were written to."""
    lake = new_lake(spark, label, grain, packed)
    for number, part in enumerate(two_batches(spark, sf_dir)):
        medallion.write_batch(spark, lake, DATASET, part, f"b{number}")
    return lake


def layer_frames(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The stored layers' rows (raw typed; quarantine by number, arrival and reasons)."""
    rejected = "seq BIGINT, arrived_at TIMESTAMP, reasons ARRAY<STRING>"
    return {
        "raw": store.read_raw(spark, lake, DATASET),
        "bronze": store.read_layer(spark, lake, "bronze", DATASET),
        "quarantine": store.read_layer(spark, lake, "quarantine", DATASET, rejected),
        "silver": store.read_layer(spark, lake, "silver", DATASET),
    }


def joined_reasons() -> Column:
    return F.array_join("reasons", "; ").alias("reasons")


# --- fixture, sources and sinks -------------------------------------------------


@query
def txn_fixture(spark, sf_dir):
    return with_partitions(txn(spark, sf_dir).drop("message"), "arrived_at")


@query
def raw_parse_json(spark, sf_dir):
    parsed = F.from_json("props", "k BIGINT")
    return fixtures.table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query
def raw_scan_json(spark, sf_dir):
    lake = new_lake(spark, "raw-scan")
    path = lake.path("raw", DATASET)
    payloads(spark, sf_dir).select("payload").write.text(path)
    return wire.read_event_json(spark, path).select(
        "event_id", "customer_id", "event_type", "amount_raw", "amount", "currency", "country",
        "event_ts", "merchant_id", "email", "level", "schema_version", "risk_score",
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


@query
def raw_landing(spark, sf_dir):
    lake = new_lake(spark, "raw-landing")
    for _ in range(2):  # the repeat replaces the batch
        store.land_raw(payloads(spark, sf_dir), lake, DATASET, "b1")
    return store.read_raw(spark, lake, DATASET).select(
        "seq", "arrived_at", "event_id", "amount", "event_ts", "risk_score",
        quality.wrong_type_amount().alias("wrong_type"),
    )


@query
def bronze_roundtrip(spark, sf_dir):
    lake = new_lake(spark, "bronze")
    store.write_batch(bronze(spark, sf_dir), lake, "bronze", DATASET, "event_ts", "b1")
    stored = store.read_layer(spark, lake, "bronze", DATASET)
    return stored.select(*BRONZE_COLUMNS, "year", "month", "day")


@query
def quarantine_roundtrip(spark, sf_dir):
    lake = new_lake(spark, "quarantine")
    rejected = quality.rejected_rows(txn(spark, sf_dir), DATASET)
    store.write_batch(rejected, lake, "quarantine", DATASET, "arrived_at", "b1")
    stored = store.read_layer(spark, lake, "quarantine", DATASET, "seq BIGINT, event_id STRING, amount_raw STRING, reasons ARRAY<STRING>")
    return stored.select("seq", "event_id", "amount_raw", joined_reasons())


@query
def silver_overwrite(spark, sf_dir):
    lake = new_lake(spark, "silver")
    rows = medallion.silver(txn(spark, sf_dir), DATASET, F.col("arrived_at"))
    store.overwrite_partitions(rows, lake, "silver", DATASET, "ingested_at")
    # replacing one day must leave the others alone
    day = store.read_layer(spark, lake, "silver", DATASET).filter("month = '01' AND day = '05'")
    one_day = new_lake(spark, "silver-day").path("silver", DATASET)
    day.drop("year", "month", "day", "batch").write.parquet(one_day)
    store.overwrite_partitions(spark.read.parquet(one_day), lake, "silver", DATASET, "ingested_at")
    return store.read_layer(spark, lake, "silver", DATASET).select("event_id", "amount_gbp", "email", "year", "month", "day")


@query
def gold_scan(spark, sf_dir):
    lake = new_lake(spark, "gold")
    store.write_gold(gold.gold_tables(core(spark, sf_dir)), lake, DATASET)
    return store.read_gold(spark, lake, "customer_activity")


@query
def quality_report_roundtrip(spark, sf_dir):
    lake = new_lake(spark, "report")
    report = quality.quality_report(txn(spark, sf_dir), DATASET)
    store.write_report(report, lake, DATASET)
    return spark.read.schema(report.schema).json(lake.report_path(DATASET))


@query
def partition_counts(spark, sf_dir):
    return layout.partition_counts(with_partitions(bronze(spark, sf_dir), "event_ts"))


@query
def partition_pruned(spark, sf_dir):
    lake = new_lake(spark, "pruned", "hour")
    rows = bronze(spark, sf_dir).select("seq", "event_ts", "amount_gbp")
    store.write_batch(rows, lake, "bronze", DATASET, "event_ts", "b1")
    hours = F.col("hour").between("06", "11")
    return (
        store.read_layer(spark, lake, "bronze", DATASET, first="2024-01-10", last="2024-01-19")
        .filter(store.partition_hours("2024-01-10", "2024-01-19") & hours)
        .groupBy("day", "hour")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("amount_gbp").cast("decimal(18,2)").alias("volume"))
    )


@query
def hours_by_zones(spark, sf_dir):
    """Nine days and eleven hours of silver, from a lake of hour grain that keeps hours in shared files."""
    lake = loaded_lake(spark, sf_dir, "zones", "hour", packed=True)
    since, until = datetime(2024, 1, 10, 6), datetime(2024, 1, 19, 17)
    rows = store.read_between(spark, lake, "silver", DATASET, since, until)
    by_hour = with_partitions(rows, "ingested_at", ("day", "hour"))
    return by_hour.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("records"), F.sum("amount_gbp").cast("decimal(18,2)").alias("volume"))


@query
def compacted_bronze(spark, sf_dir):
    """Bronze of two batches in day folders, compacted, with one of the batches repeated after that."""
    lake = loaded_lake(spark, sf_dir, "compacted")
    store.compact(spark, lake, "bronze", DATASET, "ingested_at")
    medallion.write_batch(spark, lake, DATASET, two_batches(spark, sf_dir)[1], "b1")
    return (
        store.read_layer(spark, lake, "bronze", DATASET)
        .groupBy(F.col("event_date"))
        .agg(F.count(F.lit(1)).alias("records"), F.sum("amount_gbp").cast("decimal(18,2)").alias("volume"))
    )


@query
def dataset_inventory(spark, sf_dir):
    events = txn(spark, sf_dir)
    lake = new_lake(spark, "inventory")
    medallion.write_batch(spark, lake, DATASET, wire.to_payload(events), "b1")
    return store.stored_inventory(spark, lake, [DATASET])


@query
def layer_reconciliation(spark, sf_dir):
    """Of a lake that two batches stored."""
    return lineage.layer_counts(layer_frames(spark, loaded_lake(spark, sf_dir, "reconciliation")))


@query
def key_distribution(spark, sf_dir):
    return layout.key_distribution(txn(spark, sf_dir), DATASET)


@query
def key_distribution_iot(spark, sf_dir):
    return layout.key_distribution(txn(spark, sf_dir), "iot")


@query
def key_distribution_logs(spark, sf_dir):
    return layout.key_distribution(txn(spark, sf_dir), "logs")


# --- quality --------------------------------------------------------------------


@query
def quality_flags(spark, sf_dir):
    return quality.with_flags(txn(spark, sf_dir), DATASET).select(
        "seq", "event_id", "is_complete", "is_valid", "is_duplicate", joined_reasons()
    )


@query
def quarantine_rows(spark, sf_dir):
    return quality.rejected_rows(txn(spark, sf_dir), DATASET).select(
        "seq", "event_id", "customer_id", "amount_raw", "currency", "event_ts", joined_reasons()
    )


@query
def bronze_rows(spark, sf_dir):
    return bronze(spark, sf_dir).select(*BRONZE_COLUMNS)


@query
def bronze_rows_logs(spark, sf_dir):
    accepted = quality.accepted_rows(txn(spark, sf_dir), "logs")
    return accepted.groupBy("level").agg(F.count(F.lit(1)).alias("records"))


@query
def stream_filter_rows(spark, sf_dir):
    return txn(spark, sf_dir).filter(quality.stream_accepts()).select("seq", "event_id", "amount", "currency")


@query
def invalid_antijoin(spark, sf_dir):
    events = txn(spark, sf_dir)
    return quality.invalid_by_anti_join(events, events.filter(quality.stream_accepts())).select(
        "seq", "event_id", "quarantine_reason"
    )


@query
def quality_report(spark, sf_dir):
    return quality.quality_report(txn(spark, sf_dir), DATASET)


@query
def quality_report_logs(spark, sf_dir):
    return quality.quality_report(txn(spark, sf_dir), "logs")


@query
def quality_issues(spark, sf_dir):
    return quality.quality_issues(txn(spark, sf_dir), DATASET)


@query
def quality_scan(spark, sf_dir):
    return quality.quality_scan(txn(spark, sf_dir))


@query
def quality_scan_rows(spark, sf_dir):
    return txn(spark, sf_dir).filter(quality.scan_defect()).select("seq", "event_id", "currency", "amount")


@query
def duplicate_ids(spark, sf_dir):
    return quality.duplicate_ids(txn(spark, sf_dir))


@query
def batch_gate(spark, sf_dir):
    return gate.decide(quality.quality_report(txn(spark, sf_dir), DATASET)).select(
        "dataset", "records", "score", "decision", "warning"
    )


@query
def gated_publish(spark, sf_dir):
    """Runs the gate both ways: once publishing gold, once quarantining."""
    events = txn(spark, sf_dir)
    lake = new_lake(spark, "gate")
    store.write_batch(
        medallion.silver(events, DATASET, F.col("arrived_at")),
        lake, "silver", DATASET, "ingested_at", "b1",
    )
    gate.gated_publish(spark, lake, DATASET, events, "b1")
    gate.gated_publish(spark, lake, DATASET, events, "b2", gate=101)
    return store.stored_inventory(spark, lake, [DATASET])


# --- silver and masking ---------------------------------------------------------


@query
def silver_rows(spark, sf_dir):
    rows = enrich.with_country_name(core(spark, sf_dir))
    return rows.select(*[c for c in BRONZE_COLUMNS if c not in ("email", "phone", "ip_address", "customer_name", "address")])


@query
def silver_pii_masked(spark, sf_dir):
    return medallion.silver(txn(spark, sf_dir), DATASET, F.col("arrived_at")).select(
        "event_id", "email", "phone", "ip_address", "customer_name", "address"
    )


@query
def pii_restricted(spark, sf_dir):
    rows = medallion.silver(txn(spark, sf_dir), DATASET, F.col("arrived_at"), policy="restricted")
    return rows.drop("ingested_at", "message", "timestamp")


@query
def pii_administrator(spark, sf_dir):
    rows = medallion.silver(txn(spark, sf_dir), DATASET, F.col("arrived_at"), policy="administrator")
    return rows.select("event_id", "email", "phone", "ip_address", "customer_name", "address")


@query
def pii_audit(spark, sf_dir):
    return pii.audit(medallion.silver(txn(spark, sf_dir), DATASET, F.col("arrived_at")))


@query
def pii_audit_bronze(spark, sf_dir):
    return pii.audit(bronze(spark, sf_dir))


@query
def lineitem_keep_first(spark, sf_dir):
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
    ]
    return dedupe.keep_first(
        fixtures.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order
    )


# --- gold -----------------------------------------------------------------------


@query
def gold_daily_revenue(spark, sf_dir):
    return gold.daily_revenue(core(spark, sf_dir))


@query
def gold_customer_activity(spark, sf_dir):
    return gold.customer_activity(core(spark, sf_dir))


@query
def gold_country_performance(spark, sf_dir):
    return gold.country_performance(core(spark, sf_dir))


@query
def gold_fraud_summary(spark, sf_dir):
    return gold.fraud_summary(core(spark, sf_dir))


@query
def gold_merchant_statistics(spark, sf_dir):
    return gold.merchant_statistics(core(spark, sf_dir))


@query
def gold_system_performance(spark, sf_dir):
    return gold.system_performance(core(spark, sf_dir))


@query
def gold_orders_daily_revenue(spark, sf_dir):
    events = fixtures.order_transactions(spark, sf_dir)
    rows = quality.accepted_rows(events, DATASET).withColumn("risk_score", F.lit(None).cast("decimal(5,3)"))
    return gold.daily_revenue(
        dedupe.keep_first(enrich.derive(rows.withColumn("country", F.lit(None).cast("string")), F.col("arrived_at")))
    )


@query
def fraud_events(spark, sf_dir):
    return core(spark, sf_dir).filter("is_fraud").select("event_id", "country", "amount_gbp", "risk_score")


@query
def active_customers(spark, sf_dir):
    return gold.active_customers(core(spark, sf_dir))


@query
def kpi_summary(spark, sf_dir):
    return gold.kpi_summary(core(spark, sf_dir))


@query
def revenue_trend(spark, sf_dir):
    return gold.revenue_trend(gold.daily_revenue(core(spark, sf_dir)))


@query
def top_countries(spark, sf_dir):
    return gold.top_by_volume(gold.country_performance(core(spark, sf_dir)), "country")


@query
def top_merchants(spark, sf_dir):
    return gold.top_by_volume(gold.merchant_statistics(core(spark, sf_dir)), "merchant_category")


# --- SQL over named tables ------------------------------------------------------


def sql(spark, sf_dir, text: str) -> DataFrame:
    silver = core(spark, sf_dir)
    catalog.register_gold(gold.gold_tables(silver), silver)
    return spark.sql(text)


@query
def country_volume(spark, sf_dir):
    return gold.volume_by_country(gold.gold_tables(core(spark, sf_dir))["country_performance"], F.count("*"))


@query
def country_volume_total(spark, sf_dir):
    return gold.volume_by_country(gold.gold_tables(core(spark, sf_dir))["country_performance"], F.sum("transactions"))


@query
def fraud_window(spark, sf_dir):
    return gold.fraud_days(gold.gold_tables(core(spark, sf_dir))["fraud_summary"])


@query
def readme_query(spark, sf_dir):
    return sql(
        spark, sf_dir,
        "SELECT country, SUM(volume) AS volume FROM gold_transactions GROUP BY country "
        "ORDER BY volume DESC NULLS LAST",
    )


@query
def select_star(spark, sf_dir):
    return sql(spark, sf_dir, "SELECT * FROM gold_merchant_statistics")


@query
def select_alias(spark, sf_dir):
    return sql(spark, sf_dir, "SELECT metric_date AS day, volume AS revenue FROM gold_daily_revenue")


@query
def where_filter(spark, sf_dir):
    return sql(
        spark, sf_dir,
        "SELECT event_id, amount_gbp FROM silver_transactions WHERE currency = 'EUR' AND amount_gbp > 40.5",
    )


@query
def where_not_equal(spark, sf_dir):
    return sql(spark, sf_dir, "SELECT country, volume FROM gold_country_performance WHERE country != 'GB'")


@query
def group_multi_key(spark, sf_dir):
    return sql(
        spark, sf_dir,
        "SELECT country, currency, COUNT(*) AS n, SUM(amount_gbp) AS total, "
        "CAST(ROUND(SUM(amount_gbp) / COUNT(amount_gbp), 2) AS DECIMAL(18,2)) AS mean "
        "FROM silver_transactions GROUP BY country, currency",
    )


@query
def group_count_col(spark, sf_dir):
    return sql(
        spark, sf_dir,
        "SELECT device, COUNT(*) AS n, COUNT(device_id) AS with_device_id, COUNT(service) AS with_service "
        "FROM silver_transactions GROUP BY device",
    )


@query
def order_nulls_last_limit(spark, sf_dir):
    return sql(
        spark, sf_dir,
        "SELECT metric_date, avg_risk FROM gold_fraud_summary "
        "ORDER BY avg_risk DESC NULLS LAST, metric_date LIMIT 7",
    )


# --- lateness, retention, personas ----------------------------------------------


@query
def late_events(spark, sf_dir):
    return txn(spark, sf_dir).filter(enrich.late_event()).select(
        "seq", "event_id", "event_ts", "arrived_at",
        F.floor(lag_micros("event_ts", "arrived_at") / 1_000_000).cast("bigint").alias("lag_seconds"),
    )


@query
def lateness_histogram(spark, sf_dir):
    return anomaly.lateness_histogram(txn(spark, sf_dir))


@query
def retention_live(spark, sf_dir):
    events = txn(spark, sf_dir)
    now = events.agg(F.max("arrived_at")).scalar()
    live = layout.live_rows(events, "raw", now)
    return live.groupBy(F.to_date("arrived_at").alias("day")).agg(F.count(F.lit(1)).alias("records"))


@query
def retention_expired(spark, sf_dir):
    events = txn(spark, sf_dir)
    now = events.agg(F.max("arrived_at")).scalar()
    return layout.expired_days(events, "raw", now)


@query
def persona_finance(spark, sf_dir):
    table = gold.country_performance(core(spark, sf_dir))
    return personas.view_for("finance_analyst", "gold", table, "country_performance")


@query
def persona_analyst(spark, sf_dir):
    rows = enrich.with_country_name(core(spark, sf_dir))
    return personas.view_for("data_analyst", "silver", rows).select(
        "event_id", "country_name", "email", "phone", "amount_gbp"
    )


@query
def persona_security(spark, sf_dir):
    table = gold.fraud_summary(core(spark, sf_dir))
    return personas.view_for("security_analyst", "gold", table, "fraud_summary")


@query
def persona_security_quarantine(spark, sf_dir):
    rejected = quality.rejected_rows(txn(spark, sf_dir), DATASET)
    return personas.view_for("security_analyst", "quarantine", rejected).select(
        "event_id", "seq", joined_reasons()
    )


@query
def persona_auditor(spark, sf_dir):
    table = gold.system_performance(core(spark, sf_dir))
    return personas.view_for("auditor", "gold", table, "system_performance")


# --- anomaly and observability --------------------------------------------------


@query
def anomaly_metrics(spark, sf_dir):
    return anomaly.anomaly_metrics(txn(spark, sf_dir), DATASET)


@query
def anomaly_baseline(spark, sf_dir):
    return anomaly.with_baseline(anomaly.anomaly_metrics(txn(spark, sf_dir), DATASET))


def found_alerts(spark, sf_dir) -> DataFrame:
    found = anomaly.anomaly_metrics(txn(spark, sf_dir), DATASET)
    return anomaly.detect(anomaly.with_baseline(found))


@query
def anomaly_alerts(spark, sf_dir):
    return found_alerts(spark, sf_dir)


@query
def alert_text(spark, sf_dir):
    return anomaly.alert_text(found_alerts(spark, sf_dir))


@query
def lag_per_minute(spark, sf_dir):
    return anomaly.lag_per_minute(txn(spark, sf_dir))


@query
def alarm_m_of_n(spark, sf_dir):
    return anomaly.alarm_m_of_n(anomaly.lag_per_minute(txn(spark, sf_dir)))


@query
def throughput_per_minute(spark, sf_dir):
    return anomaly.throughput_per_minute(payloads(spark, sf_dir))


@query
def sliding_lookback(spark, sf_dir):
    return anomaly.sliding_look_back(txn(spark, sf_dir))


@query
def observability_snapshot(spark, sf_dir):
    return observability.snapshot(txn(spark, sf_dir), DATASET)


@query
def pipeline_health(spark, sf_dir):
    return observability.health(txn(spark, sf_dir), DATASET)


# --- backfill -------------------------------------------------------------------


@query
def backfill_plan(spark, sf_dir):
    return backfill.plan_of(txn(spark, sf_dir))


@query
def backfill_pending(spark, sf_dir):
    """Days left when those up to the middle of the range are in the ledger."""
    days = backfill.plan_of(txn(spark, sf_dir))
    middle = days.agg(F.expr("date_add(min(day), int(datediff(max(day), min(day)) / 2))")).scalar()
    return backfill.pending(days, days.filter(F.col("day") <= middle))


@query
def backfill_antijoin(spark, sf_dir):
    """Arrivals from the middle of the range on, whose ids had not arrived a day after it."""
    rows = bronze(spark, sf_dir)
    days = backfill.plan_of(txn(spark, sf_dir))
    middle = days.agg(F.expr("date_add(min(day), int(datediff(max(day), min(day)) / 2))")).scalar()
    existing = rows.filter(F.to_date("arrived_at") <= middle).select("event_id").distinct()
    incoming = rows.filter(F.to_date("arrived_at") >= middle)
    return dedupe.skip_existing(incoming, existing).select("seq", "event_id", "amount_gbp")


@query
def backfill_run(spark, sf_dir):
    """First half, then the whole range: the second run resumes after the first."""
    lake = new_lake(spark, "backfill")
    store.land_raw(payloads(spark, sf_dir), lake, DATASET, "landed")
    first, last = backfill.plan_of(txn(spark, sf_dir)).agg(F.min("day"), F.max("day")).first()
    middle = first + (last - first) / 2
    backfill.run(spark, lake, DATASET, str(first), str(middle))
    backfill.run(spark, lake, DATASET, str(first), str(last))
    return backfill.read_ledger(spark, lake, DATASET).select("dataset", "day", "records", "skipped")


# --- schema drift ---------------------------------------------------------------


def profile(spark, sf_dir) -> DataFrame:
    return drift.field_profile(wire.to_payload(txn(spark, sf_dir), by_version=True))


def stored_profile(spark, sf_dir) -> DataFrame:
    """The profile as a table (a row per version, field and type): payloads are read once."""
    path = f"{shared_folder(spark, 'profile')}/fields"
    profile(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def version_fields(observed: DataFrame, version: int) -> DataFrame:
    required = [name for name, _, needed in schemas.declared_fields(version) if needed]
    return drift.dominant_types(observed, version, required)


@query
def schema_field_profile(spark, sf_dir):
    return profile(spark, sf_dir)


@query
def schema_diff(spark, sf_dir):
    observed = stored_profile(spark, sf_dir)
    fields = {v: version_fields(observed, v) for v in (1, 2, 3)}
    steps = [
        drift.diff_fields(fields[a], fields[b]).select(
            F.lit(f"v{a}-v{b}").alias("versions"), "*"
        )
        for a, b in ((1, 2), (2, 3), (3, 1))
    ]
    return drift.union_versions(steps)


@query
def schema_compatibility(spark, sf_dir):
    observed = stored_profile(spark, sf_dir)
    fields = {v: version_fields(observed, v) for v in (1, 2, 3)}
    steps = [
        drift.classify(drift.diff_fields(fields[a], fields[b])).select(
            F.lit(f"v{a}-v{b}").alias("versions"), "*"
        )
        for a, b in ((1, 2), (2, 3), (3, 1), (2, 2))
    ]
    return drift.union_versions(steps)


@query
def schema_fields_added(spark, sf_dir):
    observed = stored_profile(spark, sf_dir)
    return drift.field_set_difference(version_fields(observed, 3), version_fields(observed, 1))


@query
def schema_union_versions(spark, sf_dir):
    events = txn(spark, sf_dir)
    common = ["seq", "event_id", "schema_version", "amount_raw"]
    v1 = events.filter("schema_version = 1").select(*common)
    v2 = events.filter("schema_version = 2").select(*common, "merchant_id", "merchant_category")
    v3 = events.filter("schema_version = 3").select(
        *common, "merchant_id", "merchant_category", "email", "risk_score"
    )
    return drift.union_versions([v1, v2, v3])


@query
def schema_merge_files(spark, sf_dir):
    """Versions stored as different Parquet schemas, read as one."""
    events = txn(spark, sf_dir)
    root = new_lake(spark, "versions").path("bronze", DATASET)
    for version, extra in ((1, []), (2, ["merchant_id"]), (3, ["merchant_id", "email"])):
        rows = events.filter(F.col("schema_version") == version).select("seq", "event_id", *extra)
        rows.write.parquet(f"{root}/version={version}")
    merged = spark.read.option("mergeSchema", "true").parquet(root)
    return merged.select("seq", "event_id", "merchant_id", "email", "version")


# --- lineage and warehouse ------------------------------------------------------


def lineage_of(spark, lake: Lake) -> DataFrame:
    stored = layer_frames(spark, lake)
    return lineage.lineage_summary(
        lineage.trace(stored["raw"], stored["bronze"], stored["silver"], stored["quarantine"])
    )


@query
def record_lineage(spark, sf_dir):
    """Of a lake that two batches stored."""
    return lineage_of(spark, loaded_lake(spark, sf_dir, "lineage"))


@query
def gold_drill_through(spark, sf_dir):
    rows = core(spark, sf_dir).withColumn("country", or_default("country", "UN"))
    cell = gold.top_by_volume(gold.country_performance(core(spark, sf_dir)), "country", 1)
    return lineage.rows_behind(rows, cell, "country").select(
        "event_id", "country", gold.gold_amount().cast("decimal(18,2)").alias("amount")
    )


@query
def gold_reconcile(spark, sf_dir):
    rows = core(spark, sf_dir)
    return lineage.reconcile(
        rows, gold.merchant_statistics(rows), or_default("merchant_category", "unknown"), "merchant_category"
    )


@query
def dim_time(spark, sf_dir):
    return warehouse.dim_time(core(spark, sf_dir))


@query
def dim_customer(spark, sf_dir):
    return warehouse.dim_customer(core(spark, sf_dir), fixtures.customer_profile(spark, sf_dir))


@query
def dim_merchant(spark, sf_dir):
    return warehouse.dim_merchant(core(spark, sf_dir))


@query
def dim_country(spark, sf_dir):
    return warehouse.dim_country(core(spark, sf_dir))


def star(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    path = f"{shared_folder(spark, 'star')}/silver"
    core(spark, sf_dir).write.parquet(path)
    rows = spark.read.parquet(path)
    dimensions = {
        "customer_key": warehouse.dim_customer(rows, fixtures.customer_profile(spark, sf_dir)),
        "merchant_key": warehouse.dim_merchant(rows),
        "time_key": warehouse.dim_time(rows),
        "country_key": warehouse.dim_country(rows),
    }
    fact = warehouse.fact_transaction(
        rows, dimensions["customer_key"], dimensions["merchant_key"], dimensions["country_key"]
    )
    return fact, dimensions


@query
def fact_transaction(spark, sf_dir):
    return star(spark, sf_dir)[0]


@query
def fact_orphans(spark, sf_dir):
    fact, dimensions = star(spark, sf_dir)
    return warehouse.fact_orphans(fact, dimensions)


@query
def warehouse_load(spark, sf_dir):
    """Star tables written once, then read back and joined for a report."""
    folder = shared_folder(spark, "warehouse")
    core(spark, sf_dir).write.parquet(f"{folder}/silver")
    silver = spark.read.parquet(f"{folder}/silver")
    warehouse.load_star(spark, silver, fixtures.customer_profile(spark, sf_dir), folder)
    fact = spark.read.parquet(f"{folder}/fact_transaction")
    customers = spark.read.parquet(f"{folder}/dim_customer")
    times = spark.read.parquet(f"{folder}/dim_time")
    return (
        fact.join(customers, "customer_key")
        .join(times, "time_key")
        .groupBy("customer_segment", "weekday")
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").cast("decimal(18,2)").alias("amount"))
    )


# --- whole jobs -----------------------------------------------------------------


@query
def medallion_job(spark, sf_dir):
    """One stored batch, repeated: the repeat must not change the lake."""
    lake = new_lake(spark, "medallion")
    rows = payloads(spark, sf_dir)
    medallion.write_batch(spark, lake, DATASET, rows, "b1")
    medallion.write_batch(spark, lake, DATASET, rows, "b1")
    return store.read_gold(spark, lake, "daily_revenue")


@query
def bronze_to_silver_job(spark, sf_dir):
    lake = new_lake(spark, "rebuild")
    store.write_batch(bronze(spark, sf_dir), lake, "bronze", DATASET, "ingested_at", "b1")
    medallion.rebuild_silver(spark, lake, DATASET)
    return store.read_layer(spark, lake, "silver", DATASET).select(
        "event_id", "seq", "email", "country_name", "amount_gbp", "is_fraud"
    )


@query
def sql_over_lake(spark, sf_dir):
    catalog.register_lake(spark, loaded_lake(spark, sf_dir, "sql"), [DATASET])
    return spark.sql("""
        SELECT 'bronze' AS layer, count(*) AS records, CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS volume FROM bronze_transactions
        UNION ALL SELECT 'silver', count(*), CAST(sum(amount_gbp) AS DECIMAL(18,2)) FROM silver_transactions
        UNION ALL SELECT 'gold', sum(transactions), CAST(sum(volume) AS DECIMAL(18,2)) FROM gold_daily_revenue""")


@query
def stream_snapshot(spark, sf_dir):
    lake = new_lake(spark, "snapshot")
    store.land_raw(payloads(spark, sf_dir), lake, DATASET, "b1")
    events = wire.parse_payloads(
        store.read_layer(spark, lake, "raw", DATASET, schemas.RAW_SCHEMA.toDDL()).withColumn("copy", F.col("payload"))
    )
    return observability.stream_snapshot(events.withColumnRenamed("copy", "payload"))


def counted(spark, lake: Lake) -> DataFrame:
    """Rows and distinct record numbers of each stored layer."""
    return drift.union_versions([
        frame.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("seq").alias("numbers")).select(
            F.lit(name).alias("layer"), "records", "numbers"
        )
        for name, frame in layer_frames(spark, lake).items()
    ])


@query
def lake_stream_then_batch(spark, sf_dir):
    """Streams store the events; then all of them come again in a batch."""
    lake = new_lake(spark, "mixed")
    for sink in (ingest.landing(wire.to_payload(txn_stream(spark, sf_dir)), lake, DATASET),
                 ingest.bronze(txn_stream(spark, sf_dir), lake, DATASET),
                 ingest.quarantine(txn_stream(spark, sf_dir), lake, DATASET),
                 ingest.silver(txn_stream(spark, sf_dir), lake, DATASET)):
        ingest.run_available(sink)
    medallion.write_batch(spark, lake, DATASET, payloads(spark, sf_dir), "again")
    return counted(spark, lake)


@query
def lake_rebuild_then_batch(spark, sf_dir):
    lake = new_lake(spark, "rebuilt")
    first, second = two_batches(spark, sf_dir)
    medallion.write_batch(spark, lake, DATASET, first, "b0")
    medallion.rebuild_silver(spark, lake, DATASET)
    medallion.write_batch(spark, lake, DATASET, second, "b1")
    return counted(spark, lake)


@query
def lake_shrunk_batch(spark, sf_dir):
    """A batch of everything, repeated with the first half only."""
    lake = new_lake(spark, "shrunk")
    medallion.write_batch(spark, lake, DATASET, payloads(spark, sf_dir), "b0")
    medallion.write_batch(spark, lake, DATASET, two_batches(spark, sf_dir)[0], "b0")
    return counted(spark, lake)


@query
def backfill_after_batch(spark, sf_dir):
    """Half is written by a batch, all is landed, the whole range is backfilled: nothing doubles."""
    lake = new_lake(spark, "backfill-after")
    first, second = two_batches(spark, sf_dir)
    medallion.write_batch(spark, lake, DATASET, first, "b0")
    store.land_raw(second, lake, DATASET, "b1")
    start, end = backfill.plan_of(txn(spark, sf_dir)).agg(F.min("day"), F.max("day")).first()
    backfill.run(spark, lake, DATASET, str(start), str(end))
    return counted(spark, lake)


@query
def failing_batch_stays_out(spark, sf_dir):
    """The first half fails the gate. A later batch, a backfill and a stream over everything after it don't let it into gold."""
    lake = new_lake(spark, "failing")
    first, second = two_batches(spark, sf_dir)
    medallion.write_batch(spark, lake, DATASET, first, "b0", gate=101)
    medallion.write_batch(spark, lake, DATASET, second, "b1")
    start, end = backfill.plan_of(txn(spark, sf_dir)).agg(F.min("day"), F.max("day")).first()
    backfill.run(spark, lake, DATASET, str(start), str(end))
    events = txn_stream(spark, sf_dir)
    middle = store.read_raw(spark, lake, DATASET, F.col("batch") == "b1").agg(F.min("arrived_at")).scalar()
    ingest.run_available(ingest.daily_gold(events.filter(F.col("arrived_at") >= F.lit(middle)), lake, DATASET))
    return store.read_gold(spark, lake, "daily_revenue")


@query
def batch_ledger(spark, sf_dir):
    """State and rows of a failing batch, a passing one, and one that failed and was repeated with a lower gate."""
    lake = new_lake(spark, "ledger")
    first, second = two_batches(spark, sf_dir)
    for name, rows, gate_score in (("b0", first, 101), ("b1", second, 95), ("b2", first, 101), ("b2", first, 95)):
        medallion.write_batch(spark, lake, DATASET, rows, name, gate=gate_score)
    return medallion.batch_states(spark, lake, DATASET).select("batch", "state", "rows")


@query
def two_streams_one_lake(spark, sf_dir):
    """Two streams of their own write silver, and two land the same records: no batch takes another's place."""
    lake = new_lake(spark, "two-streams")
    half = txn_stream(spark, sf_dir)
    ingest.run_available(ingest.silver(half.filter("seq % 2 = 0"), lake, DATASET))
    ingest.run_available(ingest.daily_gold(half, lake, DATASET))
    other = Lake(lake.root, lake.grain)
    for run in ("a", "b"):
        writer = ingest.landing(wire.to_payload(txn_stream(spark, sf_dir)), other, DATASET)
        ingest.run_available(writer.option("checkpointLocation", lake.checkpoint_path(f"landing-{run}")))
    layers = {"raw": store.read_raw(spark, lake, DATASET), "silver": store.read_layer(spark, lake, "silver", DATASET)}
    return drift.union_versions([
        frame.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("event_id").alias("ids")).select(F.lit(name).alias("layer"), "records", "ids")
        for name, frame in layers.items()
    ])


@query
def killed_write_resumes(spark, sf_dir):
    """A batch is stored; its repeat is lost after each step that it takes, then runs through. Readers look in between."""
    lake = new_lake(spark, "killed")
    first, _ = two_batches(spark, sf_dir)
    medallion.write_batch(spark, lake, DATASET, first, "b0")
    rows = payloads(spark, sf_dir)
    # lost before anything is published, then with raw published, then with bronze published as well
    store.store_rows(rows.withColumn("batch", F.lit("b0")), lake, "raw", DATASET, "arrived_at")
    before = counted(spark, lake)
    store.land_raw(rows, lake, DATASET, "b0")
    accepted, _, _ = medallion.stage(store.read_raw(spark, lake, DATASET), lake, DATASET, "b0")
    lake.log(spark, "bronze", DATASET).commit([accepted])
    between = counted(spark, lake)
    medallion.write_batch(spark, lake, DATASET, rows, "b0")
    steps = {"before": before, "between": between, "after": counted(spark, lake)}
    return drift.union_versions([frame.select(F.lit(step).alias("step"), "*") for step, frame in steps.items()])


@query
def id_index_skip_existing(spark, sf_dir):
    """Batches that each bring the days before again: ids stored already are found through the index."""
    lake = new_lake(spark, "id-index")
    path = f"{shared_folder(spark, 'id-index-rows')}/rows"
    medallion.bronze(txn(spark, sf_dir), DATASET, F.col("arrived_at")).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.floor(F.dayofmonth("arrived_at") / 8)
    for number in range(4):
        again = dedupe.keep_first(rows.filter(part.between(number - 1, number)))
        medallion.add_new_ids(spark, lake, "silver", DATASET, again, "ingested_at", f"b{number}")
    return store.read_layer(spark, lake, "silver", DATASET).select("event_id", "seq", "batch")


def repeated_and_shrunk(name: str) -> Query:
    def run(spark, sf_dir):
        """Two batches; the second is repeated, then shrunk to every other record. Gold follows by sums alone."""
        lake = new_lake(spark, "increments")
        first, second = two_batches(spark, sf_dir)
        for batch, rows in (("b0", first), ("b1", second), ("b0", first), ("b1", second.filter("seq % 2 = 0"))):
            medallion.write_batch(spark, lake, DATASET, rows, batch)
        return store.read_gold(spark, lake, name)

    run.__name__ = f"incremental_{name}"
    return run


for _name in ("customer_activity", "country_performance", "merchant_statistics", "fraud_summary"):
    query(repeated_and_shrunk(_name))


@query
def warehouse_keys_stable(spark, sf_dir):
    """Two loads with new customers between them: keys given by the first stay, none is given twice, and the fact finds all."""
    folder = shared_folder(spark, "stable-keys")
    core(spark, sf_dir).write.parquet(f"{folder}/silver")
    silver = spark.read.parquet(f"{folder}/silver")
    profile = fixtures.customer_profile(spark, sf_dir)
    early = silver.filter("seq % 7 < 3 AND customer_id > 'CUS-2'")
    warehouse.load_star(spark, early, profile, folder)
    dimensions = {"customer": ("customer_id",), "merchant": ("merchant_id", "merchant_category"), "country": ("country",)}
    for name in dimensions:
        spark.read.parquet(f"{folder}/dim_{name}").write.parquet(f"{folder}/first/{name}")
    for _ in range(2):  # the repeat gives no keys
        warehouse.load_star(spark, silver, profile, folder)
    fact = spark.read.parquet(f"{folder}/fact_transaction")
    parts = []
    for name, natural in dimensions.items():
        key = f"{name}_key"
        now = spark.read.parquet(f"{folder}/dim_{name}").select(key, *natural)
        first = spark.read.parquet(f"{folder}/first/{name}").select(F.col(key).alias("old_key"), *natural)
        found = now.join(first, list(natural), "left").agg(
            F.count(F.lit(1)).alias("keys"), F.count_distinct(key).alias("distinct_keys"), F.max(key).alias("largest"),
            F.count("old_key").alias("old_keys"), F.count_if(F.col("old_key") != F.col(key)).alias("moved"),
        )
        used = fact.select(F.count(key).alias("facts"))
        parts.append(found.select(F.lit(name).alias("dimension"), "*").join(used))
    return drift.union_versions(parts)


@query
def active_customers_sketch(spark, sf_dir):
    """Sketches of two batches, one of them repeated, merged and held against exact counts of silver."""
    lake = loaded_lake(spark, sf_dir, "sketches")
    increments.active_customers(spark, lake, DATASET)
    medallion.write_batch(spark, lake, DATASET, two_batches(spark, sf_dir)[1], "b1")
    estimated = increments.active_customers(spark, lake, DATASET).withColumnRenamed("active_customers", "estimate")
    exact = gold.active_customers(store.read_layer(spark, lake, "silver", DATASET))
    close = F.abs(F.col("estimate") - F.col("active_customers")) <= F.lit(0.08) * F.col("active_customers") + 1
    return exact.join(estimated, "metric_date", "full").select("metric_date", "active_customers", close.alias("within_bound"))


@query
def key_distribution_adaptive(spark, sf_dir):
    """Log records, nine tenths of which share one key, over 16 partitions: salts set by a sketch even them out."""
    spread = layout.distribute_adaptively(txn(spark, sf_dir), "logs", 16)
    loads = spread.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("records"))
    return loads.agg(
        F.sum("records").alias("records"), F.count(F.lit(1)).alias("partitions"),
        (F.max("records") < 2 * F.sum("records") / 16).alias("below_twice_the_mean"),
    )


def expired_lake(spark, sf_dir) -> tuple[Lake, str]:
    """A lake of two batches whose raw layer has just lost the days past retention, ten days kept."""
    lake = loaded_lake(spark, sf_dir, "expiry")
    last = backfill.plan_of(txn(spark, sf_dir)).agg(F.max("day")).scalar()
    limit = spark.range(1).select(F.date_sub(last, 10).cast("string")).first()[0]
    store.expire(spark, lake, "raw", DATASET, limit)
    return lake, limit


@query
def expired_partitions(spark, sf_dir):
    """Days dropped from raw, and how many of them later reads still see."""
    lake, _ = expired_lake(spark, sf_dir)
    left = store.read_raw(spark, lake, DATASET).select(F.to_date("arrived_at").cast("string").alias("day")).distinct().withColumn("seen", F.lit(1))
    days = store.expired_partitions(spark, lake, "raw", DATASET).select("day").distinct()
    return days.join(left, "day", "left").select("day", F.coalesce("seen", F.lit(0)).alias("seen"))


@query
def live_after_expiry(spark, sf_dir):
    """What an expiry leaves in raw and, untouched, in silver."""
    lake, _ = expired_lake(spark, sf_dir)
    layers = {"raw": store.read_raw(spark, lake, DATASET), "silver": store.read_layer(spark, lake, "silver", DATASET)}
    return drift.union_versions([
        frame.agg(F.count(F.lit(1)).alias("records"), F.min("arrived_at").alias("first")).select(F.lit(name).alias("layer"), "records", "first")
        for name, frame in layers.items()
    ])


# --- streams --------------------------------------------------------------------


@query
def stream_progress(spark, sf_dir):
    """Progress rows that a listener stored of a stream over three files, one a batch."""
    lake = new_lake(spark, "progress")
    folder = f"{shared_folder(spark, 'progress-in')}/files"
    rows = payloads(spark, sf_dir)
    for part in range(3):
        rows.filter(F.col("seq") % 3 == part).coalesce(1).write.mode("append").options(**store.JSON_OPTIONS).json(folder)
    listener = progress.ProgressLog(spark, lake)
    spark.streams.addListener(listener)
    try:
        source = streams.payload_files(spark, folder, max_files=1)
        ingest.run_available(ingest.landing(source, lake, DATASET).queryName(f"landing-{lake.root.rsplit('-', 1)[-1]}"))
        progress.wait_for(spark, lake, 3)
    finally:
        spark.streams.removeListener(listener)
    found = progress.read_progress(spark, lake).filter("input_rows > 0")
    return found.select("input_rows", "dropped_by_watermark", (F.coalesce("offsets_behind", F.lit(0)) >= 0).alias("in_order"))



def txn_stream(spark, sf_dir) -> DataFrame:
    events = streams.table_stream(spark, sf_dir, "events")
    return fixtures.shape_transactions(events, fixtures.table(spark, sf_dir, "customer"))


@query
def stream_landing(spark, sf_dir):
    lake = new_lake(spark, "stream-landing")
    ingest.run_available(ingest.landing(wire.to_payload(txn_stream(spark, sf_dir)), lake, DATASET))
    rows = store.read_layer(spark, lake, "raw", DATASET, schemas.RAW_SCHEMA.toDDL())
    return wire.parse_payloads(rows).select("seq", "arrived_at", "event_id", "amount", "event_ts")


@query
def stream_bronze(spark, sf_dir):
    lake = new_lake(spark, "stream-bronze")
    ingest.run_available(ingest.bronze(txn_stream(spark, sf_dir), lake, DATASET))
    return store.read_layer(spark, lake, "bronze", DATASET).select(
        "seq", "event_id", "amount_gbp", "country_name", "event_ts", "is_fraud",
        "year", "month", "day",
    )


@query
def stream_quarantine(spark, sf_dir):
    lake = new_lake(spark, "stream-quarantine")
    ingest.run_available(ingest.quarantine(txn_stream(spark, sf_dir), lake, DATASET))
    stored = store.read_layer(spark, lake, "quarantine", DATASET, "seq BIGINT, event_id STRING, reasons ARRAY<STRING>, quarantine_reason STRING")
    return stored.select(
        "seq", "event_id", joined_reasons(), "quarantine_reason"
    )


@query
def stream_dedup(spark, sf_dir):
    lake = new_lake(spark, "stream-dedup")
    ingest.run_available(ingest.deduplicated(txn_stream(spark, sf_dir), lake, DATASET))
    return store.read_layer(spark, lake, "bronze", f"{DATASET}_distinct").select("event_id")


@query
def stream_silver(spark, sf_dir):
    lake = new_lake(spark, "stream-silver")
    ingest.run_available(ingest.silver(txn_stream(spark, sf_dir), lake, DATASET))
    return store.read_layer(spark, lake, "silver", DATASET).select(
        "event_id", "seq", "amount_gbp", "email", "year", "month", "day"
    )


@query
def stream_window_metrics(spark, sf_dir):
    lake = new_lake(spark, "stream-windows")
    ingest.run_available(metrics.window_totals(txn_stream(spark, sf_dir), lake, DATASET))
    return metrics.read_table(spark, lake, f"{DATASET}_windows")


@query
def stream_alerts(spark, sf_dir):
    lake = new_lake(spark, "stream-alerts")
    ingest.run_available(metrics.alerts(txn_stream(spark, sf_dir), lake, DATASET))
    return metrics.read_table(spark, lake, f"{DATASET}_alerts")


def streamed_gold(name: str) -> Query:
    def run(spark, sf_dir):
        lake = new_lake(spark, "stream-gold")
        ingest.run_available(ingest.daily_gold(txn_stream(spark, sf_dir), lake, DATASET))
        return store.read_gold(spark, lake, name)

    run.__name__ = "stream_gold" if name == "daily_revenue" else f"stream_gold_{name}"
    return run


for _name in gold.GOLD:
    query(streamed_gold(_name))


@query
def stream_quality(spark, sf_dir):
    lake = new_lake(spark, "stream-quality")
    ingest.run_available(metrics.batch_quality(txn_stream(spark, sf_dir), lake, DATASET))
    return spark.read.parquet(lake.report_path(f"{DATASET}_stream"))
