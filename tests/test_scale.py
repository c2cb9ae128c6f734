"""One id, customer or day may hold a third of all rows: results and plans."""

from pyspark.sql import functions as F

from tidewrack.operators import anomaly, dedupe, enrich, gold, quality
from tidewrack.plans import medallion
from tidewrack.registry.queries import txn

DATASET = "transactions"
N = 60_000


def skewed(spark):
    """A third of the rows share one event id and one customer."""
    hot = F.col("id") % 3 == 0
    return spark.range(N).select(
        F.col("id").alias("seq"),
        F.when(hot, F.lit("evt-hot")).otherwise(F.concat(F.lit("evt-"), "id")).alias("event_id"),
        F.when(hot, F.lit("CUS-hot")).otherwise(F.concat(F.lit("CUS-"), F.col("id") % 50)).alias("customer_id"),
        F.lit("payment").alias("event_type"),
        F.lit("1.00").alias("amount_raw"),
        F.lit("1.00").cast("decimal(18,2)").alias("amount"),
        F.lit("GBP").alias("currency"),
        F.lit("GB").alias("country"),
        F.lit("fuel").alias("merchant_category"),
        F.lit("INFO").alias("level"),
        F.lit("0.01").cast("decimal(5,3)").alias("risk_score"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id")).alias("arrived_at"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id")).alias("event_ts"),
        F.lit("2026-01-01T00:00:00Z").alias("timestamp"),
    )


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_id(spark):
    events = skewed(spark)
    unique = N - N // 3 + 1
    kept = medallion.silver_core(events, DATASET, F.col("arrived_at"))
    assert kept.count() == unique
    assert kept.filter("event_id = 'evt-hot'").first()["seq"] == 0
    report = quality.quality_report(events, DATASET).first()
    assert (report["records"], report["duplicates"], report["quarantined"]) == (N, N - unique, N - unique)
    assert quality.with_flags(events, DATASET).filter("is_duplicate").count() == N - unique
    rates = anomaly.anomaly_metrics(events, DATASET).filter("metric = 'duplicate_rate'")
    assert rates.count() == N / 300
    assert gold.customer_activity(kept).filter("customer_id = 'CUS-hot'").first()["transactions"] == 1


def test_keep_first_limits_before_the_shuffle(spark, sf):
    plan = plan_of(dedupe.keep_first(txn(spark, sf)))
    assert "row_number(), 1, Partial" in plan
    assert plan.index("row_number(), 1, Final") < plan.index("row_number(), 1, Partial")


def test_reports_use_no_window(spark, sf):
    events = txn(spark, sf)
    for frame in (
        quality.quality_report(events, DATASET),
        quality.quality_issues(events, DATASET),
        quality.quality_scan(events),
        quality.with_flags(events, DATASET),
        anomaly.anomaly_metrics(events, DATASET),
        anomaly.alarm_m_of_n(anomaly.lag_per_minute(events)),
    ):
        assert "Window [" not in plan_of(frame)


def test_gold_combines_before_the_shuffle(spark, sf):
    silver = medallion.silver_core(txn(spark, sf), DATASET, F.col("arrived_at"))
    for build in gold.GOLD.values():
        assert "partial_" in plan_of(build(silver))


def test_no_python_and_no_cartesian_product(spark, sf):
    import __spark_entry__ as entry

    for name in ("gold_daily_revenue", "silver_pii_masked", "anomaly_alerts", "fact_transaction",
                 "record_lineage", "observability_snapshot", "schema_field_profile"):
        plan = plan_of(entry.queries()[name](spark, sf))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_columns_and_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    skewed(spark).limit(1000).write.parquet(path)
    stored = spark.read.parquet(path)
    frame = gold.daily_revenue(enrich.derive(quality.accepted_rows(stored, DATASET), F.col("arrived_at")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(frame)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "In(currency, [EUR,GBP,JPY,USD])" in plan and "GreaterThanOrEqual(amount,0" in plan
    assert "GreaterThan(event_id,)" in plan
    read_schema = plan[plan.index("ReadSchema"):]
    assert "merchant_category" not in read_schema and "level" not in read_schema


def test_payloads_are_parsed_once(spark, sf):
    from tidewrack.sources import wire

    rows = wire.to_payload(txn(spark, sf))
    plan = plan_of(medallion.bronze(wire.parse_payloads(rows), DATASET, F.col("arrived_at")))
    generates = [line for line in plan.splitlines() if "Generate" in line and "inline" in line]
    assert len(generates) == 1
    assert plan.count("JsonToStructs") + plan.count("from_json") <= 1


def test_ids_of_other_batches_are_skipped(spark, sf):
    from tidewrack.session import shared_folder
    from tidewrack.sources import lake as store
    from tidewrack.sources.lake import Lake

    core = medallion.silver_core(txn(spark, sf), DATASET, F.col("arrived_at"))
    lake = Lake(shared_folder(spark, "test-silver-ids"), "day")
    for name, rows in (("a", core.filter("seq < 600")), ("b", core)):
        medallion.add_to_silver(spark, lake, DATASET, rows, "arrived_at", name)
    silver = store.read_layer(spark, lake, "silver", DATASET)
    assert silver.count() == 960
    assert silver.filter("batch = 'b'").agg(F.min("seq")).first()[0] >= 600


def test_stored_copies_are_dropped_in_place(spark, tmp_path):
    """Hot, tied and null ids: as ``keep_first``, but whole rows are neither sorted nor shuffled."""
    rows = skewed(spark).filter("seq < 3000").select("event_id", "arrived_at", "seq", F.lit("wide").alias("payload"))
    odd = rows.limit(5).withColumn("event_id", F.lit(None).cast("string"))
    rows.unionByName(rows.filter("seq < 50")).unionByName(odd).repartition(7).write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    kept, in_place = dedupe.keep_first_stored(stored)
    assert in_place and kept.columns == stored.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, dedupe.keep_first(stored).collect()))
    plan = plan_of(kept)
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_many_dropped_rows_are_joined_by_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dedupe, "FEW", 10)
    skewed(spark).filter("seq < 3000").select("event_id", "arrived_at", "seq").write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    kept, in_place = dedupe.keep_first_stored(stored)
    assert not in_place
    assert sorted(map(str, kept.collect())) == sorted(map(str, dedupe.keep_first(stored).collect()))
