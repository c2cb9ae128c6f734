"""Literal cases for rules, masks, alerts, schema classes, keys."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewrack import schemas
from tidewrack.functions.masking import mask_email
from tidewrack.functions.values import ratio
from tidewrack.operators import (
    anomaly,
    dedupe,
    drift,
    enrich,
    gold,
    layout,
    personas,
    pii,
    quality,
    warehouse,
)
from tidewrack.plans import medallion
from tidewrack.sources import wire

GOOD = {
    "event_id": "evt-1", "customer_id": "CUS-1", "event_type": "payment", "amount": 10,
    "currency": "GBP", "timestamp": "2026-09-12T10:00:00Z", "schema_version": 1,
}


def events_of(spark, *overrides):
    """Typed events from dicts, through the payload parser."""
    import json

    rows = []
    for number, change in enumerate(overrides):
        event = {k: v for k, v in {**GOOD, **change}.items() if v is not None}
        rows.append((json.dumps(event), f"2026-09-12 10:00:{number:02d}", number))
    raw = spark.createDataFrame(rows, "payload string, arrived_at string, seq long")
    return wire.parse_payloads(raw.withColumn("arrived_at", F.col("arrived_at").cast("timestamp")))


def test_clean_batch(spark):
    report = quality.quality_report(events_of(spark, {}, {"event_id": "evt-2"}), "transactions").first()
    assert report["score"] == 100 and report["quarantined"] == 0


def test_bad_batch_codes(spark):
    batch = events_of(
        spark, {}, {}, {"event_id": "evt-3", "customer_id": None},
        {"event_id": "evt-4", "currency": "XXX"}, {"event_id": "evt-5", "amount": -4},
        {"event_id": "evt-6", "amount": "not-a-number"}, {"event_id": "evt-7", "event_type": ""},
        {"event_id": "evt-8", "timestamp": "2026-09-12T16:00:00Z"}, {"event_id": ""},
    )
    codes = {r["code"]: r["count"] for r in quality.quality_issues(batch, "transactions").collect()}
    assert codes == {
        "DUPLICATE event_id": 1, "MISSING customer_id": 1, "INVALID currency": 1, "NEGATIVE amount": 1,
        "INVALID amount": 1, "MISSING event_type": 1, "INVALID schema": 1, "FUTURE timestamps": 1,
        "MISSING event_id": 1,
    }
    assert quality.accepted_rows(batch, "transactions").count() == 2
    assert quality.rejected_rows(batch, "transactions").count() == 7


def test_presence_edges(spark):
    batch = events_of(spark, {"amount": 0}, {"event_id": "e2", "timestamp": "soon"}, {"event_id": "e3", "amount": None})
    flags = {r["event_id"]: r for r in quality.with_flags(batch, "transactions").collect()}
    assert flags["evt-1"]["is_complete"] and flags["evt-1"]["is_valid"]
    assert flags["e2"]["is_valid"]  # an unparseable time is not a future time
    assert flags["e3"]["reasons"] == ["MISSING amount"]


def test_payload_that_is_not_json_is_quarantined(spark):
    raw = spark.sql("SELECT 'garbage' AS payload, TIMESTAMP '2026-09-12 10:00:00' AS arrived_at, 1L AS seq")
    events = wire.parse_payloads(raw)
    assert quality.accepted_rows(events, "transactions").count() == 0
    assert quality.rejected_rows(events, "transactions").count() == 1


def test_amount_keeps_every_digit(spark):
    event = events_of(spark, {"amount": 1234567890123456.78, "event_id": "a"}, {"amount": 1, "event_id": "b"})
    raw = spark.sql(
        """SELECT '{"event_id":"x","amount":1234567890123456.78}' AS payload,
           TIMESTAMP '2026-09-12 10:00:00' AS arrived_at, 1L AS seq"""
    )
    assert wire.parse_payloads(raw).first()["amount"] == Decimal("1234567890123456.78")
    assert event.count() == 2


def test_logs_need_no_amount(spark):
    log = events_of(spark, {"amount": None, "currency": None, "customer_id": None, "event_type": "log"})
    assert quality.accepted_rows(log, "logs").count() == 1
    assert quality.accepted_rows(log, "transactions").count() == 0


def test_empty_report(spark):
    empty = events_of(spark, {}).filter("false")
    report = quality.quality_report(empty, "transactions").first()
    assert (report["records"], report["completeness"], report["uniqueness"], report["score"]) == (0, 0, 100, 20)
    assert quality.quality_scan(empty).first()["quality_score"] == 100
    assert gold.kpi_summary(medallion.silver_core(empty, "transactions")).first()["transactions"] == 0


def test_valid_copy_after_invalid_copy_is_kept(spark):
    batch = events_of(spark, {"amount": -1}, {})
    kept = medallion.silver_core(batch, "transactions").collect()
    assert [r["seq"] for r in kept] == [1]
    report = quality.quality_report(batch, "transactions").first()
    assert (report["duplicates"], report["quarantined"]) == (1, 2)


def test_report_matches_row_flags(spark, sf):
    from tidewrack.registry.queries import txn

    flags = quality.with_flags(txn(spark, sf), "transactions")
    report = quality.quality_report(txn(spark, sf), "transactions").first()
    assert report["quarantined"] == flags.filter("NOT (is_complete AND is_valid) OR is_duplicate").count() == 41
    assert report["duplicates"] == flags.filter("is_duplicate").count() == 8
    assert str(report["score"]) == "98.3"


@pytest.mark.parametrize(
    "given, masked",
    [("helena@example.com", "h******@example.com"), ("nodomain", "***"), ("@x", "*******@x"),
     ("a@b@c", "a******@b"), ("a@", "***")],
)
def test_mask_email(spark, given, masked):
    assert spark.range(1).select(mask_email(F.lit(given))).first()[0] == masked


def test_policies(spark):
    frame = spark.sql("SELECT 'e' AS event_id, 'helena@example.com' AS email, '' AS phone, 'Helena Moss' AS customer_name")
    assert pii.apply_policy(frame, "administrator").first()["email"] == "helena@example.com"
    masked = pii.apply_policy(frame, "analyst").first()
    assert masked["email"] == "h******@example.com" and masked["phone"] == ""
    assert masked["customer_name"].startswith("tok_") and len(masked["customer_name"]) == 16
    assert pii.apply_policy(frame, "restricted").columns == ["event_id"]
    with pytest.raises(ValueError):
        pii.apply_policy(frame, "guest")


def test_personas(spark):
    frame = spark.sql("SELECT 'GB' AS country, 1L AS transactions, 2 AS volume, 'x' AS email")
    seen = personas.view_for("finance_analyst", "gold", frame, "country_performance")
    assert seen.columns == ["country", "transactions", "volume"]
    for persona, layer, dataset in (
        ("finance_analyst", "silver", None), ("finance_analyst", "gold", "fraud_summary"),
        ("auditor", "silver", None), ("security_analyst", "gold", "daily_revenue"), ("data_analyst", "raw", None),
    ):
        with pytest.raises(personas.AccessDenied):
            personas.view_for(persona, layer, frame, dataset)


def test_alert_rules(spark):
    found = anomaly.detect(
        spark.sql(
            """SELECT 'payments' AS dataset, TIMESTAMP '2026-09-12 22:10:00' AS window_start,
                 TIMESTAMP '2026-09-12 22:15:00' AS window_end, metric,
                 CAST(c AS DECIMAL(18,4)) AS current, CAST(b AS DECIMAL(18,4)) AS baseline
               FROM VALUES ('failure_rate', 0.174, 0.03), ('revenue', 200, 2000), ('pipeline_latency_sec', 72, 2),
                 ('transaction_count', 499, 100), ('duplicate_rate', 0.05, 0.01), ('unusual_country', 0, 0),
                 ('revenue', 0, 0) AS t(metric, c, b)"""
        )
    )
    alerts = {r["metric"]: r for r in anomaly.alert_text(found).collect()}
    assert set(alerts) == {"failure_rate", "revenue", "pipeline_latency_sec"}
    assert alerts["failure_rate"]["severity"] == "HIGH" and alerts["failure_rate"]["current"] == "17.4%"
    assert alerts["revenue"]["severity"] == "CRITICAL" and alerts["revenue"]["normal"] == "£2,000"
    assert alerts["pipeline_latency_sec"]["current"] == "72.0s"
    assert alerts["revenue"]["window"] == "22:10–22:15"


def test_baseline_honours_gaps(spark):
    metrics = spark.sql(
        """SELECT 'd' AS dataset, 'revenue' AS metric, CAST(t AS TIMESTAMP) AS window_start,
             CAST(v AS DECIMAL(18,4)) AS current
           FROM VALUES ('2026-01-01 00:00', 1), ('2026-01-01 00:05', 2), ('2026-01-01 00:30', 3) AS x(t, v)"""
    )
    values = {str(r["current"]): str(r["baseline"]) for r in anomaly.with_baseline(metrics).collect()}
    assert values == {"1.0000": "1.0000", "2.0000": "1.0000", "3.0000": "3.0000"}


def test_alarm_two_of_three_with_missing_minute(spark):
    points = spark.sql(
        """SELECT CAST(t AS TIMESTAMP) AS minute, v AS max_lag_ms FROM VALUES
             ('2026-01-01 00:00', 70000L), ('2026-01-01 00:01', 70000L), ('2026-01-01 00:05', 1L) AS x(t, v)"""
    )
    states = {r["minute"].minute: r["in_alarm"] for r in anomaly.alarm_m_of_n(points).collect()}
    assert states == {0: False, 1: True, 2: True, 3: False}


def test_schema_classes(spark):
    def compare(a, b, strict=True):
        diff = drift.diff_fields(drift.declared_profile(spark, a), drift.declared_profile(spark, b))
        return drift.classify(diff, strict).first()

    step = compare(1, 2)
    assert (step["added"], step["removed"], step["changed"]) == (2, 0, 0)
    assert step["compatibility"] == "BACKWARD COMPATIBLE"
    assert compare(1, 1)["compatibility"] == "FULLY COMPATIBLE"
    assert compare(2, 1)["compatibility"] == "FORWARD COMPATIBLE"


@pytest.mark.parametrize(
    "change, strict, expected",
    [("right_type_change", True, "BREAKING"), ("required_added", True, "BREAKING"),
     ("required_added", False, "BACKWARD COMPATIBLE"), ("required_removed", False, "FORWARD COMPATIBLE"),
     ("required_removed", True, "BREAKING")],
)
def test_breaking_changes(spark, change, strict, expected):
    one = "('a', 'string', true)"
    two = {"right_type_change": "('a', 'number', true)"}.get(change, one + ", ('b', 'string', true)")
    left = spark.sql(f"SELECT * FROM VALUES {one} AS t(field, type, required)")
    right = spark.sql(f"SELECT * FROM VALUES {two} AS t(field, type, required)")
    if change == "required_removed":
        left, right = right, left
    assert drift.classify(drift.diff_fields(left, right), strict).first()["compatibility"] == expected


def test_schema_metadata():
    assert schemas.pii_fields(schemas.event_schema(3)) == ["email", "phone", "ip_address", "customer_name", "address"]
    assert len(schemas.event_schema(1)) == 8 and len(schemas.event_schema(2)) == 10
    with pytest.raises(ValueError):
        schemas.event_schema(4)


def test_dense_keys_have_no_gaps(spark):
    frame = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    keyed = warehouse.dense_key(frame, F.col("k"), "key")
    row = keyed.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first()
    assert tuple(row) == (1, 5000, 5000)


def test_enrichment_edges(spark):
    batch = events_of(
        spark, {"country": "XX", "currency": "EUR", "amount": 1.01}, {"event_id": "b"},
        {"event_id": "c", "risk_score": 0.8, "country": "GB", "timestamp": "never"},
    )
    rows = {r["event_id"]: r for r in enrich.enrich(batch, F.col("arrived_at")).collect()}
    assert rows["evt-1"]["country_name"] == "Unknown" and rows["evt-1"]["is_fraud"]
    assert str(rows["evt-1"]["amount_gbp"]) == "0.86"
    assert rows["b"]["country_name"] is None and not rows["b"]["is_fraud"] and str(rows["b"]["risk_score"]) == "0.050"
    assert rows["c"]["is_fraud"] and rows["c"]["country_name"] == "United Kingdom"
    assert str(rows["c"]["event_date"]) == "2026-09-12"


def test_ratio_is_exact(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(3), 4), ratio(F.lit(5), F.lit(0), 4), ratio(F.lit(1), F.lit(32), 4)
    ).first()
    assert [str(v) for v in row] == ["0.3333", "0.0000", "0.0313"]


def test_salted_distribution_splits_a_hot_key(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("seq"), F.lit("CUS-1").alias("customer_id"), F.lit("e").alias("event_id")
    )
    spread = layout.distribute(rows, "transactions", 8, salts=8)
    assert spread.select(F.spark_partition_id().alias("p")).distinct().count() > 3


def test_skip_existing(spark):
    a = spark.sql("SELECT * FROM VALUES ('x'), ('y') AS t(event_id)")
    assert [r[0] for r in dedupe.skip_existing(a, a.filter("event_id = 'x'")).collect()] == ["y"]


@pytest.mark.parametrize("dataset", ["transactions", "logs"])
def test_accepted_is_complete_and_valid(spark, dataset):
    """Every combination of present, empty, missing and wrong values."""
    frame = spark.sql(
        """SELECT * FROM VALUES ('e'), (''), (NULL) AS a(event_id),
             VALUES ('p'), ('') AS b(event_type), VALUES ('c'), (''), (NULL) AS c(customer_id),
             VALUES ('1.50'), ('-2'), ('0'), ('x'), (''), (NULL) AS d(amount_raw),
             VALUES ('GBP'), ('XXX'), (''), (NULL) AS e(currency),
             VALUES ('2026-01-01T00:00:00Z'), ('2026-01-01T00:02:00Z'), ('soon'), (NULL) AS f(timestamp)"""
    ).withColumns(
        {
            "amount": F.col("amount_raw").try_cast("decimal(18,2)"),
            "event_ts": F.try_to_timestamp("timestamp"),
            "arrived_at": F.lit("2026-01-01 00:00:30").cast("timestamp"),
        }
    )
    long_form = quality.is_complete(dataset) & quality.is_valid()
    short_form = F.coalesce(quality.is_accepted(dataset), F.lit(False))
    assert frame.filter(long_form != short_form).count() == 0
    assert frame.filter(long_form).count() > 0
    flagged = frame.withColumn("reasons", quality.reasons(dataset))
    assert flagged.filter((F.size("reasons") == 0) != long_form).count() == 0
