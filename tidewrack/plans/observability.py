"""Snapshot of stream rate, latency and quality, and health per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.calendar import lag_micros
from tidewrack.functions.values import ratio
from tidewrack.operators import quality


def snapshot(events: DataFrame, dataset: str) -> DataFrame:
    """One row as of the newest arrival: events today, rate, latency, quality."""
    now = events.agg(F.max("arrived_at")).scalar()
    recent = F.col("arrived_at") > now - F.expr("INTERVAL 60 SECONDS")
    last_five = F.col("arrived_at") > now - F.expr("INTERVAL 5 MINUTES")
    stream = events.filter(F.to_date("arrived_at") >= F.date_sub(F.to_date(now), 1)).agg(
        F.count_if(F.to_date("arrived_at") == F.to_date(now)).alias("events_today"),
        ratio(F.count_if(recent), F.lit(60), 4).alias("current_rate"),
        F.floor(
            F.coalesce(F.max(F.when(last_five, lag_micros("event_ts", "arrived_at"))), F.lit(0))
            / 1_000_000
        )
        .cast("bigint")
        .alias("pipeline_latency_sec"),
    )
    report = quality.quality_report(events, dataset).select(
        F.col("score").alias("data_quality"), "quarantined"
    )
    # each side is one row with its own columns: stack and merge instead of joining
    both = stream.unionByName(report, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


def _grade(value, healthy, degraded):
    return (
        F.when(healthy(value), F.lit("HEALTHY"))
        .when(degraded(value), F.lit("DEGRADED"))
        .otherwise(F.lit("FAILED"))
    )


def health(events: DataFrame, dataset: str) -> DataFrame:
    """Status of quality, failures and freshness by the alert thresholds."""
    score = quality.quality_report(events, dataset).select(
        F.lit("quality").alias("name"),
        F.col("score").cast("decimal(18,4)").alias("value"),
        _grade(
            F.col("score"),
            lambda c: c >= domain.WARN_SCORE,
            lambda c: c >= domain.PUBLISH_GATE_SCORE,
        ).alias("status"),
    )
    rates = events.agg(
        ratio(F.count_if(F.col("level") == "ERROR"), F.count(F.lit(1)), 4).alias("failure"),
        F.max(lag_micros("event_ts", "arrived_at")).alias("lag"),
    )
    failure = rates.select(
        F.lit("failures").alias("name"),
        F.col("failure").cast("decimal(18,4)").alias("value"),
        _grade(F.col("failure"), lambda c: c <= 0.05, lambda c: c <= 0.10).alias("status"),
    )
    lag = rates.select(
        F.lit("lag").alias("name"),
        F.floor(F.col("lag") / 1_000_000).cast("decimal(18,4)").alias("value"),
        _grade(F.col("lag"), lambda c: c < 5_000_000, lambda c: c <= 60_000_000).alias("status"),
    )
    return score.unionByName(failure).unionByName(lag)


def stream_snapshot(raw: DataFrame) -> DataFrame:
    """One row over ``payload, arrived_at, event_ts`` rows: newest arrival, the records and bytes of
    the minute up to it, and the largest lag of any record in milliseconds."""
    now = raw.agg(F.max("arrived_at")).scalar()
    recent = F.col("arrived_at") > now - F.expr("INTERVAL 60 SECONDS")
    return raw.agg(
        F.max("arrived_at").alias("newest_arrival"),
        F.count_if(recent).alias("records"),
        F.coalesce(F.sum(F.when(recent, F.octet_length("payload"))), F.lit(0)).cast("bigint").alias("bytes"),
        F.floor(F.max(lag_micros("event_ts", "arrived_at")) / 1000).cast("bigint").alias("max_lag_ms"),
    )
