"""Windowed metrics, baselines, alert rules and the lag alarm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewrack import domain
from tidewrack.functions.calendar import lag_micros, tumbling
from tidewrack.functions.labels import (
    percent_text,
    pounds_text,
    seconds_text,
    whole_text,
    window_label,
)
from tidewrack.functions.values import fx_rate, has, ratio
from tidewrack.operators.enrich import unusual_country
from tidewrack.operators.quality import is_accepted

def window_totals(events: DataFrame, dataset: str, width: str = "5 minutes") -> DataFrame:
    """Additive counters per arrival window; batch or streaming."""
    accepted = is_accepted(dataset)
    gbp = F.round(F.col("amount") * fx_rate("currency"), 2)
    return (
        events.groupBy(tumbling("arrived_at", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(has("event_id")).alias("identified"),
            F.coalesce(F.sum(F.when(accepted, gbp)), F.lit(0)).cast("decimal(18,2)").alias("revenue"),
            F.count_if(F.coalesce(F.col("level") == "ERROR", F.lit(False))).alias("errors"),
            F.count_if(unusual_country()).alias("unusual"),
            F.max(lag_micros("event_ts", "arrived_at")).alias("max_lag_micros"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def _first_appearances(events: DataFrame, width: str) -> DataFrame:
    """Per window, how many ids appear for the first time."""
    return (
        events.filter(has("event_id"))
        .groupBy("event_id")
        .agg(F.min("arrived_at").alias("arrived_at"))
        .groupBy(tumbling("arrived_at", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("first_ids"))
        .select(F.col("w.start").alias("window_start"), "first_ids")
    )


def anomaly_metrics(events: DataFrame, dataset: str, width: str = "5 minutes") -> DataFrame:
    """One row per (window, metric).

    Duplicates of a window are its identified records less the ids first seen in it,
    so no per-row flag and no per-id window is needed.
    """
    per_window = window_totals(events, dataset, width).join(
        _first_appearances(events, width), "window_start", "left"
    )
    return metrics_of(
        per_window.withColumn(
            "duplicates", F.col("identified") - F.coalesce(F.col("first_ids"), F.lit(0))
        ),
        dataset,
    )


def metrics_of(per_window: DataFrame, dataset: str) -> DataFrame:
    """Window counters to (window, metric, value); duplicate rate only if counted."""
    n = F.col("events")
    values = {
        "transaction_count": n,
        "revenue": F.col("revenue"),
        "failure_rate": ratio(F.col("errors"), n, 4),
        "unusual_country": F.col("unusual"),
        "pipeline_latency_sec": F.round(
            F.col("max_lag_micros").cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)"), 4
        ),
    }
    if "duplicates" in per_window.columns:
        values["duplicate_rate"] = ratio(F.col("duplicates"), n, 4)
    return per_window.select(
        F.lit(dataset).alias("dataset"),
        "window_start",
        "window_end",
        *[value.cast("decimal(18,4)").alias(name) for name, value in values.items()],
    ).unpivot(["dataset", "window_start", "window_end"], list(values), "metric", "current")


def with_baseline(metrics: DataFrame, look_back_minutes: int = 10) -> DataFrame:
    """Oldest value of the same metric inside the look-back, gaps honoured.

    The frame is a time range, so a missing window is not replaced by an older one.
    Rows here are windows, not events: their number grows with time only.
    """
    seconds = F.unix_seconds("window_start")
    window = (
        Window.partitionBy("dataset", "metric")
        .orderBy(seconds)
        .rangeBetween(-60 * look_back_minutes, 0)
    )
    oldest = F.first("current").over(window)
    return metrics.withColumn(
        "baseline",
        F.when(F.col("metric") == "transaction_count", F.greatest(oldest, F.lit(1)))
        .otherwise(oldest)
        .cast("decimal(18,4)"),
    )


def _rules() -> list[tuple[Column, str, str]]:
    """(condition, severity, reason); the first that holds applies."""
    metric, current, baseline = F.col("metric"), F.col("current"), F.col("baseline")
    return [
        ((metric == "failure_rate") & (current > 0.1), "HIGH", "Failure rate exceeds 10%"),
        (
            (metric == "transaction_count") & (current >= baseline * 5),
            "HIGH",
            "Transaction count suddenly +400%",
        ),
        (
            (metric == "revenue") & (baseline > 0) & (current * 5 <= baseline),
            "CRITICAL",
            "Revenue drops 80%",
        ),
        (
            (metric == "duplicate_rate") & (current > 0.05),
            "MEDIUM",
            "Duplicate-event rate spikes",
        ),
        (
            (metric == "pipeline_latency_sec") & (current > 60),
            "HIGH",
            "Pipeline latency exceeds 60 seconds",
        ),
        (
            (metric == "unusual_country") & (current > 0),
            "MEDIUM",
            "Unusual country appears",
        ),
    ]


def detect(with_baselines: DataFrame) -> DataFrame:
    """Apply the alert rules; rows without an alert are dropped."""
    idle = (F.col("baseline") <= 0) & (F.col("current") <= 0)
    severity = F.lit(None).cast("string")
    reason = F.lit(None).cast("string")
    for condition, level, text in reversed(_rules()):
        severity = F.when(condition, F.lit(level)).otherwise(severity)
        reason = F.when(condition, F.lit(text)).otherwise(reason)
    return (
        with_baselines.filter(~idle)
        .withColumns({"severity": severity, "reason": reason})
        .filter("severity IS NOT NULL")
    )


def alert_text(alerts: DataFrame) -> DataFrame:
    """The alert as published: all strings."""
    metric = F.col("metric")
    current = (
        F.when(metric.isin("failure_rate", "duplicate_rate"), percent_text("current"))
        .when(metric == "revenue", pounds_text("current"))
        .when(metric == "pipeline_latency_sec", seconds_text("current"))
        .otherwise(whole_text("current"))
    )
    normal = (
        F.when(metric == "failure_rate", F.lit("2–5%"))
        .when(metric == "duplicate_rate", F.lit("<1%"))
        .when(metric == "pipeline_latency_sec", F.lit("<5s"))
        .when(metric == "unusual_country", F.lit("0"))
        .when(metric == "revenue", pounds_text("baseline"))
        .otherwise(whole_text("baseline"))
    )
    return alerts.select(
        "dataset",
        "metric",
        current.alias("current"),
        normal.alias("normal"),
        "severity",
        window_label("window_start", "window_end").alias("window"),
        "reason",
    )


def lag_per_minute(events: DataFrame) -> DataFrame:
    """Largest arrival lag (ms) per arrival minute; batch or streaming."""
    return (
        events.groupBy(tumbling("arrived_at", "1 minute").alias("w"))
        .agg(F.max(lag_micros("event_ts", "arrived_at")).alias("micros"))
        .select(
            F.col("w.start").alias("minute"),
            F.floor(F.col("micros") / 1000).cast("bigint").alias("max_lag_ms"),
        )
    )


def alarm_m_of_n(
    points: DataFrame,
    threshold: int = domain.LAG_ALARM_MS,
    evaluate: int = domain.ALARM_POINTS,
    breaches: int = domain.ALARM_BREACHES,
) -> DataFrame:
    """In alarm when ``breaches`` of the last ``evaluate`` minutes exceed the threshold.

    A breaching minute counts toward itself and the following ``evaluate - 1`` minutes;
    minutes without data never breach. Only breaches are expanded, so no minute spine
    and no global window is built.
    """
    newest = points.agg(F.max("minute")).scalar()
    steps = F.sequence(F.lit(0), F.lit(evaluate - 1))
    return (
        points.filter(F.col("max_lag_ms") > threshold)
        .select(F.col("minute"), F.explode(steps).alias("step"))
        .select((F.col("minute") + F.make_dt_interval(mins=F.col("step"))).alias("minute"))
        .filter(F.col("minute") <= newest)
        .groupBy("minute")
        .agg(F.count(F.lit(1)).alias("breaching_points"))
        .withColumn("in_alarm", F.col("breaching_points") >= breaches)
    )


def throughput_per_minute(raw: DataFrame) -> DataFrame:
    """Records, bytes and per-second rates per arrival minute of ``payload`` rows."""
    return (
        raw.groupBy(tumbling("arrived_at", "1 minute").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(F.octet_length("payload")).cast("bigint").alias("bytes"),
        )
        .select(
            F.col("w.start").alias("minute"),
            "records",
            "bytes",
            ratio(F.col("records"), F.lit(60), 4).alias("records_per_sec"),
            ratio(F.col("bytes"), F.lit(60), 2).cast("decimal(18,2)").alias("bytes_per_sec"),
        )
    )


def sliding_look_back(events: DataFrame, width: str = "15 minutes", step: str = "5 minutes") -> DataFrame:
    return (
        events.groupBy(F.window("arrived_at", width, step).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.max(lag_micros("event_ts", "arrived_at")).alias("max_lag_micros"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "events",
            "max_lag_micros",
        )
    )


def lateness_histogram(events: DataFrame) -> DataFrame:
    """Late events by whole hours of lateness."""
    hours = F.floor(lag_micros("event_ts", "arrived_at") / 3_600_000_000).cast("bigint")
    return events.groupBy(hours.alias("hours_late")).agg(F.count(F.lit(1)).alias("events"))
