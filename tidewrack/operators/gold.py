"""Published aggregates over silver, KPIs and trends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewrack import domain
from tidewrack.functions.values import money, or_default, ratio


def gold_amount() -> Column:
    """GBP amount, else the original amount, else zero."""
    return F.coalesce(F.col("amount_gbp"), F.col("amount"), F.lit(0))


def _transactions() -> Column:
    return F.count(F.lit(1)).alias("transactions")


def _volume() -> Column:
    return money(F.sum(gold_amount())).alias("volume")


def _fraud() -> Column:
    return F.count_if(F.coalesce(F.col("is_fraud"), F.lit(False)))


def _errors() -> Column:
    return F.count_if(F.coalesce(F.col("level") == "ERROR", F.lit(False)))


def daily_revenue(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.col("event_date").alias("metric_date")).agg(
        _transactions(), _volume(), _fraud().alias("fraud")
    )


def _by_key(silver: DataFrame, key: str, default: str) -> DataFrame:
    return silver.groupBy(or_default(key, default).alias(key)).agg(_transactions(), _volume())


def customer_activity(silver: DataFrame) -> DataFrame:
    return _by_key(silver, "customer_id", domain.UNKNOWN_KEY)


def country_performance(silver: DataFrame) -> DataFrame:
    return _by_key(silver, "country", domain.UNKNOWN_COUNTRY)


def merchant_statistics(silver: DataFrame) -> DataFrame:
    return _by_key(silver, "merchant_category", domain.UNKNOWN_KEY)


def fraud_summary(silver: DataFrame) -> DataFrame:
    risk_sum = F.sum(F.when(F.col("is_fraud"), F.col("risk_score")))
    risk_count = F.count(F.when(F.col("is_fraud"), F.col("risk_score")))
    average = F.when(
        risk_count > 0, F.round(risk_sum.cast("decimal(20,3)") / risk_count.cast("decimal(18,0)"), 4)
    )
    return silver.groupBy(F.col("event_date").alias("metric_date")).agg(
        _fraud().alias("fraud_events"),
        ratio(_fraud(), F.count(F.lit(1)), 4).alias("rate"),
        average.cast("decimal(9,4)").alias("avg_risk"),
    )


def system_performance(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.col("event_date").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("events"),
        _errors().alias("failures"),
        ratio(_errors(), F.count(F.lit(1)), 4).alias("failure_rate"),
    )


GOLD: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_revenue": daily_revenue,
    "customer_activity": customer_activity,
    "country_performance": country_performance,
    "fraud_summary": fraud_summary,
    "merchant_statistics": merchant_statistics,
    "system_performance": system_performance,
}


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return {name: build(silver) for name, build in GOLD.items()}


def active_customers(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct customers per date; the approximate form keeps one sketch per date."""
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return silver.groupBy(F.col("event_date").alias("metric_date")).agg(
        counter(F.col("customer_id")).cast("bigint").alias("active_customers")
    )


def kpi_summary(silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Total volume, average transaction, failure rate, fraud alerts, freshness."""
    totals = silver.agg(
        _transactions(),
        F.coalesce(_volume(), money(F.lit(0))).alias("total_volume"),
        _fraud().alias("fraud_alerts"),
        _errors().alias("failures"),
        F.max("event_ts").alias("newest_event"),
        F.max("arrived_at").alias("newest_arrival"),
    )
    now = F.col("newest_arrival") if as_of is None else as_of
    average = F.col("total_volume") / F.when(
        F.col("transactions") > 0, F.col("transactions").cast("decimal(20,0)")
    )
    return totals.select(
        "transactions",
        "total_volume",
        F.coalesce(F.round(average, 2), F.lit(0)).cast("decimal(18,2)").alias("average_transaction"),
        ratio(F.col("failures"), F.col("transactions"), 4).alias("failure_rate"),
        "fraud_alerts",
        F.floor((F.unix_micros(now) - F.unix_micros("newest_event")) / 1_000_000)
        .cast("bigint")
        .alias("freshness_seconds"),
    )


def revenue_trend(daily: DataFrame) -> DataFrame:
    """Day-on-day change. One row per date, so the unpartitioned window stays small."""
    previous = F.lag("volume").over(Window.orderBy("metric_date"))
    return daily.select(
        "metric_date",
        "volume",
        previous.alias("previous_volume"),
        money(F.col("volume") - previous).alias("change"),
    )


def top_by_volume(table: DataFrame, key: str, k: int = 5) -> DataFrame:
    return table.select(key, "transactions", "volume").orderBy(F.desc("volume"), key).limit(k)


def volume_by_country(countries: DataFrame, transactions: Column) -> DataFrame:
    """Countries by falling volume; ``transactions`` says what a gold row counts for."""
    summed = countries.groupBy("country").agg(transactions.alias("transactions"), F.sum("volume").alias("volume"))
    return summed.orderBy(F.desc_nulls_last("volume"))


def fraud_days(summary: DataFrame) -> DataFrame:
    """Days with any fraud, newest first."""
    return summary.filter(F.col("fraud_events") > 0).select("metric_date", "fraud_events", "avg_risk").orderBy(F.desc_nulls_last("metric_date"))
