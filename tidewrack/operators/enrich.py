"""Enrichment of accepted events: country, GBP amount, dates, fraud flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.values import has, to_gbp


def country_dimension(frame: DataFrame) -> DataFrame:
    """The fixed ten-row country table."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in domain.COUNTRY_NAMES.items())
    return frame.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(country, country_name)")


def is_fraud() -> Column:
    """High risk or the flagged country; never null."""
    risk = F.coalesce(F.col("risk_score"), F.lit(0))
    return (risk >= F.lit(domain.FRAUD_RISK).cast("decimal(5,3)")) | F.coalesce(
        F.col("country") == domain.FRAUD_COUNTRY, F.lit(False)
    )


def unusual_country() -> Column:
    return has("country") & ~F.col("country").isin(*domain.COUNTRY_NAMES)


def late_event(hours: int = domain.LATE_AFTER_HOURS) -> Column:
    return F.coalesce(
        F.col("event_ts") < F.col("arrived_at") - F.expr(f"INTERVAL {hours} HOURS"), F.lit(False)
    )


def derive(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add the derived columns that need no join: what gold is computed from."""
    stamped = events.withColumn(
        "ingested_at", F.current_timestamp() if ingested_at is None else ingested_at
    )
    happened = F.coalesce(F.col("event_ts"), F.col("ingested_at"))
    return stamped.withColumns(
        {
            "amount_gbp": to_gbp("amount", "currency"),
            "event_date": F.to_date(happened),
            "event_hour": F.hour(happened),
            "is_fraud": is_fraud(),
            "risk_score": F.coalesce(
                F.col("risk_score"), F.lit(domain.DEFAULT_RISK).cast("decimal(5,3)")
            ),
        }
    )


def with_country_name(events: DataFrame) -> DataFrame:
    """Left join with the country table: null without a country, 'Unknown' off the list."""
    # ten fixed rows, so the broadcast is bounded by construction
    named = events.join(F.broadcast(country_dimension(events)), "country", "left")
    return named.withColumn(
        "country_name",
        F.when(
            has("country"), F.coalesce(F.col("country_name"), F.lit(domain.UNKNOWN_COUNTRY_NAME))
        ),
    )


def enrich(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """All derived columns. ``ingested_at`` defaults to the current time."""
    return with_country_name(derive(events, ingested_at))
