"""Event time, partition columns and day ranges. All in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.values import as_column

PARTITION_COLUMNS = ("year", "month", "day", "hour")
_PATTERNS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def parse_timestamp(value: str | Column) -> Column:
    """ISO text to timestamp; null instead of an error when unparseable."""
    return F.try_to_timestamp(as_column(value))


def wire_timestamp(value: str | Column) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def with_partitions(
    frame: DataFrame, time_column: str, names: tuple[str, ...] = PARTITION_COLUMNS
) -> DataFrame:
    """Add zero-padded string columns year, month, day, hour (or the first of them)."""
    return frame.withColumns(
        {name: F.date_format(F.col(time_column), _PATTERNS[name]) for name in names}
    )


def lag_micros(event_time: str | Column, arrival: str | Column) -> Column:
    """Microseconds an event arrived after it happened; never below 0."""
    micros = F.unix_micros(as_column(arrival)) - F.unix_micros(as_column(event_time))
    return F.greatest(F.coalesce(micros, F.lit(0)), F.lit(0))


def tumbling(time_column: str | Column, width: str) -> Column:
    return F.window(as_column(time_column), width)


def expand_days(frame: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """One row per calendar day of an inclusive date range held in ``frame``."""
    return frame.select(
        F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))).alias(name)
    )
