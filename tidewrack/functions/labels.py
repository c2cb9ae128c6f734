"""Text forms used in alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewrack.functions.values import as_column


def percent_text(value: str | Column) -> Column:
    return F.concat(
        F.round(as_column(value) * 100, 1).cast("decimal(18,1)").cast("string"), F.lit("%")
    )


def pounds_text(value: str | Column) -> Column:
    return F.concat(F.lit("£"), F.format_number(F.round(as_column(value), 0), 0))


def seconds_text(value: str | Column) -> Column:
    return F.concat(F.round(as_column(value), 1).cast("decimal(18,1)").cast("string"), F.lit("s"))


def whole_text(value: str | Column) -> Column:
    return F.round(as_column(value), 0).cast("bigint").cast("string")


def window_label(start: str | Column, end: str | Column) -> Column:
    return F.concat(
        F.date_format(as_column(start), "HH:mm"),
        F.lit("–"),
        F.date_format(as_column(end), "HH:mm"),
    )
