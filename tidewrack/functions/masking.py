"""Masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewrack.functions.values import as_column


def mask_email(value: str | Column) -> Column:
    """First character, six stars and the domain; ``***`` without a domain."""
    column = as_column(value)
    user = F.split_part(column, F.lit("@"), F.lit(1))
    domain = F.split_part(column, F.lit("@"), F.lit(2))
    initial = F.when(user == "", F.lit("*")).otherwise(F.substring(user, 1, 1))
    return F.when(domain == "", F.lit("***")).otherwise(
        F.concat(initial, F.lit("******@"), domain)
    )


def hash_value(value: str | Column) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(as_column(value), 256), 1, 16)


def tokenize(value: str | Column) -> Column:
    return F.concat(F.lit("tok_"), F.substring(F.sha2(as_column(value), 256), 1, 12))
