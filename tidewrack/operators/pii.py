"""Masking policies and the audit of masked tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.masking import hash_value, mask_email, tokenize
from tidewrack.functions.values import has

_MASKED_FORM = {
    **{name: r"^(.\*{6}@.+|\*{3})$" for name in domain.MASKED_COLUMNS},
    **{name: r"^[0-9a-f]{16}$" for name in domain.HASHED_COLUMNS},
    **{name: r"^tok_[0-9a-f]{12}$" for name in domain.TOKENISED_COLUMNS},
}


def apply_policy(frame: DataFrame, policy: str) -> DataFrame:
    """``administrator`` sees clear text, ``analyst`` masks, ``restricted`` has no PII."""
    if policy not in domain.PII_POLICIES:
        raise ValueError(f"unknown policy {policy!r}; known: {', '.join(domain.PII_POLICIES)}")
    present = [name for name in domain.PII_COLUMNS if name in frame.columns]
    if policy == "administrator":
        return frame
    if policy == "restricted":
        return frame.drop(*present)
    action = {
        **{name: mask_email for name in domain.MASKED_COLUMNS},
        **{name: hash_value for name in domain.HASHED_COLUMNS},
        **{name: tokenize for name in domain.TOKENISED_COLUMNS},
    }
    return frame.withColumns(
        {name: F.when(has(name), action[name](name)).otherwise(F.col(name)) for name in present}
    )


def audit(frame: DataFrame) -> DataFrame:
    """Per PII column: rows with a value, and rows whose value is not in masked form."""
    present = [name for name in domain.PII_COLUMNS if name in frame.columns]
    counters = []
    for name in present:
        counters.append(F.count_if(has(name)).alias(f"{name}_n"))
        counters.append(
            F.count_if(has(name) & ~F.col(name).rlike(_MASKED_FORM[name])).alias(f"{name}_clear")
        )
    return frame.agg(*counters).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.col(f"{name}_n").alias("values_checked"),
                        F.col(f"{name}_clear").alias("clear_values"),
                    )
                    for name in present
                ]
            )
        )
    )
