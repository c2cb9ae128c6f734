"""Row rules, routing, and data-quality reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.values import all_of, any_of, filled, has, percentage, ratio

DUPLICATE = ("DUPLICATE event_id", "event_id")


@dataclass(frozen=True)
class Rule:
    code: str
    field: str
    failed: Column


def missing_rules(dataset: str) -> list[Rule]:
    names = domain.REQUIRED_FIELDS
    if dataset not in domain.NON_FINANCIAL_DATASETS:
        names += domain.FINANCIAL_REQUIRED_FIELDS
    # the wire text decides presence of the amount: 'not-a-number' is present
    return [
        Rule(f"MISSING {name}", name, ~has("amount_raw" if name == "amount" else name))
        for name in names
    ]


def bad_currency() -> Column:
    return has("currency") & ~F.col("currency").isin(*domain.CURRENCIES)


def negative_amount() -> Column:
    return F.col("amount").isNotNull() & (F.col("amount") < 0)


def wrong_type_amount() -> Column:
    return has("amount_raw") & F.col("amount").isNull()


def future_timestamp() -> Column:
    limit = F.col("arrived_at") + F.expr(f"INTERVAL {domain.FUTURE_TOLERANCE_SECONDS} SECONDS")
    return F.coalesce(F.col("event_ts") > limit, F.lit(False))


def invalid_rules() -> list[Rule]:
    return [
        Rule("INVALID currency", "currency", bad_currency()),
        Rule("NEGATIVE amount", "amount", negative_amount()),
        Rule("INVALID amount", "amount", wrong_type_amount()),
        Rule("FUTURE timestamps", "timestamp", future_timestamp()),
        Rule("INVALID schema", "event_type", ~has("event_type")),
    ]


def is_complete(dataset: str) -> Column:
    return all_of([~rule.failed for rule in missing_rules(dataset)])


def is_valid() -> Column:
    return all_of([~rule.failed for rule in invalid_rules()])


def is_accepted(dataset: str) -> Column:
    """Complete and valid, in the form scans can push down. Null counts as no.

    The rules collapse: an accepted amount is a non-negative number, which is also
    present; an accepted currency is one of the list, which is also present.
    """
    future = F.col("event_ts") > F.col("arrived_at") + F.expr(
        f"INTERVAL {domain.FUTURE_TOLERANCE_SECONDS} SECONDS"
    )
    common = [filled(name) for name in domain.REQUIRED_FIELDS]
    timely = F.coalesce(~future, F.lit(True))
    if dataset in domain.NON_FINANCIAL_DATASETS:
        return all_of([*common, ~bad_currency(), ~negative_amount(), ~wrong_type_amount(), timely])
    return all_of(
        [
            *common,
            filled("customer_id"),
            F.col("currency").isin(*domain.CURRENCIES),
            F.col("amount") >= 0,
            timely,
        ]
    )


def reasons(dataset: str) -> Column:
    rules = missing_rules(dataset) + invalid_rules()
    return F.array_compact(F.array(*[F.when(r.failed, F.lit(r.code)) for r in rules]))


def accepted_rows(events: DataFrame, dataset: str) -> DataFrame:
    """Rows routed to bronze. Duplicates pass; silver removes them."""
    return events.filter(is_accepted(dataset))


def rejected_rows(events: DataFrame, dataset: str) -> DataFrame:
    """The exact complement of ``accepted_rows``, with the reasons of each row."""
    return events.filter(~F.coalesce(is_accepted(dataset), F.lit(False))).withColumn(
        "reasons", reasons(dataset)
    )


def invalid_by_anti_join(parsed: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows whose id has no valid row (batch form of the stream job's second sink)."""
    return parsed.join(valid.select("event_id"), "event_id", "left_anti").withColumn(
        "quarantine_reason", F.lit("schema_or_quality")
    )


def stream_accepts() -> Column:
    """The stream job's shorter filter: ids, amount and currency only."""
    return (
        F.col("event_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("amount").isNotNull()
        & (F.col("amount") >= 0)
        & F.col("currency").isin(*domain.CURRENCIES)
    )


def with_flags(events: DataFrame, dataset: str) -> DataFrame:
    return with_duplicate_flag(
        events.withColumns(
            {
                "is_complete": is_complete(dataset),
                "is_valid": is_valid(),
                "reasons": reasons(dataset),
            }
        )
    )


def with_duplicate_flag(events: DataFrame) -> DataFrame:
    """Mark 2nd and later records of an id, in arrival order over all records.

    Written as aggregate + join instead of a window per id: the aggregate combines on
    the map side and a skewed join partition can be split, so one id may hold any
    share of the rows.
    """
    order = F.struct("arrived_at", "seq")
    repeated = (
        events.filter(has("event_id"))
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("first_copy"))
        .filter("copies > 1")
        .select("event_id", "first_copy")
    )
    return (
        events.join(repeated, "event_id", "left")
        .withColumn("is_duplicate", F.coalesce(order > F.col("first_copy"), F.lit(False)))
        .drop("first_copy")
    )


def _per_id(events: DataFrame, dataset: str) -> DataFrame:
    good = F.coalesce(is_accepted(dataset), F.lit(False))
    return (
        events.select(
            "event_id",
            F.struct("arrived_at", "seq", good.alias("good")).alias("record"),
            is_complete(dataset).alias("complete"),
            is_valid().alias("valid"),
            good.alias("good"),
        )
        .groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.count_if("complete").alias("complete"),
            F.count_if("valid").alias("valid"),
            F.count_if("good").alias("good"),
            F.min("record").alias("first_record"),
        )
    )


def quality_report(events: DataFrame, dataset: str) -> DataFrame:
    """One-row scorecard.

    Everything is summed per id first. Of an id's good rows, all but its first record
    are duplicates, so the quarantined count needs no per-row duplicate flag.
    """
    identified = has("event_id")
    repeats = F.when(identified, F.col("copies") - 1).otherwise(F.lit(0))
    good_repeats = F.when(
        identified, F.col("good") - F.col("first_record.good").cast("int")
    ).otherwise(F.lit(0))
    totals = _per_id(events, dataset).agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
            for name, c in {
                "records": F.col("copies"),
                "complete": F.col("complete"),
                "valid": F.col("valid"),
                "unique": identified.cast("int"),
                "duplicates": repeats,
                "quarantined": F.col("copies") - F.col("good") + good_repeats,
            }.items()
        ]
    )
    return scorecard(totals, dataset)


def scorecard(totals: DataFrame, dataset: str) -> DataFrame:
    """The report from its six counts."""
    n = F.col("records")
    weighted = F.col("complete") * 40 + F.col("valid") * 40 + F.col("unique") * 20
    return totals.select(
        F.lit(dataset).alias("dataset"),
        n,
        percentage(F.col("complete"), n).alias("completeness"),
        percentage(F.col("valid"), n).alias("validity"),
        F.when(n == 0, F.lit(100))
        .otherwise(percentage(F.col("unique"), n))
        .cast("decimal(9,2)")
        .alias("uniqueness"),
        F.col("duplicates"),
        F.col("quarantined"),
        F.when(n == 0, F.lit(20)).otherwise(ratio(weighted, n, 1)).cast("decimal(9,1)").alias("score"),
    )


def row_counts(dataset: str) -> dict[str, Column]:
    """The report's counts that need no look at other rows; fit for ``observe``."""
    return {
        "records": F.count(F.lit(1)),
        "complete": F.count_if(is_complete(dataset)),
        "valid": F.count_if(is_valid()),
        "good": F.count_if(F.coalesce(is_accepted(dataset), F.lit(False))),
    }


def report_of_counts(ids: DataFrame, counts: dict[str, int], dataset: str) -> DataFrame:
    """The same report as ``quality_report`` from observed ``row_counts`` and the ids alone.

    ``ids`` has event_id, arrived_at, seq and good, whether the record was accepted.
    """
    identified = has("event_id")
    per_id = ids.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if("good").alias("good"), F.min(F.struct("arrived_at", "seq", "good")).alias("first_record")
    )
    good_repeats = F.when(identified, F.col("good") - F.col("first_record.good").cast("int")).otherwise(F.lit(0))

    def total(column: Column, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name)

    summed = per_id.agg(
        total(identified.cast("int"), "unique"),
        total(F.when(identified, F.col("copies") - 1).otherwise(F.lit(0)), "duplicates"),
        total(good_repeats, "good_repeats"),
    )
    totals = summed.select(
        *[F.lit(counts[name]).cast("bigint").alias(name) for name in ("records", "complete", "valid")],
        "unique", "duplicates", (F.lit(counts["records"] - counts["good"]) + F.col("good_repeats")).cast("bigint").alias("quarantined"),
    )
    return scorecard(totals, dataset)


def quality_issues(events: DataFrame, dataset: str) -> DataFrame:
    """Issue counts by code, most frequent first; only codes that occur.

    All rule counters come from one pass; nothing is exploded per row.
    """
    rules = missing_rules(dataset) + invalid_rules()
    counted = events.agg(*[F.count_if(r.failed).alias(f"n{i}") for i, r in enumerate(rules)])
    by_rule = counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(r.code).alias("code"),
                        F.lit(r.field).alias("field"),
                        F.col(f"n{i}").alias("count"),
                    )
                    for i, r in enumerate(rules)
                ]
            )
        )
    )
    repeats = (
        events.filter(has("event_id"))
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("count"))
        .select(F.lit(DUPLICATE[0]).alias("code"), F.lit(DUPLICATE[1]).alias("field"), "count")
    )
    return by_rule.unionByName(repeats).filter("count > 0").orderBy(F.desc("count"), "code")


def duplicate_ids(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def scan_defect() -> Column:
    """Row predicate of the penalty scan; used for both the count and the quarantine."""
    return any_of([~has("customer_id"), bad_currency(), negative_amount()])


def quality_scan(events: DataFrame, dataset: str = "transactions") -> DataFrame:
    """Penalty score 100 − 40·missing − 30·currency − 20·negative − 10·duplicate ids.

    One pass: counters are summed per id, so repeated ids and row defects come out of
    the same shuffle.
    """
    per_id = events.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(~has("customer_id")).alias("missing"),
        F.count_if(bad_currency()).alias("currency"),
        F.count_if(negative_amount()).alias("negative"),
    )
    totals = per_id.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
            for name, c in {
                "records": F.col("copies"),
                "missing_customer_id": F.col("missing"),
                "invalid_currency": F.col("currency"),
                "negative_amount": F.col("negative"),
                "duplicate_event_id": (F.col("copies") > 1).cast("int"),
            }.items()
        ]
    )
    penalty = (
        F.col("missing_customer_id") * 40
        + F.col("invalid_currency") * 30
        + F.col("negative_amount") * 20
        + F.col("duplicate_event_id") * 10
    )
    n = F.greatest(F.col("records"), F.lit(1))
    return totals.select(
        F.lit(dataset).alias("dataset"),
        "records",
        "missing_customer_id",
        "invalid_currency",
        "negative_amount",
        "duplicate_event_id",
        ratio(n * 100 - penalty, n, 1).alias("quality_score"),
    )
