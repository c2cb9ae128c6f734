"""Gold kept up to date from the sums of single batches.

Every published silver batch has a few sums per date, customer, country and merchant category. The totals
of a dataset are the sums of the batches they hold, by name in the totals' log. Publishing compares those names
with silver's log, adds the sums of batches that are new, takes off those that were repeated, shrunk
or quarantined meanwhile, and writes the gold tables from the totals. No stored silver row is read
but those of new batches. What a lost job leaves undone, the next publication does.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.values import money, or_default, ratio
from tidewrack.operators.gold import gold_amount
from tidewrack.sources import lake as store
from tidewrack.sources.commits import PUBLISHED, Conflict, Entry, new_attempt
from tidewrack.sources.lake import Lake

TOTALS = "_totals"
SUMS = ("transactions", "volume", "fraud", "risk", "risks", "errors")
SUMS_SCHEMA = "key string, transactions bigint, volume decimal(38,2), fraud bigint, risk decimal(38,3), risks bigint, errors bigint"
#: Buckets of a distinct-count sketch, as a power of two.
SKETCH_BITS = 12
KINDS = ("date", "customer", "country", "category")


def batch_sums(silver: DataFrame, *by: str) -> DataFrame:
    """``by``, kind, key and the additive sums behind all gold tables, in one pass.

    Rows are combined on the map side, so a hot key has one row per task and kind.
    """
    keys = {
        "date": F.col("event_date").cast("string"),
        "customer": or_default("customer_id", domain.UNKNOWN_KEY),
        "country": or_default("country", domain.UNKNOWN_COUNTRY),
        "category": or_default("merchant_category", domain.UNKNOWN_KEY),
    }
    fraud = F.coalesce(F.col("is_fraud"), F.lit(False))
    rows = silver.select(
        *by,
        F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keys.items()])).alias("of"),
        gold_amount().cast("decimal(18,2)").alias("amount"),
        fraud.alias("is_fraud"),
        F.when(fraud, F.col("risk_score")).alias("risk_score"),
        F.coalesce(F.col("level") == "ERROR", F.lit(False)).alias("is_error"),
    )
    return rows.groupBy(*by, "of.kind", "of.key").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").cast("decimal(38,2)").alias("volume"),
        F.count_if("is_fraud").alias("fraud"),
        F.coalesce(F.sum("risk_score"), F.lit(0)).cast("decimal(38,3)").alias("risk"),
        F.count("risk_score").alias("risks"),
        F.count_if("is_error").alias("errors"),
    )


def gold_of(totals: DataFrame) -> dict[str, DataFrame]:
    """The six gold tables from a dataset's totals."""
    of = {kind: totals.filter(F.col("kind") == kind) for kind in KINDS}
    date = F.col("key").cast("date").alias("metric_date")
    average = F.round(F.col("risk").cast("decimal(20,3)") / F.when(F.col("risks") > 0, F.col("risks").cast("decimal(18,0)")), 4)

    def by_key(kind: str, name: str) -> DataFrame:
        return of[kind].select(F.col("key").alias(name), "transactions", money("volume").alias("volume"))

    return {
        "daily_revenue": of["date"].select(date, "transactions", money("volume").alias("volume"), "fraud"),
        "customer_activity": by_key("customer", "customer_id"),
        "country_performance": by_key("country", "country"),
        "fraud_summary": of["date"].select(
            date, F.col("fraud").alias("fraud_events"), ratio(F.col("fraud"), F.col("transactions"), 4).alias("rate"), average.cast("decimal(9,4)").alias("avg_risk")
        ),
        "merchant_statistics": by_key("category", "merchant_category"),
        "system_performance": of["date"].select(
            date, F.col("transactions").alias("events"), F.col("errors").alias("failures"), ratio(F.col("errors"), F.col("transactions"), 4).alias("failure_rate")
        ),
    }


def batch_sketches(silver: DataFrame, *by: str) -> DataFrame:
    """``by``, metric_date and a sketch of its distinct customers, of bounded size, that merges with others."""
    return silver.groupBy(*by, F.col("event_date").alias("metric_date")).agg(F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("sketch"))


def active_customers(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """Distinct customers per date over all published batches, from stored sketches: about 1.6 % off at one sigma.

    Sketches of new batches are made first; stored silver is not read for others. A batch that was repeated or
    quarantined has no say, since sketches are merged per live batch.
    """
    entries = store.live_entries(spark, lake, "silver", dataset, (PUBLISHED,))
    kept = _add_parts(spark, lake, dataset, entries, "sketches", batch_sketches)
    if not entries:
        return spark.createDataFrame([], "metric_date date, active_customers bigint")
    root = _root(lake, "sketches", dataset)
    sketches = spark.read.schema("metric_date date, sketch binary").parquet(*[f"{root}/{kept[entry.path].path}" for entry in entries])
    merged = sketches.groupBy("metric_date").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("metric_date", F.hll_sketch_estimate("sketch").alias("active_customers"))


def _root(lake: Lake, name: str, dataset: str) -> str:
    return f"{lake.root.rstrip('/')}/{name}/{dataset}"


def _add_parts(
    spark: SparkSession, lake: Lake, dataset: str, entries: list[Entry], kind: str = "parts", make: Callable[..., DataFrame] = batch_sums
) -> dict[str, Entry]:
    """What ``make`` sums up of silver batches, stored once for each; gives the entry of every stored part."""
    log = lake.log(spark, kind, dataset)
    known = log.live()
    lacking = [entry for entry in entries if entry.path not in known]
    if lacking:
        rows = None
        for entry in lacking:
            part = store.read_entry(spark, lake, "silver", dataset, entry).withColumn("path", F.lit(entry.path))
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        run = new_attempt()
        names = rows.withColumns({"attempt": F.element_at(F.split("path", "[/=]"), 2), "batch": F.element_at(F.split("path", "[/=]"), 4)})
        make(names, "attempt", "batch").write.partitionBy("attempt", "batch").parquet(f"{_root(lake, kind, dataset)}/run={run}")
        log.commit([Entry(entry.path, f"run={run}/{entry.path}") for entry in lacking])
        known = log.live()
    return known


def _sums_at(spark: SparkSession, paths: list[str], sign: int) -> DataFrame:
    rows = spark.read.schema(f"kind string, {SUMS_SCHEMA}").parquet(*paths)
    return rows.select("kind", "key", *[(F.col(name) * sign).cast(rows.schema[name].dataType).alias(name) for name in SUMS])


def publish(spark: SparkSession, lake: Lake, dataset: str) -> int:
    """Bring gold up to silver's published batches; gives the number of batches added or taken off."""
    log = lake.log(spark, "totals", dataset)
    while True:
        version, state = log.state()
        live = {entry.path: entry for entry in store.live_entries(spark, lake, "silver", dataset, (PUBLISHED,))}
        held = state.keys() - {TOTALS}
        new, gone = sorted(live.keys() - held), sorted(held - live.keys())
        if not new and not gone:
            break
        parts = _add_parts(spark, lake, dataset, [live[path] for path in new])
        root = _root(lake, "parts", dataset)
        frames = []
        if TOTALS in state and state[TOTALS].path:
            frames.append(spark.read.schema(f"{SUMS_SCHEMA}, kind string").parquet(f"{_root(lake, 'totals', dataset)}/{state[TOTALS].path}").select("kind", "key", *SUMS))
        for paths, sign in ((new, 1), (gone, -1)):
            if paths:
                frames.append(_sums_at(spark, [f"{root}/{parts[path].path}" for path in paths], sign))
        merged = frames[0]
        for frame in frames[1:]:
            merged = merged.unionByName(frame)
        merged = merged.groupBy("kind", "key").agg(*[F.sum(name).cast(merged.schema[name].dataType).alias(name) for name in SUMS])
        name = f"attempt={new_attempt()}"
        merged.filter("transactions <> 0").hint("rebalance", "kind").write.partitionBy("kind").parquet(f"{_root(lake, 'totals', dataset)}/{name}")
        try:
            version = log.commit([Entry(TOTALS, name), *[Entry(path, path) for path in new]], gone, version)
        except Conflict:
            continue
        _write_gold(spark, lake, dataset, name, version)
        return len(new) + len(gone)
    if TOTALS in state and store.gold_version(spark, lake, dataset) < version:  # a job ended between totals and gold
        _write_gold(spark, lake, dataset, state[TOTALS].path, version)
    return 0


def _write_gold(spark: SparkSession, lake: Lake, dataset: str, totals: str, version: int) -> None:
    stored = spark.read.schema(f"{SUMS_SCHEMA}, kind string").parquet(f"{_root(lake, 'totals', dataset)}/{totals}")
    tables = gold_of(stored)
    with ThreadPoolExecutor(len(tables)) as pool:  # six small jobs, side by side
        for done in [pool.submit(store.write_gold, {name: frame}, lake, dataset, version) for name, frame in tables.items()]:
            done.result()
