"""Star schema: four dimensions and the transaction fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewrack.functions.values import has
from tidewrack.operators.enrich import with_country_name
from tidewrack.sources.commits import CommitLog, Conflict, Entry, new_attempt

KEY_BUCKET_DIGITS = 3


def dense_key(frame: DataFrame, natural: Column, name: str) -> DataFrame:
    """Gap-free integer key for distinct natural keys, without a global sort.

    Keys are numbered inside hash buckets (16^3 of them, filled evenly because the
    natural keys are distinct) and each bucket starts after the rows of the buckets
    before it. Only the 4,096 bucket sizes pass through a single task.
    """
    bucketed = frame.withColumn("_bucket", F.substring(F.sha2(natural, 256), 1, KEY_BUCKET_DIGITS))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    return (
        bucketed.withColumn("_inside", inside)
        # at most 16^3 rows, so the broadcast is bounded by construction
        .join(F.broadcast(starts), "_bucket")
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_bucket", "_inside", "_start")
    )


def time_key(event_time: Column) -> Column:
    """yyyyMMddHH: known from the event itself, so the fact needs no time join."""
    return F.date_format(event_time, "yyyyMMddHH").cast("int")


def dim_time(silver: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "event_ts")
    return (
        silver.filter("event_ts IS NOT NULL")
        .select(hour.alias("at"))
        .distinct()
        .select(
            time_key(F.col("at")).alias("time_key"),
            F.to_date("at").alias("date"),
            F.hour("at").alias("hour"),
            F.date_format("at", "EEEE").alias("weekday"),
            F.month("at").alias("month"),
            F.year("at").alias("year"),
        )
    )


def dim_customer(silver: DataFrame, profile: DataFrame) -> DataFrame:
    """Customers seen in silver, with segment and country where the profile has them."""
    seen = silver.filter(has("customer_id")).select("customer_id").distinct()
    keyed = dense_key(seen, F.col("customer_id"), "customer_key")
    return keyed.join(profile, "customer_id", "left").select(
        "customer_key", "customer_id", "customer_segment", "country"
    )


def dim_merchant(silver: DataFrame) -> DataFrame:
    """One row per merchant and category (a merchant may sell in several)."""
    seen = (
        silver.filter(has("merchant_id"))
        .select("merchant_id", F.coalesce("merchant_category", F.lit("")).alias("merchant_category"))
        .distinct()
    )
    natural = F.concat_ws("|", "merchant_id", "merchant_category")
    return dense_key(seen, natural, "merchant_key").select(
        "merchant_key", "merchant_id", "merchant_category"
    )


def dim_country(silver: DataFrame) -> DataFrame:
    seen = silver.filter(has("country")).select("country").distinct()
    keyed = dense_key(seen, F.col("country"), "country_key")
    return with_country_name(keyed).select("country_key", "country", "country_name")


def fact_transaction(
    silver: DataFrame, customers: DataFrame, merchants: DataFrame, countries: DataFrame
) -> DataFrame:
    """One row per silver event with resolved keys.

    Dimension sides are broadcast only when Spark measures them as small; the customer
    side may shuffle, and then hot customers are split by the skew-join setting.
    """
    return (
        silver.withColumn("_category", F.coalesce("merchant_category", F.lit("")))
        .join(customers.select("customer_id", "customer_key"), "customer_id", "left")
        .join(
            merchants.select(
                "merchant_id", F.col("merchant_category").alias("_category"), "merchant_key"
            ),
            ["merchant_id", "_category"],
            "left",
        )
        .join(countries.select("country", "country_key"), "country", "left")
        .select(
            F.col("event_id").alias("transaction_id"),
            "customer_key",
            "merchant_key",
            time_key(F.col("event_ts")).alias("time_key"),
            "country_key",
            F.col("amount"),
            F.col("risk_score"),
        )
    )


def fact_orphans(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key: fact rows whose key is set but absent from its dimension.

    The fact is read once; its keys are counted before the anti join, which then sees
    one row per key value however skewed the fact is.
    """
    keys = list(dimensions)
    used = (
        fact.select(*[F.col(k).cast("bigint").alias(k) for k in keys])
        .unpivot([], keys, "foreign_key", "key")
        .groupBy("foreign_key", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = None
    for name, dimension in dimensions.items():
        part = dimension.select(F.lit(name).alias("foreign_key"), F.col(name).cast("bigint").alias("key"))
        known = part if known is None else known.unionByName(part)
    joined = used.join(known.withColumn("known", F.lit(True)), ["foreign_key", "key"], "left")
    orphaned = F.col("key").isNotNull() & F.col("known").isNull()
    return joined.groupBy("foreign_key").agg(
        F.coalesce(F.sum(F.when(orphaned, F.col("rows"))), F.lit(0)).cast("bigint").alias("orphans")
    )


#: Natural key columns and key column of the dimensions that have surrogate keys.
KEYED = {
    "customer": (("customer_id",), "customer_key"),
    "merchant": (("merchant_id", "merchant_category"), "merchant_key"),
    "country": (("country",), "country_key"),
}


def _naturals(silver: DataFrame, dimension: str) -> DataFrame:
    columns, _ = KEYED[dimension]
    seen = silver.filter(has(columns[0]))
    return seen.select(columns[0], *[F.coalesce(c, F.lit("")).alias(c) for c in columns[1:]]).distinct()


class KeyRegistry:
    """Natural keys and the numbers they were given, below ``root``. Numbers are never changed or given twice.

    A load appends the naturals it is the first to see, numbered after the largest number given so far. It
    is published only if no other load was meanwhile, else made anew. A repeated load finds its
    naturals registered and appends nothing.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, f"{root.rstrip('/')}/_keys"

    def _read(self, dimension: str, entries: list[Entry]) -> DataFrame:
        columns, key = KEYED[dimension]
        ddl = ", ".join([f"{key} bigint", *[f"{c} string" for c in columns]])
        paths = [f"{self.root}/{dimension}/{entry.path}" for entry in entries if entry.path]
        return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

    def keys(self, dimension: str) -> DataFrame:
        """(key, naturals ...) given so far."""
        return self._read(dimension, list(CommitLog(self.spark, f"{self.root}/_log/{dimension}").live().values()))

    def register(self, dimension: str, naturals: DataFrame) -> DataFrame:
        """Give numbers to naturals that have none; the keys of all."""
        columns, key = KEYED[dimension]
        log = CommitLog(self.spark, f"{self.root}/_log/{dimension}")
        while True:
            version, live = log.state()
            known = self._read(dimension, list(live.values()))
            # the largest number lies in the log; loads number without gaps, so it is the number of keys
            start = sum(entry.rows or 0 for entry in live.values())
            fresh = naturals.join(known.select(*columns), list(columns), "left_anti") if live else naturals
            numbered = dense_key(fresh, F.concat_ws("|", *columns), key).withColumn(key, F.col(key) + start)
            attempt, seen = new_attempt(), Observation()
            numbered.select(key, *columns).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/{dimension}/attempt={attempt}")
            if not seen.get["rows"]:
                return known
            try:
                log.commit([Entry(attempt, f"attempt={attempt}", rows=seen.get["rows"])], expected=version)
            except Conflict:
                continue
            return self.keys(dimension)


def load_star(spark: SparkSession, silver: DataFrame, profile: DataFrame, root: str) -> str:
    """Write the five star tables. Keys come from the registry below ``root``, so later loads keep them.

    ``silver`` is read once per table: pass a stored table, not a plan that would
    repeat its de-duplication.
    """
    registry = KeyRegistry(spark, root)
    keys = {dimension: registry.register(dimension, _naturals(silver, dimension)) for dimension in KEYED}
    tables = {
        "dim_time": dim_time(silver),
        "dim_customer": keys["customer"].join(profile, "customer_id", "left").select("customer_key", "customer_id", "customer_segment", "country"),
        "dim_merchant": keys["merchant"],
        "dim_country": with_country_name(keys["country"]).select("country_key", "country", "country_name"),
    }
    for name, frame in tables.items():
        frame.write.mode("overwrite").parquet(f"{root}/{name}")
    fact = fact_transaction(silver, keys["customer"], keys["merchant"], keys["country"])
    fact.write.mode("overwrite").parquet(f"{root}/fact_transaction")
    return root
