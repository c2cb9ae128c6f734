"""Financial-event view over the test tables (see FIXTURES.md, section 2).

Defects are placed by modulo of the event number so that the same rows come out on
every engine and at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.functions.calendar import wire_timestamp


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_transactions(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))


def _pick(selector: Column, options: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (selector + 1).cast("int"))


def shape_transactions(events: DataFrame, customer: DataFrame) -> DataFrame:
    """Typed event frame from ``events`` and ``customer``; batch or streaming.

    The customer side is joined without a hint: Spark broadcasts it only while its
    measured size is under the broadcast threshold, and otherwise shuffles both sides
    (with skew splitting for hot users).
    """
    number = F.col("event_id")
    fraud = number % 71 == 7
    broken = number % 167 == 6
    value = F.col("value").cast("decimal(18,2)")
    user = F.col("user_id").cast("string")
    arrived = F.col("ts").cast("timestamp")

    countries = customer.select(
        F.col("c_custkey"),
        _pick(F.col("c_nationkey") % 10, tuple(domain.COUNTRY_NAMES)).alias("home_country"),
    )
    joined = events.join(countries, events["user_id"] == countries["c_custkey"], "left")

    amount_raw = (
        F.when(broken, F.lit("not-a-number"))
        .when(number % 251 == 2, F.concat(F.lit("-"), value.cast("string")))
        .when(fraud, (value + F.lit(2400)).cast("decimal(18,2)").cast("string"))
        .otherwise(value.cast("string"))
    )
    device = F.when(fraud, F.lit("mobile")).otherwise(_pick(number % 5, domain.DEVICES))
    shaped = joined.select(
        number.alias("seq"),
        F.concat(
            F.lit("evt-"), F.when(number % 127 == 3, number - 1).otherwise(number).cast("string")
        ).alias("event_id"),
        F.when(number % 83 != 0, F.concat(F.lit("CUS-"), user)).alias("customer_id"),
        F.when(broken, F.lit(""))
        .when(fraud, F.lit("payment"))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        amount_raw.alias("amount_raw"),
        F.when(number % 167 == 1, F.lit("XXX"))
        .otherwise(_pick(number % 4, domain.CURRENCIES))
        .alias("currency"),
        F.when(fraud, _pick(number % 3, ("RU", "NG", "XX")))
        .otherwise(F.col("home_country"))
        .alias("country"),
        device.alias("device"),
        arrived.alias("arrived_at"),
        F.when(number % 251 == 4, arrived + F.expr("INTERVAL 6 HOURS"))
        .when(number % 127 == 5, arrived - F.expr("INTERVAL 9 HOURS"))
        .otherwise(arrived)
        .alias("event_ts"),
        F.concat(F.lit("MER-"), (F.lit(100) + number % 800).cast("string")).alias("merchant_id"),
        _pick(number % 7, domain.MERCHANT_CATEGORIES).alias("merchant_category"),
        F.concat(F.lit("c"), user, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+447"), F.lpad(user, 9, "0")).alias("phone"),
        F.concat(F.lit("10.0."), user).alias("ip_address"),
        F.concat(F.lit("Customer "), user).alias("customer_name"),
        F.concat(user, F.lit(" Harbour Street")).alias("address"),
        F.when(device == "iot", F.concat(F.lit("DEV-"), (F.lit(1000) + number % 3000).cast("string")))
        .alias("device_id"),
        F.when(
            F.col("event_type") == "error",
            _pick(number % 4, ("payments-api", "ledger", "auth", "notify")),
        ).alias("service"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
        F.lit(None).cast("string").alias("message"),
        (number % 3 + 1).cast("int").alias("schema_version"),
        F.when(fraud, F.lit("0.82").cast("decimal(5,3)") + _hundredths(number))
        .when(number % 11 == 0, F.lit(None))
        .otherwise(F.lit("0.01").cast("decimal(5,3)") + _hundredths(number))
        .cast("decimal(5,3)")
        .alias("risk_score"),
    )
    return shaped.withColumns(
        {
            "amount": F.col("amount_raw").try_cast("decimal(18,2)"),
            "timestamp": wire_timestamp("event_ts"),
        }
    )


def _hundredths(number: Column) -> Column:
    return ((number % 17).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)"))


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes for the warehouse customer dimension."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("CUS-"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        _pick(F.col("c_nationkey") % 10, tuple(domain.COUNTRY_NAMES)).alias("country"),
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as clean payment events: a second dataset with years of dates."""
    orders = table(spark, sf_dir, "orders")
    placed = F.col("o_orderdate").cast("timestamp")
    return orders.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("event_id"),
        F.concat(F.lit("CUS-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.lit("payment").alias("event_type"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount_raw"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.lit("GBP").alias("currency"),
        placed.alias("event_ts"),
        placed.alias("arrived_at"),
        wire_timestamp(placed).alias("timestamp"),
    )
