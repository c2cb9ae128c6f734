"""Wire format: JSON payloads to typed event frames, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions.calendar import parse_timestamp
from tidewrack.schemas import EXACT_FIELDS, PAYLOAD_SCHEMA, WIRE_FIELDS, WIRE_SCHEMA
from tidewrack.functions.values import has


def parse_payloads(raw: DataFrame) -> DataFrame:
    """``payload, arrived_at, seq`` rows to typed events.

    A payload that is not JSON becomes a row without fields, which the quality rules
    then quarantine; nothing is dropped here.
    """
    kept = [c for c in raw.columns if c != "payload"]
    # generated rather than projected: filters stay above, so a payload is parsed once
    # and not once per predicate
    event = F.from_json(F.col("payload").cast("string"), PAYLOAD_SCHEMA)
    wire = raw.select(F.inline_outer(F.array(event)), *kept)
    return type_events(wire.withColumns({n: F.col(n).cast("string") for n in EXACT_FIELDS}))


def type_events(wire: DataFrame) -> DataFrame:
    """Add typed columns; the wire text of the amount stays as ``amount_raw``."""
    return (
        wire.withColumnRenamed("amount", "amount_raw")
        .withColumns(
            {
                "amount": F.col("amount_raw").try_cast("decimal(18,2)"),
                "risk_score": F.col("risk_score").try_cast("decimal(5,3)"),
                "schema_version": F.col("schema_version").try_cast("int"),
                "event_ts": parse_timestamp("timestamp"),
            }
        )
    )


def _fields_of(version: Column | None) -> dict[str, Column]:
    fields = {name: F.col("amount_raw" if name == "amount" else name) for name in WIRE_FIELDS}
    if version is not None:
        for name in ("merchant_id", "merchant_category"):
            fields[name] = F.when(version >= 2, F.col(name))
        for name in ("email", "phone", "ip_address", "customer_name", "address", "risk_score"):
            fields[name] = F.when(version >= 3, F.col(name))
    return fields


def to_payload(events: DataFrame, by_version: bool = False) -> DataFrame:
    """Typed events back to ``payload, arrived_at, seq``.

    Absent fields are left out of the JSON. A numeric amount is a JSON number, any
    other amount a JSON string. ``by_version`` also leaves out the fields that the
    row's ``schema_version`` does not have yet.
    """
    fields = _fields_of(F.col("schema_version") if by_version else None)

    def encode(amount: Column) -> Column:
        return F.to_json(
            F.struct(*[(amount if n == "amount" else c).alias(n) for n, c in fields.items()])
        )

    payload = F.when(F.col("amount").isNull(), encode(F.col("amount_raw"))).otherwise(
        encode(F.col("amount"))
    )
    return events.select(payload.alias("payload"), "arrived_at", "seq")


def read_event_json(spark: SparkSession, path: str) -> DataFrame:
    """Plain JSON-lines event files, read with the declared schema (never inferred).

    Lines that are not JSON are kept with ``_corrupt_record`` set. Arrival is the
    event's own ``ingested_at`` where present, else the file time.
    """
    wire = (
        spark.read.schema(f"{WIRE_SCHEMA.toDDL()}, ingested_at STRING, _corrupt_record STRING")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", "true")
        .json(path)
        .withColumns(
            {
                "arrived_at": F.coalesce(
                    parse_timestamp("ingested_at"), F.col("_metadata.file_modification_time")
                ),
                "seq": F.monotonically_increasing_id(),
            }
        )
        .drop("ingested_at")
    )
    return type_events(wire)


def stream_key(dataset: str) -> Column:
    """Key that spreads records over stream partitions, per kind of dataset."""
    if dataset == "iot":
        return F.coalesce(
            F.when(has("device_id"), F.col("device_id")),
            F.when(has("device"), F.col("device")),
            F.lit("unknown"),
        )
    if dataset == "logs":
        return F.when(has("service"), F.col("service")).otherwise(F.lit("app"))
    return F.when(has("customer_id"), F.col("customer_id")).otherwise(F.col("event_id"))
