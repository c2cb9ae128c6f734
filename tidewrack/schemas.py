"""Event schema versions, wire and gold schemas, with field metadata."""

from __future__ import annotations

from pyspark.sql import types as T

from tidewrack import domain

_DECLARED = {
    1: [
        ("event_id", "string", True),
        ("customer_id", "string", True),
        ("event_type", "string", True),
        ("amount", "decimal", True),
        ("currency", "string", True),
        ("country", "string", False),
        ("device", "string", False),
        ("timestamp", "timestamp", True),
    ],
    2: [("merchant_id", "string", False), ("merchant_category", "string", False)],
    3: [
        ("email", "string", False),
        ("phone", "string", False),
        ("ip_address", "string", False),
        ("customer_name", "string", False),
        ("address", "string", False),
        ("risk_score", "decimal", False),
    ],
}

_SPARK_TYPE = {
    ("amount", "decimal"): T.DecimalType(18, 2),
    ("risk_score", "decimal"): T.DecimalType(5, 3),
}


def declared_fields(version: int) -> list[tuple[str, str, bool]]:
    """(name, registry type, required) of a version; later versions only add fields."""
    if version not in _DECLARED:
        raise ValueError(f"unknown schema version {version}; known: 1, 2, 3")
    return [field for step in range(1, version + 1) for field in _DECLARED[step]]


def event_schema(version: int) -> T.StructType:
    """Typed schema of a version with ``required`` and ``pii`` field metadata."""
    return T.StructType(
        [
            T.StructField(
                name,
                T.TimestampType()
                if kind == "timestamp"
                else _SPARK_TYPE.get((name, kind), T.StringType()),
                True,
                {"required": required, "pii": name in domain.PII_COLUMNS},
            )
            for name, kind, required in declared_fields(version)
        ]
    )


def pii_fields(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if field.metadata.get("pii")]


# What a payload may carry. Amounts and risk stay text so that a wrong-typed value
# survives parsing and can be reported.
WIRE_FIELDS = (
    "event_id",
    "customer_id",
    "event_type",
    "amount",
    "currency",
    "country",
    "device",
    "timestamp",
    "merchant_id",
    "merchant_category",
    "email",
    "phone",
    "ip_address",
    "customer_name",
    "address",
    "device_id",
    "service",
    "level",
    "message",
    "schema_version",
    "risk_score",
)

WIRE_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in WIRE_FIELDS])

# From payload text, numbers read as strings would pass through a double; a variant
# keeps every digit, and also keeps a value of the wrong type.
EXACT_FIELDS = ("amount", "risk_score")
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(name, T.VariantType() if name in EXACT_FIELDS else T.StringType(), True)
        for name in WIRE_FIELDS
    ]
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.StringType(), True),
        T.StructField("arrived_at", T.TimestampType(), True),
        T.StructField("seq", T.LongType(), True),
    ]
)

ARRIVAL_ORDER = ("arrived_at", "seq")

GOLD_SCHEMAS = {
    "daily_revenue": "metric_date date, transactions bigint, volume decimal(18,2), fraud bigint",
    "customer_activity": "customer_id string, transactions bigint, volume decimal(18,2)",
    "country_performance": "country string, transactions bigint, volume decimal(18,2)",
    "fraud_summary": (
        "metric_date date, fraud_events bigint, rate decimal(9,4), avg_risk decimal(9,4)"
    ),
    "merchant_statistics": "merchant_category string, transactions bigint, volume decimal(18,2)",
    "system_performance": (
        "metric_date date, events bigint, failures bigint, failure_rate decimal(9,4)"
    ),
}
