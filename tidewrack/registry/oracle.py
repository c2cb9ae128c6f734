"""Standard SQL for each named query, written independently of the Spark code.

The SQL favours the plainest form (window functions, per-row flags) where the Spark
side uses aggregates, so that agreement means something.
"""

from __future__ import annotations

TXN = """
txn AS (
  SELECT e.event_id AS seq,
    'evt-' || CAST(CASE WHEN e.event_id % 127 = 3 THEN e.event_id - 1 ELSE e.event_id END AS VARCHAR) AS event_id,
    CASE WHEN e.event_id % 83 = 0 THEN NULL ELSE 'CUS-' || CAST(e.user_id AS VARCHAR) END AS customer_id,
    CASE WHEN e.event_id % 167 = 6 THEN '' WHEN e.event_id % 71 = 7 THEN 'payment' ELSE e.event_type END AS event_type,
    CASE WHEN e.event_id % 167 = 6 THEN 'not-a-number'
         WHEN e.event_id % 251 = 2 THEN '-' || CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR)
         WHEN e.event_id % 71 = 7 THEN CAST(CAST(2400 + CAST(e.value AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS VARCHAR)
         ELSE CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR) END AS amount_raw,
    CASE WHEN e.event_id % 167 = 1 THEN 'XXX' WHEN e.event_id % 4 = 0 THEN 'GBP' WHEN e.event_id % 4 = 1 THEN 'EUR'
         WHEN e.event_id % 4 = 2 THEN 'USD' ELSE 'JPY' END AS currency,
    CASE WHEN e.event_id % 71 = 7 THEN ['RU','NG','XX'][CAST(e.event_id % 3 + 1 AS INTEGER)]
         ELSE ['GB','IE','FR','DE','US','NL','ES','IT','SE','NO'][CAST(c.c_nationkey % 10 + 1 AS INTEGER)] END AS country,
    CASE WHEN e.event_id % 71 = 7 THEN 'mobile'
         ELSE ['mobile','web','pos','atm','iot'][CAST(e.event_id % 5 + 1 AS INTEGER)] END AS device,
    e.ts AS arrived_at,
    CASE WHEN e.event_id % 251 = 4 THEN e.ts + INTERVAL '6' HOUR
         WHEN e.event_id % 127 = 5 THEN e.ts - INTERVAL '9' HOUR ELSE e.ts END AS event_ts,
    'MER-' || CAST(100 + e.event_id % 800 AS VARCHAR) AS merchant_id,
    ['electronics','groceries','travel','fuel','restaurants','healthcare','entertainment'][CAST(e.event_id % 7 + 1 AS INTEGER)] AS merchant_category,
    'c' || CAST(e.user_id AS VARCHAR) || '@example.com' AS email,
    '+447' || lpad(CAST(e.user_id AS VARCHAR), 9, '0') AS phone,
    '10.0.' || CAST(e.user_id AS VARCHAR) AS ip_address,
    'Customer ' || CAST(e.user_id AS VARCHAR) AS customer_name,
    CAST(e.user_id AS VARCHAR) || ' Harbour Street' AS address,
    CASE WHEN e.event_id % 71 <> 7 AND e.event_id % 5 = 4 THEN 'DEV-' || CAST(1000 + e.event_id % 3000 AS VARCHAR) END AS device_id,
    CASE WHEN e.event_type = 'error' THEN ['payments-api','ledger','auth','notify'][CAST(e.event_id % 4 + 1 AS INTEGER)] END AS service,
    CASE WHEN e.event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    CAST(e.event_id % 3 + 1 AS INTEGER) AS schema_version,
    CASE WHEN e.event_id % 71 = 7 THEN CAST(0.82 + CAST(e.event_id % 17 AS DECIMAL(5,0)) * 0.01 AS DECIMAL(5,3))
         WHEN e.event_id % 11 = 0 THEN NULL
         ELSE CAST(0.01 + CAST(e.event_id % 17 AS DECIMAL(5,0)) * 0.01 AS DECIMAL(5,3)) END AS risk_score
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
), txn2 AS (
  SELECT *, TRY_CAST(amount_raw AS DECIMAL(18,2)) AS amount,
    strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
    CAST(greatest(date_diff('microsecond', event_ts, arrived_at), 0) AS BIGINT) AS lag_us
  FROM txn
)"""

FLAGS = TXN + """,
flags AS (
  SELECT *,
    (event_id <> '' AND event_type <> '' AND "timestamp" <> '' AND customer_id IS NOT NULL AND customer_id <> ''
      AND amount_raw IS NOT NULL AND amount_raw <> '' AND currency IS NOT NULL AND currency <> '') AS is_complete,
    NOT (currency NOT IN ('GBP','EUR','USD','JPY') OR coalesce(amount < 0, false) OR (amount_raw <> '' AND amount IS NULL)
      OR event_ts > arrived_at + INTERVAL '60' SECOND OR event_type = '') AS is_valid,
    row_number() OVER (PARTITION BY event_id ORDER BY arrived_at, seq) > 1 AS is_duplicate,
    concat_ws('; ',
      CASE WHEN event_type = '' THEN 'MISSING event_type' END,
      CASE WHEN customer_id IS NULL OR customer_id = '' THEN 'MISSING customer_id' END,
      CASE WHEN currency NOT IN ('GBP','EUR','USD','JPY') THEN 'INVALID currency' END,
      CASE WHEN amount < 0 THEN 'NEGATIVE amount' END,
      CASE WHEN amount IS NULL THEN 'INVALID amount' END,
      CASE WHEN event_ts > arrived_at + INTERVAL '60' SECOND THEN 'FUTURE timestamps' END,
      CASE WHEN event_type = '' THEN 'INVALID schema' END) AS reasons
  FROM txn2
)"""

BRONZE = FLAGS + """,
bronze AS (
  SELECT seq, event_id, customer_id, event_type, amount_raw, amount, currency, country, device, event_ts, arrived_at,
    merchant_id, merchant_category, email, phone, ip_address, customer_name, address, device_id, service, level,
    schema_version, coalesce(risk_score, 0.05)::DECIMAL(5,3) AS risk_score,
    CASE country WHEN 'GB' THEN 'United Kingdom' WHEN 'IE' THEN 'Ireland' WHEN 'FR' THEN 'France' WHEN 'DE' THEN 'Germany'
      WHEN 'US' THEN 'United States' WHEN 'NL' THEN 'Netherlands' WHEN 'ES' THEN 'Spain' WHEN 'IT' THEN 'Italy'
      WHEN 'SE' THEN 'Sweden' WHEN 'NO' THEN 'Norway'
      ELSE CASE WHEN country IS NOT NULL AND country <> '' THEN 'Unknown' END END AS country_name,
    CAST(round(amount * CAST(CASE currency WHEN 'GBP' THEN 1 WHEN 'EUR' THEN 0.85 WHEN 'USD' THEN 0.78
      WHEN 'JPY' THEN 0.0052 END AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS amount_gbp,
    CAST(event_ts AS DATE) AS event_date, CAST(extract(hour FROM event_ts) AS INTEGER) AS event_hour,
    (coalesce(risk_score, 0) >= 0.8 OR coalesce(country = 'XX', false)) AS is_fraud, lag_us,
    strftime(event_ts, '%Y') AS "year", strftime(event_ts, '%m') AS "month", strftime(event_ts, '%d') AS "day",
    strftime(event_ts, '%H') AS "hour"
  FROM flags WHERE is_complete AND is_valid
)"""

SILVER = BRONZE + """,
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrived_at, seq) AS rn FROM bronze
  ) WHERE rn = 1
)"""

GOLD = SILVER + """,
daily_revenue AS (
  SELECT event_date AS metric_date, count(*) AS transactions, CAST(sum(coalesce(amount_gbp, amount, 0)) AS DECIMAL(18,2)) AS volume,
    count(*) FILTER (WHERE is_fraud) AS fraud FROM silver GROUP BY event_date
), customer_activity AS (
  SELECT coalesce(nullif(customer_id, ''), 'unknown') AS customer_id, count(*) AS transactions,
    CAST(sum(coalesce(amount_gbp, amount, 0)) AS DECIMAL(18,2)) AS volume FROM silver GROUP BY 1
), country_performance AS (
  SELECT coalesce(nullif(country, ''), 'UN') AS country, count(*) AS transactions,
    CAST(sum(coalesce(amount_gbp, amount, 0)) AS DECIMAL(18,2)) AS volume FROM silver GROUP BY 1
), merchant_statistics AS (
  SELECT coalesce(nullif(merchant_category, ''), 'unknown') AS merchant_category, count(*) AS transactions,
    CAST(sum(coalesce(amount_gbp, amount, 0)) AS DECIMAL(18,2)) AS volume FROM silver GROUP BY 1
), fraud_summary AS (
  SELECT event_date AS metric_date, count(*) FILTER (WHERE is_fraud) AS fraud_events,
    CAST(round(CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) / count(*), 4) AS DECIMAL(9,4)) AS rate,
    CAST(round(CAST(sum(risk_score) FILTER (WHERE is_fraud) AS DOUBLE) / count(*) FILTER (WHERE is_fraud), 4) AS DECIMAL(9,4)) AS avg_risk
  FROM silver GROUP BY event_date
), system_performance AS (
  SELECT event_date AS metric_date, count(*) AS events, count(*) FILTER (WHERE level = 'ERROR') AS failures,
    CAST(round(CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*), 4) AS DECIMAL(9,4)) AS failure_rate
  FROM silver GROUP BY event_date
)"""


def _report(dataset: str, complete: str) -> str:
    return f"""
report AS (
  SELECT '{dataset}' AS dataset, count(*) AS records,
    CAST(round(100.0 * count(*) FILTER (WHERE {complete}) / count(*), 2) AS DECIMAL(9,2)) AS completeness,
    CAST(round(100.0 * count(*) FILTER (WHERE is_valid) / count(*), 2) AS DECIMAL(9,2)) AS validity,
    CAST(round(100.0 * count(*) FILTER (WHERE NOT is_duplicate) / count(*), 2) AS DECIMAL(9,2)) AS uniqueness,
    count(*) FILTER (WHERE is_duplicate) AS duplicates,
    count(*) FILTER (WHERE NOT ({complete}) OR NOT is_valid OR is_duplicate) AS quarantined,
    CAST(round((40.0 * count(*) FILTER (WHERE {complete}) + 40.0 * count(*) FILTER (WHERE is_valid)
      + 20.0 * count(*) FILTER (WHERE NOT is_duplicate)) / count(*), 1) AS DECIMAL(9,1)) AS score
  FROM flags
)"""


REPORT = FLAGS + "," + _report("transactions", "is_complete")

# JSON text of an event, absent fields left out; {0} merchants, {1} personal data and risk
_PAYLOAD = """
payload AS (
  SELECT seq, arrived_at, '{' || concat_ws(',',
    '"event_id":"' || event_id || '"', '"customer_id":"' || customer_id || '"', '"event_type":"' || event_type || '"',
    '"amount":' || CASE WHEN amount IS NULL THEN '"' || amount_raw || '"' ELSE CAST(amount AS VARCHAR) END,
    '"currency":"' || currency || '"', '"country":"' || country || '"', '"device":"' || device || '"',
    '"timestamp":"' || "timestamp" || '"', '"merchant_id":"' || merchant_id || '"',
    '"merchant_category":"' || merchant_category || '"', '"email":"' || email || '"', '"phone":"' || phone || '"',
    '"ip_address":"' || ip_address || '"', '"customer_name":"' || customer_name || '"', '"address":"' || address || '"',
    '"device_id":"' || device_id || '"', '"service":"' || service || '"', '"level":"' || level || '"',
    '"schema_version":' || CAST(schema_version AS VARCHAR), '"risk_score":' || CAST(risk_score AS VARCHAR)) || '}' AS payload
  FROM txn2
)"""


def bucket(column: str, seconds: int) -> str:
    return f"time_bucket(INTERVAL '{seconds}' SECOND, {column}, TIMESTAMP '2024-01-01')"


METRICS = FLAGS + f""",
win AS (
  SELECT {bucket('arrived_at', 300)} AS window_start, count(*) AS n,
    coalesce(sum(round(amount * CAST(CASE currency WHEN 'GBP' THEN 1 WHEN 'EUR' THEN 0.85 WHEN 'USD' THEN 0.78
      WHEN 'JPY' THEN 0.0052 END AS DECIMAL(5,4)), 2)) FILTER (WHERE is_complete AND is_valid), 0) AS revenue,
    count(*) FILTER (WHERE level = 'ERROR') AS errors, count(*) FILTER (WHERE is_duplicate) AS dups,
    count(*) FILTER (WHERE country NOT IN ('GB','IE','FR','DE','US','NL','ES','IT','SE','NO')) AS unusual,
    max(lag_us) AS lag_us
  FROM flags GROUP BY 1
), metrics AS (
  SELECT 'transactions' AS dataset, window_start, window_start + INTERVAL '5' MINUTE AS window_end, m.metric,
    CAST(CASE m.metric WHEN 'transaction_count' THEN n WHEN 'revenue' THEN revenue
      WHEN 'failure_rate' THEN round(CAST(errors AS DOUBLE) / n, 4) WHEN 'duplicate_rate' THEN round(CAST(dups AS DOUBLE) / n, 4)
      WHEN 'unusual_country' THEN unusual ELSE round(lag_us / 1000000.0, 4) END AS DECIMAL(18,4)) AS "current"
  FROM win CROSS JOIN (VALUES ('transaction_count'), ('revenue'), ('failure_rate'), ('duplicate_rate'),
    ('unusual_country'), ('pipeline_latency_sec')) m(metric)
), baselines AS (
  SELECT *, CAST(CASE WHEN metric = 'transaction_count' THEN greatest(b, 1) ELSE b END AS DECIMAL(18,4)) AS baseline
  FROM (SELECT *, first_value("current") OVER (PARTITION BY metric ORDER BY window_start
    RANGE BETWEEN INTERVAL 10 MINUTES PRECEDING AND CURRENT ROW) AS b FROM metrics)
), alerts AS (
  SELECT * FROM (
    SELECT dataset, window_start, window_end, metric, "current", baseline,
      CASE WHEN metric = 'failure_rate' AND "current" > 0.1 THEN 'HIGH'
           WHEN metric = 'transaction_count' AND "current" / baseline >= 5 THEN 'HIGH'
           WHEN metric = 'revenue' AND baseline > 0 AND "current" / baseline <= 0.2 THEN 'CRITICAL'
           WHEN metric = 'duplicate_rate' AND "current" > 0.05 THEN 'MEDIUM'
           WHEN metric = 'pipeline_latency_sec' AND "current" > 60 THEN 'HIGH'
           WHEN metric = 'unusual_country' AND "current" > 0 THEN 'MEDIUM' END AS severity,
      CASE metric WHEN 'failure_rate' THEN 'Failure rate exceeds 10%' WHEN 'transaction_count' THEN 'Transaction count suddenly +400%'
           WHEN 'revenue' THEN 'Revenue drops 80%' WHEN 'duplicate_rate' THEN 'Duplicate-event rate spikes'
           WHEN 'pipeline_latency_sec' THEN 'Pipeline latency exceeds 60 seconds' ELSE 'Unusual country appears' END AS reason
    FROM baselines WHERE NOT (baseline <= 0 AND "current" <= 0)
  ) WHERE severity IS NOT NULL
)"""

# fields each version carries: (name, first version, value when present)
_FIELDS = [
    ("event_id", 1), ("customer_id", 1), ("event_type", 1), ("currency", 1), ("country", 1), ("device", 1),
    ("timestamp", 1), ("merchant_id", 2), ("merchant_category", 2), ("email", 3), ("phone", 3), ("ip_address", 3),
    ("customer_name", 3), ("address", 3), ("device_id", 1), ("service", 1), ("level", 1),
]
_SEEN = [f"{{'field': '{n}', 'type': CASE WHEN schema_version >= {v} AND \"{n}\" IS NOT NULL THEN 'string' END}}" for n, v in _FIELDS]
_SEEN += [
    "{'field': 'amount', 'type': CASE WHEN amount IS NULL THEN 'string' ELSE 'number' END}",
    "{'field': 'schema_version', 'type': 'number'}",
    "{'field': 'risk_score', 'type': CASE WHEN schema_version >= 3 AND risk_score IS NOT NULL THEN 'number' END}",
]
PROFILE = TXN + ",\nseen AS (SELECT schema_version, unnest([" + ",\n ".join(_SEEN) + """]) AS f FROM txn2
), profile AS MATERIALIZED (
  SELECT schema_version, f.field AS field, f.type AS type, count(*) AS records FROM seen WHERE f.type IS NOT NULL GROUP BY ALL
),
dominant AS (
  SELECT schema_version AS v, field, type, field IN ('event_id','customer_id','event_type','amount','currency','timestamp') AS required
  FROM (SELECT *, row_number() OVER (PARTITION BY schema_version, field ORDER BY records DESC, type DESC) AS rn FROM profile) WHERE rn = 1
), steps(versions, a, b) AS (VALUES ('v1-v2', 1, 2), ('v2-v3', 2, 3), ('v3-v1', 3, 1), ('v2-v2', 2, 2)),
diffs AS (
  SELECT s.versions, r.field, 'added' AS change, CAST(NULL AS VARCHAR) AS left_type, r.type AS right_type, r.required
  FROM steps s JOIN dominant r ON r.v = s.b WHERE NOT EXISTS (SELECT 1 FROM dominant l WHERE l.v = s.a AND l.field = r.field)
  UNION ALL
  SELECT s.versions, l.field, 'removed', l.type, NULL, l.required
  FROM steps s JOIN dominant l ON l.v = s.a WHERE NOT EXISTS (SELECT 1 FROM dominant r WHERE r.v = s.b AND l.field = r.field)
  UNION ALL
  SELECT s.versions, l.field, 'changed', l.type, r.type, r.required
  FROM steps s JOIN dominant l ON l.v = s.a JOIN dominant r ON r.v = s.b AND r.field = l.field WHERE r.type <> l.type
)"""

STAR = SILVER + """,
dim_customer AS (
  SELECT row_number() OVER (ORDER BY substr(sha256(s.customer_id), 1, 3), s.customer_id) AS customer_key, s.customer_id,
    c.c_mktsegment AS customer_segment,
    ['GB','IE','FR','DE','US','NL','ES','IT','SE','NO'][CAST(c.c_nationkey % 10 + 1 AS INTEGER)] AS country
  FROM (SELECT DISTINCT customer_id FROM silver) s LEFT JOIN customer c ON s.customer_id = 'CUS-' || CAST(c.c_custkey AS VARCHAR)
), dim_merchant AS (
  SELECT row_number() OVER (ORDER BY substr(sha256(merchant_id || '|' || merchant_category), 1, 3), merchant_id || '|' || merchant_category) AS merchant_key,
    merchant_id, merchant_category FROM (SELECT DISTINCT merchant_id, merchant_category FROM silver)
), dim_country AS (
  SELECT row_number() OVER (ORDER BY substr(sha256(country), 1, 3), country) AS country_key, country, country_name
  FROM (SELECT DISTINCT country, country_name FROM silver WHERE country IS NOT NULL)
), dim_time AS (
  SELECT DISTINCT CAST(strftime(event_ts, '%Y%m%d%H') AS INTEGER) AS time_key, CAST(event_ts AS DATE) AS "date",
    CAST(extract(hour FROM event_ts) AS INTEGER) AS "hour", dayname(event_ts) AS weekday,
    CAST(extract(month FROM event_ts) AS INTEGER) AS "month", CAST(extract(year FROM event_ts) AS INTEGER) AS "year" FROM silver
), fact AS (
  SELECT s.event_id AS transaction_id, dc.customer_key, dm.merchant_key,
    CAST(strftime(s.event_ts, '%Y%m%d%H') AS INTEGER) AS time_key, dn.country_key, s.amount, s.risk_score
  FROM silver s LEFT JOIN dim_customer dc USING (customer_id)
    LEFT JOIN dim_merchant dm ON dm.merchant_id = s.merchant_id AND dm.merchant_category = s.merchant_category
    LEFT JOIN dim_country dn ON dn.country = s.country
)"""

_MASK_EMAIL = "substr(email, 1, 1) || '******@' || split_part(email, '@', 2)"
_BRONZE_COLUMNS = """seq, event_id, customer_id, event_type, amount_raw, amount, currency, country, device, event_ts, arrived_at,
  merchant_id, merchant_category, email, phone, ip_address, customer_name, address, device_id, service, level, schema_version,
  risk_score, country_name, amount_gbp, event_date, event_hour, is_fraud"""
_SILVER_COLUMNS = _BRONZE_COLUMNS.replace("email, phone, ip_address, customer_name, address, ", "")


def _with(prefix: str, select: str) -> str:
    return f"WITH {prefix.strip()}\n{select}"


_FIRST_HALF = "f.arrived_at < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)"


def _counts(records: str, which: str) -> str:
    """Rows and numbers per layer, of a lake that holds the events for which ``which`` is true."""
    return _with(SILVER, f"""SELECT 'raw' AS layer, {records} AS records, count(*) AS numbers FROM flags f WHERE {which}
        UNION ALL SELECT 'bronze', {records}, count(*) FROM flags f WHERE {which} AND is_complete AND is_valid
        UNION ALL SELECT 'quarantine', {records}, count(*) FROM flags f WHERE {which} AND NOT (is_complete AND is_valid)
        UNION ALL SELECT 'silver', count(*), count(*) FROM silver f WHERE {which}""")


ORACLE: dict[str, str] = {
    "txn_fixture": _with(TXN, """SELECT * EXCLUDE (lag_us), strftime(arrived_at, '%Y') AS "year",
        strftime(arrived_at, '%m') AS "month", strftime(arrived_at, '%d') AS "day", strftime(arrived_at, '%H') AS "hour" FROM txn2"""),
    "raw_parse_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "raw_scan_json": _with(TXN, """SELECT event_id, customer_id, event_type, amount_raw, amount, currency, country, event_ts,
        merchant_id, email, level, schema_version, risk_score, false AS corrupt FROM txn2"""),
    "raw_landing": _with(TXN, "SELECT seq, arrived_at, event_id, amount, event_ts, risk_score, amount IS NULL AS wrong_type FROM txn2"),
    "bronze_roundtrip": _with(BRONZE, f'SELECT {_BRONZE_COLUMNS}, "year", "month", "day" FROM bronze'),
    "quarantine_roundtrip": _with(FLAGS, "SELECT seq, event_id, amount_raw, reasons FROM flags WHERE NOT (is_complete AND is_valid)"),
    "silver_overwrite": _with(SILVER, f"""SELECT event_id, amount_gbp, {_MASK_EMAIL} AS email, strftime(arrived_at, '%Y') AS "year",
        strftime(arrived_at, '%m') AS "month", strftime(arrived_at, '%d') AS "day" FROM silver"""),
    "gold_scan": _with(GOLD, "SELECT * FROM customer_activity"),
    "quality_report_roundtrip": _with(REPORT, "SELECT * FROM report"),
    "partition_counts": _with(BRONZE, 'SELECT "year", "month", "day", "hour", count(*) AS records FROM bronze GROUP BY ALL'),
    "partition_pruned": _with(BRONZE, """SELECT "day", "hour", count(*) AS records, CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS volume
        FROM bronze WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' AND event_hour BETWEEN 6 AND 11 GROUP BY ALL"""),
    "hours_by_zones": _with(SILVER, """SELECT strftime(arrived_at, '%d') AS "day", strftime(arrived_at, '%H') AS "hour", count(*) AS records,
          CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS volume
        FROM silver WHERE arrived_at >= TIMESTAMP '2024-01-10 06:00:00' AND arrived_at < TIMESTAMP '2024-01-19 17:00:00' GROUP BY ALL"""),
    "compacted_bronze": _with(BRONZE, """SELECT event_date, count(*) AS records, CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS volume
        FROM bronze GROUP BY ALL"""),
    "dataset_inventory": _with(GOLD, """
        SELECT 'raw' AS layer, 'transactions' AS dataset, count(*) AS records FROM txn2
        UNION ALL SELECT 'bronze', 'transactions', count(*) FROM bronze
        UNION ALL SELECT 'silver', 'transactions', count(*) FROM silver
        UNION ALL SELECT 'quarantine', 'transactions', count(*) FROM flags WHERE NOT (is_complete AND is_valid)
        UNION ALL SELECT 'gold', 'daily_revenue', count(*) FROM daily_revenue
        UNION ALL SELECT 'gold', 'customer_activity', count(*) FROM customer_activity
        UNION ALL SELECT 'gold', 'country_performance', count(*) FROM country_performance
        UNION ALL SELECT 'gold', 'fraud_summary', count(*) FROM fraud_summary
        UNION ALL SELECT 'gold', 'merchant_statistics', count(*) FROM merchant_statistics
        UNION ALL SELECT 'gold', 'system_performance', count(*) FROM system_performance"""),
    "layer_reconciliation": _with(SILVER, """
        SELECT CAST(f.arrived_at AS DATE) AS arrival_date, count(*) AS raw, count(*) FILTER (WHERE is_complete AND is_valid) AS bronze,
          count(*) FILTER (WHERE NOT (is_complete AND is_valid)) AS quarantine, count(s.seq) AS silver, CAST(0 AS BIGINT) AS difference
        FROM flags f LEFT JOIN silver s ON s.seq = f.seq GROUP BY 1"""),
    "key_distribution": _with(TXN, """SELECT coalesce(customer_id, event_id) AS stream_key, count(*) AS records FROM txn2
        GROUP BY 1 ORDER BY records DESC, stream_key LIMIT 20"""),
    "key_distribution_iot": _with(TXN, """SELECT coalesce(device_id, device, 'unknown') AS stream_key, count(*) AS records FROM txn2
        GROUP BY 1 ORDER BY records DESC, stream_key LIMIT 20"""),
    "key_distribution_logs": _with(TXN, """SELECT coalesce(service, 'app') AS stream_key, count(*) AS records FROM txn2
        GROUP BY 1 ORDER BY records DESC, stream_key LIMIT 20"""),
    "quality_flags": _with(FLAGS, "SELECT seq, event_id, is_complete, is_valid, is_duplicate, reasons FROM flags"),
    "quarantine_rows": _with(FLAGS, """SELECT seq, event_id, customer_id, amount_raw, currency, event_ts, reasons
        FROM flags WHERE NOT (is_complete AND is_valid)"""),
    "bronze_rows": _with(BRONZE, f"SELECT {_BRONZE_COLUMNS} FROM bronze"),
    "bronze_rows_logs": _with(FLAGS, "SELECT level, count(*) AS records FROM flags WHERE event_type <> '' AND is_valid GROUP BY level"),
    "stream_filter_rows": _with(TXN, """SELECT seq, event_id, amount, currency FROM txn2 WHERE customer_id IS NOT NULL AND amount >= 0
        AND currency IN ('GBP','EUR','USD','JPY')"""),
    "invalid_antijoin": _with(TXN, """SELECT seq, event_id, 'schema_or_quality' AS quarantine_reason FROM txn2 WHERE event_id NOT IN
        (SELECT event_id FROM txn2 WHERE customer_id IS NOT NULL AND amount >= 0 AND currency IN ('GBP','EUR','USD','JPY'))"""),
    "quality_report": _with(REPORT, "SELECT * FROM report"),
    "quality_report_logs": _with(FLAGS + "," + _report("logs", "event_type <> ''"), "SELECT * FROM report"),
    "quality_issues": _with(FLAGS, """SELECT code, field, count(*) AS count FROM (
        SELECT unnest(string_split(reasons, '; ')) AS code FROM flags WHERE reasons <> ''
        UNION ALL SELECT 'DUPLICATE event_id' FROM flags WHERE is_duplicate) i
        JOIN (VALUES ('MISSING event_type','event_type'), ('MISSING customer_id','customer_id'), ('INVALID currency','currency'),
          ('NEGATIVE amount','amount'), ('INVALID amount','amount'), ('FUTURE timestamps','timestamp'), ('INVALID schema','event_type'),
          ('DUPLICATE event_id','event_id')) f(code, field) USING (code) GROUP BY code, field"""),
    "quality_scan": _with(TXN, """, dup AS (SELECT count(*) AS d FROM (SELECT event_id FROM txn2 GROUP BY event_id HAVING count(*) > 1)),
        c AS (SELECT count(*) AS n, count(*) FILTER (WHERE customer_id IS NULL OR customer_id = '') AS m,
          count(*) FILTER (WHERE currency NOT IN ('GBP','EUR','USD','JPY')) AS b, count(*) FILTER (WHERE amount < 0) AS neg FROM txn2)
        SELECT 'transactions' AS dataset, n AS records, m AS missing_customer_id, b AS invalid_currency, neg AS negative_amount,
          d AS duplicate_event_id, CAST(round(100 - 40.0 * m / n - 30.0 * b / n - 20.0 * neg / n - 10.0 * d / n, 1) AS DECIMAL(9,1)) AS quality_score
        FROM c, dup"""),
    "quality_scan_rows": _with(TXN, """SELECT seq, event_id, currency, amount FROM txn2 WHERE customer_id IS NULL
        OR currency NOT IN ('GBP','EUR','USD','JPY') OR amount < 0"""),
    "duplicate_ids": _with(TXN, "SELECT event_id, count(*) AS copies FROM txn2 GROUP BY event_id HAVING count(*) > 1"),
    "batch_gate": _with(REPORT, """SELECT dataset, records, score, CASE WHEN score >= 95 THEN 'PUBLISH' ELSE 'QUARANTINE' END AS decision,
        score < 97 AS warning FROM report"""),
    "gated_publish": _with(GOLD, """
        SELECT 'silver' AS layer, 'transactions' AS dataset, count(*) AS records FROM silver
        UNION ALL SELECT 'quarantine', 'transactions', count(*) FROM flags WHERE NOT (is_complete AND is_valid)
        UNION ALL SELECT 'gold', 'daily_revenue', count(*) FROM daily_revenue
        UNION ALL SELECT 'gold', 'customer_activity', count(*) FROM customer_activity
        UNION ALL SELECT 'gold', 'country_performance', count(*) FROM country_performance
        UNION ALL SELECT 'gold', 'fraud_summary', count(*) FROM fraud_summary
        UNION ALL SELECT 'gold', 'merchant_statistics', count(*) FROM merchant_statistics
        UNION ALL SELECT 'gold', 'system_performance', count(*) FROM system_performance"""),
    "silver_rows": _with(SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "silver_pii_masked": _with(SILVER, f"""SELECT event_id, {_MASK_EMAIL} AS email, substr(sha256(phone), 1, 16) AS phone,
        substr(sha256(ip_address), 1, 16) AS ip_address, 'tok_' || substr(sha256(customer_name), 1, 12) AS customer_name,
        'tok_' || substr(sha256(address), 1, 12) AS address FROM silver"""),
    "pii_restricted": _with(SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "pii_administrator": _with(SILVER, "SELECT event_id, email, phone, ip_address, customer_name, address FROM silver"),
    "pii_audit": _with(SILVER, """SELECT c.column_name, (SELECT count(*) FROM silver) AS values_checked, CAST(0 AS BIGINT) AS clear_values
        FROM (VALUES ('email'), ('phone'), ('ip_address'), ('address'), ('customer_name')) c(column_name)"""),
    "pii_audit_bronze": _with(BRONZE, """SELECT c.column_name, (SELECT count(*) FROM bronze) AS values_checked,
        (SELECT count(*) FROM bronze) AS clear_values
        FROM (VALUES ('email'), ('phone'), ('ip_address'), ('address'), ('customer_name')) c(column_name)"""),
    "lineitem_keep_first": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
        FROM lineitem) WHERE rn = 1""",
    "gold_daily_revenue": _with(GOLD, "SELECT * FROM daily_revenue"),
    "gold_customer_activity": _with(GOLD, "SELECT * FROM customer_activity"),
    "gold_country_performance": _with(GOLD, "SELECT * FROM country_performance"),
    "gold_fraud_summary": _with(GOLD, "SELECT * FROM fraud_summary"),
    "gold_merchant_statistics": _with(GOLD, "SELECT * FROM merchant_statistics"),
    "gold_system_performance": _with(GOLD, "SELECT * FROM system_performance"),
    "gold_orders_daily_revenue": """SELECT CAST(o_orderdate AS DATE) AS metric_date, count(*) AS transactions,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS volume, CAST(0 AS BIGINT) AS fraud FROM orders GROUP BY 1""",
    "fraud_events": _with(SILVER, "SELECT event_id, country, amount_gbp, risk_score FROM silver WHERE is_fraud"),
    "active_customers": _with(SILVER, """SELECT event_date AS metric_date, count(DISTINCT customer_id) AS active_customers
        FROM silver GROUP BY event_date"""),
    "kpi_summary": _with(SILVER, """SELECT count(*) AS transactions, CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS total_volume,
        CAST(round(CAST(sum(amount_gbp) AS DOUBLE) / count(*), 2) AS DECIMAL(18,2)) AS average_transaction,
        CAST(round(CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*), 4) AS DECIMAL(9,4)) AS failure_rate,
        count(*) FILTER (WHERE is_fraud) AS fraud_alerts,
        CAST(floor(date_diff('microsecond', max(event_ts), max(arrived_at)) / 1000000.0) AS BIGINT) AS freshness_seconds FROM silver"""),
    "revenue_trend": _with(GOLD, """SELECT metric_date, volume, lag(volume) OVER (ORDER BY metric_date) AS previous_volume,
        CAST(volume - lag(volume) OVER (ORDER BY metric_date) AS DECIMAL(18,2)) AS change FROM daily_revenue"""),
    "top_countries": _with(GOLD, "SELECT country, transactions, volume FROM country_performance ORDER BY volume DESC, country LIMIT 5"),
    "top_merchants": _with(GOLD, "SELECT * FROM merchant_statistics ORDER BY volume DESC, merchant_category LIMIT 5"),
    "country_volume": _with(GOLD, "SELECT country, count(*) AS transactions, sum(volume) AS volume FROM country_performance GROUP BY country"),
    "country_volume_total": _with(GOLD, """SELECT country, CAST(sum(transactions) AS BIGINT) AS transactions, sum(volume) AS volume
        FROM country_performance GROUP BY country"""),
    "fraud_window": _with(GOLD, "SELECT metric_date, fraud_events, avg_risk FROM fraud_summary WHERE fraud_events > 0"),
    "readme_query": _with(GOLD, "SELECT country, sum(volume) AS volume FROM country_performance GROUP BY country"),
    "select_star": _with(GOLD, "SELECT * FROM merchant_statistics"),
    "select_alias": _with(GOLD, "SELECT metric_date AS day, volume AS revenue FROM daily_revenue"),
    "where_filter": _with(SILVER, "SELECT event_id, amount_gbp FROM silver WHERE currency = 'EUR' AND amount_gbp > 40.5"),
    "where_not_equal": _with(GOLD, "SELECT country, volume FROM country_performance WHERE country <> 'GB'"),
    "group_multi_key": _with(SILVER, """SELECT country, currency, count(*) AS n, sum(amount_gbp) AS total,
        CAST(round(CAST(sum(amount_gbp) AS DOUBLE) / count(amount_gbp), 2) AS DECIMAL(18,2)) AS mean FROM silver GROUP BY country, currency"""),
    "group_count_col": _with(SILVER, """SELECT device, count(*) AS n, count(device_id) AS with_device_id, count(service) AS with_service
        FROM silver GROUP BY device"""),
    "order_nulls_last_limit": _with(GOLD, """SELECT metric_date, avg_risk FROM fraud_summary
        ORDER BY avg_risk DESC NULLS LAST, metric_date LIMIT 7"""),
    "late_events": _with(TXN, """SELECT seq, event_id, event_ts, arrived_at, CAST(floor(lag_us / 1000000.0) AS BIGINT) AS lag_seconds
        FROM txn2 WHERE event_ts < arrived_at - INTERVAL '2' HOUR"""),
    "lateness_histogram": _with(TXN, """SELECT CAST(floor(lag_us / 3600000000.0) AS BIGINT) AS hours_late, count(*) AS events
        FROM txn2 GROUP BY 1"""),
    "retention_live": """SELECT CAST(ts AS DATE) AS day, count(*) AS records FROM events
        WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 14 FROM events) GROUP BY 1""",
    "retention_expired": """SELECT CAST(ts AS DATE) AS day, count(*) AS records FROM events
        WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) - 14 FROM events) GROUP BY 1""",
    "persona_finance": _with(GOLD, "SELECT country, transactions, volume FROM country_performance"),
    "persona_analyst": _with(SILVER, f"""SELECT event_id, country_name, {_MASK_EMAIL} AS email, substr(sha256(phone), 1, 16) AS phone,
        amount_gbp FROM silver"""),
    "persona_security": _with(GOLD, "SELECT * FROM fraud_summary"),
    "persona_security_quarantine": _with(FLAGS, "SELECT event_id, seq, reasons FROM flags WHERE NOT (is_complete AND is_valid)"),
    "persona_auditor": _with(GOLD, "SELECT * FROM system_performance"),
    "anomaly_metrics": _with(METRICS, "SELECT * FROM metrics"),
    "anomaly_baseline": _with(METRICS, 'SELECT dataset, window_start, window_end, metric, "current", baseline FROM baselines'),
    "anomaly_alerts": _with(METRICS, "SELECT * FROM alerts"),
    "alert_text": _with(METRICS, """SELECT dataset, metric,
        CASE WHEN metric IN ('failure_rate','duplicate_rate') THEN CAST(CAST(round("current" * 100, 1) AS DECIMAL(18,1)) AS VARCHAR) || '%'
          WHEN metric = 'revenue' THEN '£' || format('{:,}', CAST(round("current", 0) AS BIGINT))
          WHEN metric = 'pipeline_latency_sec' THEN CAST(CAST(round("current", 1) AS DECIMAL(18,1)) AS VARCHAR) || 's'
          ELSE CAST(CAST(round("current", 0) AS BIGINT) AS VARCHAR) END AS "current",
        CASE metric WHEN 'failure_rate' THEN '2–5%' WHEN 'duplicate_rate' THEN '<1%' WHEN 'pipeline_latency_sec' THEN '<5s'
          WHEN 'unusual_country' THEN '0' WHEN 'revenue' THEN '£' || format('{:,}', CAST(round(baseline, 0) AS BIGINT))
          ELSE CAST(CAST(round(baseline, 0) AS BIGINT) AS VARCHAR) END AS normal,
        severity, strftime(window_start, '%H:%M') || '–' || strftime(window_end, '%H:%M') AS "window", reason FROM alerts"""),
    "lag_per_minute": _with(TXN, f"""SELECT {bucket('arrived_at', 60)} AS "minute", CAST(floor(max(lag_us) / 1000.0) AS BIGINT) AS max_lag_ms
        FROM txn2 GROUP BY 1"""),
    "alarm_m_of_n": _with(TXN, f""", points AS (SELECT {bucket('arrived_at', 60)} AS m, max(lag_us) / 1000.0 > 60000 AS breach FROM txn2 GROUP BY 1),
        spine AS (SELECT unnest(generate_series((SELECT min(m) FROM points), (SELECT max(m) FROM points), INTERVAL '1' MINUTE)) AS m),
        state AS (SELECT spine.m AS "minute", CAST(sum(CASE WHEN breach THEN 1 ELSE 0 END) OVER (ORDER BY spine.m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT)
          AS breaching_points FROM spine LEFT JOIN points USING (m))
        SELECT "minute", breaching_points, breaching_points >= 2 AS in_alarm FROM state WHERE breaching_points > 0"""),
    "throughput_per_minute": _with(TXN + "," + _PAYLOAD, f"""SELECT {bucket('arrived_at', 60)} AS "minute", count(*) AS records,
        CAST(sum(strlen(payload)) AS BIGINT) AS bytes, CAST(round(count(*) / 60.0, 4) AS DECIMAL(9,4)) AS records_per_sec,
        CAST(round(sum(strlen(payload)) / 60.0, 2) AS DECIMAL(18,2)) AS bytes_per_sec FROM payload GROUP BY 1"""),
    "sliding_lookback": _with(TXN, f"""SELECT w AS window_start, w + INTERVAL '15' MINUTE AS window_end, count(*) AS events,
        max(lag_us) AS max_lag_micros FROM (SELECT lag_us, {bucket('arrived_at', 300)} - INTERVAL 1 MINUTE * (5 * k.i) AS w
          FROM txn2 CROSS JOIN (VALUES (0), (1), (2)) k(i)) GROUP BY 1"""),
    "observability_snapshot": _with(REPORT, """, a AS (SELECT max(arrived_at) AS t FROM txn2)
        SELECT (SELECT count(*) FROM txn2, a WHERE CAST(arrived_at AS DATE) = CAST(t AS DATE)) AS events_today,
          (SELECT CAST(round(count(*) / 60.0, 4) AS DECIMAL(9,4)) FROM txn2, a WHERE arrived_at > t - INTERVAL '60' SECOND) AS current_rate,
          (SELECT CAST(floor(max(lag_us) / 1000000.0) AS BIGINT) FROM txn2, a WHERE arrived_at > t - INTERVAL '5' MINUTE) AS pipeline_latency_sec,
          score AS data_quality, quarantined FROM report"""),
    "pipeline_health": _with(REPORT, """SELECT 'quality' AS name, CAST(score AS DECIMAL(18,4)) AS value,
          CASE WHEN score >= 97 THEN 'HEALTHY' WHEN score >= 95 THEN 'DEGRADED' ELSE 'FAILED' END AS status FROM report
        UNION ALL SELECT 'failures', CAST(f AS DECIMAL(18,4)), CASE WHEN f <= 0.05 THEN 'HEALTHY' WHEN f <= 0.1 THEN 'DEGRADED' ELSE 'FAILED' END
          FROM (SELECT round(CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*), 4) AS f FROM txn2)
        UNION ALL SELECT 'lag', CAST(floor(l / 1000000.0) AS DECIMAL(18,4)), CASE WHEN l < 5000000 THEN 'HEALTHY' WHEN l <= 60000000 THEN 'DEGRADED' ELSE 'FAILED' END
          FROM (SELECT max(lag_us) AS l FROM txn2)"""),
    "backfill_plan": """SELECT CAST(unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events),
        (SELECT date_trunc('day', max(ts)) FROM events), INTERVAL '1' DAY)) AS DATE) AS day""",
    "backfill_pending": _with(SILVER, """SELECT day FROM (SELECT CAST(unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events),
          (SELECT date_trunc('day', max(ts)) FROM events), INTERVAL '1' DAY)) AS DATE) AS day)
        WHERE day > (SELECT CAST(min(ts) AS DATE) + (date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) // 2)::INT FROM events)"""),
    "backfill_antijoin": _with(BRONZE, """, middle AS (SELECT CAST(min(ts) AS DATE) + (date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) // 2)::INT AS m FROM events)
        SELECT seq, event_id, amount_gbp FROM bronze, middle WHERE CAST(arrived_at AS DATE) >= m
        AND event_id NOT IN (SELECT event_id FROM bronze, middle WHERE CAST(arrived_at AS DATE) <= m)"""),
    "backfill_run": _with(SILVER, """, days AS (SELECT CAST(unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events),
          (SELECT date_trunc('day', max(ts)) FROM events), INTERVAL '1' DAY)) AS DATE) AS day)
        SELECT 'transactions' AS dataset, days.day AS day, count(s.seq) AS records, count(b.seq) - count(s.seq) AS skipped
        FROM days LEFT JOIN bronze b ON CAST(b.arrived_at AS DATE) = days.day LEFT JOIN silver s ON s.seq = b.seq GROUP BY days.day"""),
    "schema_field_profile": _with(PROFILE, "SELECT * FROM profile"),
    "schema_diff": _with(PROFILE, "SELECT * FROM diffs WHERE versions <> 'v2-v2'"),
    "schema_compatibility": _with(PROFILE, """SELECT versions, added, removed, changed,
        CASE WHEN changed > 0 OR req > 0 THEN 'BREAKING' WHEN added + removed = 0 THEN 'FULLY COMPATIBLE'
          WHEN removed = 0 THEN 'BACKWARD COMPATIBLE' ELSE 'FORWARD COMPATIBLE' END AS compatibility
        FROM (SELECT s.versions, count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'removed') AS removed,
          count(*) FILTER (WHERE change = 'changed') AS changed, count(*) FILTER (WHERE required AND change <> 'changed') AS req
          FROM steps s LEFT JOIN diffs USING (versions) GROUP BY s.versions)"""),
    "schema_fields_added": _with(PROFILE, "SELECT field FROM dominant WHERE v = 3 EXCEPT SELECT field FROM dominant WHERE v = 1"),
    "schema_union_versions": _with(TXN, """SELECT seq, event_id, schema_version, amount_raw,
        CASE WHEN schema_version >= 2 THEN merchant_id END AS merchant_id, CASE WHEN schema_version >= 2 THEN merchant_category END AS merchant_category,
        CASE WHEN schema_version >= 3 THEN email END AS email, CASE WHEN schema_version >= 3 THEN risk_score END AS risk_score FROM txn2"""),
    "schema_merge_files": _with(TXN, """SELECT seq, event_id, CASE WHEN schema_version >= 2 THEN merchant_id END AS merchant_id,
        CASE WHEN schema_version >= 3 THEN email END AS email, CAST(schema_version AS VARCHAR) AS version FROM txn2"""),
    "record_lineage": _with(SILVER, """SELECT CAST(f.arrived_at AS DATE) AS arrival_date, is_complete AND is_valid AS in_bronze,
        s.seq IS NOT NULL AS in_silver, NOT (is_complete AND is_valid) AS in_quarantine, reasons, count(*) AS records
        FROM flags f LEFT JOIN silver s ON s.seq = f.seq GROUP BY ALL"""),
    "gold_drill_through": _with(GOLD, """SELECT event_id, country, CAST(coalesce(amount_gbp, amount, 0) AS DECIMAL(18,2)) AS amount
        FROM silver WHERE country = (SELECT country FROM country_performance ORDER BY volume DESC, country LIMIT 1)"""),
    "gold_reconcile": _with(GOLD, """SELECT merchant_category, transactions AS silver_rows, transactions, volume AS silver_volume, volume,
        CAST(0 AS DECIMAL(18,2)) AS difference FROM merchant_statistics"""),
    "dim_time": _with(STAR, "SELECT * FROM dim_time"),
    "dim_customer": _with(STAR, "SELECT * FROM dim_customer"),
    "dim_merchant": _with(STAR, "SELECT * FROM dim_merchant"),
    "dim_country": _with(STAR, "SELECT * FROM dim_country"),
    "fact_transaction": _with(STAR, "SELECT * FROM fact"),
    "fact_orphans": """SELECT foreign_key, CAST(0 AS BIGINT) AS orphans
        FROM (VALUES ('customer_key'), ('merchant_key'), ('time_key'), ('country_key')) f(foreign_key)""",
    "warehouse_load": _with(STAR, """SELECT customer_segment, weekday, count(*) AS transactions, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
        FROM fact JOIN dim_customer USING (customer_key) JOIN dim_time USING (time_key) GROUP BY ALL"""),
    "medallion_job": _with(GOLD, """SELECT CAST(event_ts AS DATE) AS metric_date, count(*) AS transactions,
        CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS volume, count(*) FILTER (WHERE is_fraud) AS fraud FROM silver GROUP BY 1"""),
    "bronze_to_silver_job": _with(SILVER, f"""SELECT event_id, seq, {_MASK_EMAIL} AS email, country_name, amount_gbp, is_fraud FROM silver"""),
    "stream_landing": _with(TXN, "SELECT seq, arrived_at, event_id, amount, event_ts FROM txn2"),
    "stream_bronze": _with(BRONZE, """SELECT seq, event_id, amount_gbp, country_name, event_ts, is_fraud, "year", "month", "day" FROM bronze"""),
    "stream_quarantine": _with(FLAGS, """SELECT seq, event_id, reasons, 'schema_or_quality' AS quarantine_reason FROM flags
        WHERE NOT (is_complete AND is_valid)"""),
    "stream_dedup": _with(SILVER, "SELECT event_id FROM silver"),
    "stream_silver": _with(SILVER, f"""SELECT event_id, seq, amount_gbp, {_MASK_EMAIL} AS email, "year", "month", "day" FROM silver"""),
    "stream_window_metrics": _with(FLAGS, f"""SELECT window_start, window_start + INTERVAL '5' MINUTE AS window_end, events, identified, revenue, errors,
        unusual, max_lag_micros FROM (SELECT {bucket('arrived_at', 300)} AS window_start, count(*) AS events, count(*) AS identified,
          CAST(coalesce(sum(round(amount * CAST(CASE currency WHEN 'GBP' THEN 1 WHEN 'EUR' THEN 0.85 WHEN 'USD' THEN 0.78
            WHEN 'JPY' THEN 0.0052 END AS DECIMAL(5,4)), 2)) FILTER (WHERE is_complete AND is_valid), 0) AS DECIMAL(18,2)) AS revenue,
          count(*) FILTER (WHERE level = 'ERROR') AS errors,
          count(*) FILTER (WHERE country NOT IN ('GB','IE','FR','DE','US','NL','ES','IT','SE','NO')) AS unusual,
          max(lag_us) AS max_lag_micros FROM flags GROUP BY 1)"""),
    "stream_alerts": _with(METRICS, "SELECT * FROM alerts WHERE metric <> 'duplicate_rate'"),
    "stream_gold": _with(GOLD, "SELECT * FROM daily_revenue"),
    "stream_gold_customer_activity": _with(GOLD, "SELECT * FROM customer_activity"),
    "stream_gold_country_performance": _with(GOLD, "SELECT * FROM country_performance"),
    "stream_gold_fraud_summary": _with(GOLD, "SELECT * FROM fraud_summary"),
    "stream_gold_merchant_statistics": _with(GOLD, "SELECT * FROM merchant_statistics"),
    "stream_gold_system_performance": _with(GOLD, "SELECT * FROM system_performance"),
    "sql_over_lake": _with(GOLD, """SELECT 'bronze' AS layer, count(*) AS records, CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS volume FROM bronze
        UNION ALL SELECT 'silver', count(*), CAST(sum(amount_gbp) AS DECIMAL(18,2)) FROM silver
        UNION ALL SELECT 'gold', CAST(sum(transactions) AS BIGINT), CAST(sum(volume) AS DECIMAL(18,2)) FROM daily_revenue"""),
    "stream_snapshot": _with(TXN + "," + _PAYLOAD, """, t AS (SELECT max(arrived_at) AS newest FROM txn2)
        SELECT newest AS newest_arrival,
          (SELECT count(*) FROM payload, t WHERE arrived_at > newest - INTERVAL '60' SECOND) AS records,
          (SELECT CAST(coalesce(sum(strlen(payload)), 0) AS BIGINT) FROM payload, t WHERE arrived_at > newest - INTERVAL '60' SECOND) AS bytes,
          (SELECT CAST(floor(max(lag_us) / 1000) AS BIGINT) FROM txn2) AS max_lag_ms FROM t"""),
    "lake_stream_then_batch": _counts("2 * count(*)", "true"),
    "lake_rebuild_then_batch": _counts("count(*)", "true"),
    "lake_shrunk_batch": _counts("count(*)", _FIRST_HALF),
    "backfill_after_batch": _counts("count(*)", "true"),
    "active_customers_sketch": _with(SILVER, """SELECT event_date AS metric_date, count(DISTINCT customer_id) AS active_customers, true AS within_bound
        FROM silver GROUP BY event_date"""),
    "key_distribution_adaptive": "SELECT count(*) AS records, CAST(16 AS BIGINT) AS partitions, true AS below_twice_the_mean FROM events",
    "expired_partitions": """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, 0 AS seen FROM events
        WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) - 10 FROM events)""",
    "live_after_expiry": _with(SILVER, """SELECT 'raw' AS layer, count(*) AS records, min(arrived_at) AS first FROM flags
          WHERE CAST(arrived_at AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 10 FROM events)
        UNION ALL SELECT 'silver', count(*), min(arrived_at) FROM silver"""),
    "stream_progress": """SELECT count(*) AS input_rows, CAST(0 AS BIGINT) AS dropped_by_watermark, true AS in_order
        FROM events GROUP BY event_id % 3""",
    "failing_batch_stays_out": _with(SILVER, f"""SELECT event_date AS metric_date, count(*) AS transactions,
        CAST(sum(coalesce(amount_gbp, amount, 0)) AS DECIMAL(18,2)) AS volume, count(*) FILTER (WHERE is_fraud) AS fraud FROM (
          SELECT * FROM bronze f WHERE NOT ({_FIRST_HALF})
          QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrived_at, seq) = 1) GROUP BY 1"""),
    "batch_ledger": _with(SILVER, f"""SELECT 'b0' AS batch, 'quarantined' AS state, (SELECT count(*) FROM silver f WHERE {_FIRST_HALF}) AS rows
        UNION ALL SELECT 'b1', 'published', count(DISTINCT event_id) FROM bronze f WHERE NOT ({_FIRST_HALF})
        UNION ALL SELECT 'b2', 'published', count(DISTINCT event_id) FROM bronze f WHERE {_FIRST_HALF}
          AND event_id NOT IN (SELECT event_id FROM bronze f WHERE NOT ({_FIRST_HALF}))"""),
    "two_streams_one_lake": _with(SILVER, """SELECT 'raw' AS layer, 2 * count(*) AS records, count(DISTINCT event_id) AS ids FROM flags
        UNION ALL SELECT 'silver', count(*), count(DISTINCT event_id) FROM silver"""),
    "killed_write_resumes": _with(SILVER, f"""SELECT * FROM (VALUES ('before', false, false, false), ('between', true, true, false),
          ('after', true, true, true)) t(step, raw_all, bronze_all, rest_all), LATERAL (
        SELECT 'raw' AS layer, count(*) AS records, count(*) AS numbers FROM flags f WHERE raw_all OR {_FIRST_HALF}
        UNION ALL SELECT 'bronze', count(*), count(*) FROM flags f WHERE (bronze_all OR {_FIRST_HALF}) AND is_complete AND is_valid
        UNION ALL SELECT 'quarantine', count(*), count(*) FROM flags f WHERE (rest_all OR {_FIRST_HALF}) AND NOT (is_complete AND is_valid)
        UNION ALL SELECT 'silver', count(*), count(*) FROM silver f WHERE rest_all OR {_FIRST_HALF})""").replace("SELECT * FROM (VALUES", "SELECT step, layer, records, numbers FROM (VALUES"),
    "id_index_skip_existing": _with(SILVER, """SELECT event_id, seq,
        'b' || CAST(CAST(floor(extract(day FROM arrived_at) / 8) AS INTEGER) AS VARCHAR) AS batch FROM silver"""),
    **{
        f"incremental_{name}": _with(GOLD, f"SELECT * FROM {name}").replace(
            "FROM bronze\n  ) WHERE rn = 1", f"FROM bronze f WHERE ({_FIRST_HALF}) OR seq % 2 = 0\n  ) WHERE rn = 1"
        )
        for name in ("customer_activity", "country_performance", "merchant_statistics", "fraud_summary")
    },
    "warehouse_keys_stable": _with(SILVER, """SELECT dimension, count(*) AS keys, count(*) AS distinct_keys, count(*) AS largest,
        count(*) FILTER (WHERE early) AS old_keys, CAST(0 AS BIGINT) AS moved, CAST(sum(n) AS BIGINT) AS facts FROM (
          SELECT 'customer' AS dimension, customer_id AS natural, count(*) AS n, bool_or(seq % 7 < 3 AND customer_id > 'CUS-2') AS early FROM silver GROUP BY ALL
          UNION ALL SELECT 'merchant', merchant_id || '|' || merchant_category, count(*), bool_or(seq % 7 < 3 AND customer_id > 'CUS-2') FROM silver GROUP BY ALL
          UNION ALL SELECT 'country', country, count(*), bool_or(seq % 7 < 3 AND customer_id > 'CUS-2') FROM silver WHERE country IS NOT NULL GROUP BY ALL
        ) GROUP BY dimension"""),
    "stream_quality": _with(REPORT, """SELECT *, CASE WHEN score >= 95 THEN 'PUBLISH' ELSE 'QUARANTINE' END AS decision, score < 97 AS warning,
        '0' AS batch FROM report"""),
}
