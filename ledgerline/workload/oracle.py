"""The registered queries in plain SQL, for comparison on another engine."""

from __future__ import annotations

from ledgerline.workload.tables import NO_BEHAVIOR, NO_TELEMETRY

_WIDE = """
wide AS (
  SELECT 'TX' || CAST(e.event_id AS VARCHAR) AS transaction_id,
         e.ts AS "timestamp",
         'ACC' || CAST(e.user_id AS VARCHAR) AS sender_account,
         'ACC' || CAST((e.user_id * 7 + e.event_id) % 150 AS VARCHAR) AS receiver_account,
         CAST(e.value AS DECIMAL(18,2)) AS amount,
         e.event_type AS transaction_type,
         c.c_mktsegment AS merchant_category,
         CASE WHEN e.event_id % 40 = 0 THEN NULL ELSE n.n_name END AS location,
         CASE e.event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'web' ELSE 'pos' END AS device_used,
         (e.event_type = 'error' AND e.event_id % 3 <> 0) AS is_fraud,
         CASE WHEN e.event_type = 'error' AND e.event_id % 3 <> 0 AND e.event_id % 20 <> 1
              THEN CASE e.event_id % 2 WHEN 0 THEN 'identity' ELSE 'card_testing' END END AS fraud_type,
         CAST(e.event_id % 20 + 1 AS DECIMAL(18,2)) AS velocity_score,
         CAST(e.event_id % 101 AS DOUBLE) AS geo_anomaly_score,
         CAST(e.event_id % 201 - 100 AS DOUBLE) AS spending_deviation_score,
         CASE e.event_id % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'ach' WHEN 2 THEN 'wire' ELSE 'upi' END AS payment_channel,
         '10.' || CAST(e.user_id % 256 AS VARCHAR) || '.' || CAST(e.event_id % 256 AS VARCHAR) || '.1' AS ip_address,
         md5('dev-' || CAST(e.user_id AS VARCHAR) || '-' || CAST(e.event_id % 3 AS VARCHAR)) AS device_hash
  FROM events e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
)"""


def _mean_micros(column: str) -> str:
    """Mean of a two-digit decimal column in millionths, rounded half up, in integers."""
    cents, n = f"CAST(sum({column}) * 100 AS HUGEINT)", f"count({column})"
    return f"((2 * {cents} * 10000 + {n}) // (2 * {n}))"


_RAW = f"""
raw_payments AS (
  SELECT transaction_id AS tx_id, "timestamp" AS event_time, sender_account, receiver_account,
         amount, payment_channel, location FROM wide),
raw_merchant AS (
  SELECT transaction_id AS ID, merchant_category AS Category, transaction_type AS Type,
         amount AS Amount, location AS Location FROM wide),
raw_device AS (
  SELECT transaction_id, device_used, device_hash, ip_address FROM wide),
rollup_all AS (
  SELECT sender_account, merchant_category,
         {_mean_micros("amount")} AS mean_amount,
         count(transaction_id) AS tx_count_last_24h,
         max(velocity_score) AS max_velocity_score,
         {_mean_micros("velocity_score")} AS mean_velocity,
         min(velocity_score) AS min_velocity_score,
         avg(geo_anomaly_score) AS avg_geo_anomaly_score,
         avg(spending_deviation_score) AS avg_spending_deviation_score
  FROM wide WHERE sender_account IS NOT NULL GROUP BY sender_account, merchant_category),
rollup AS (SELECT * FROM rollup_all),
raw_fraud_timing AS (
  SELECT transaction_id, date_trunc('millisecond', "timestamp") AS "timestamp",
         CASE WHEN CAST('0x' || substr(md5('42-' || transaction_id), 1, 6) AS BIGINT) % 10000 < 100
              THEN NULL ELSE location END AS location,
         is_fraud, fraud_type,
         CASE WHEN hour("timestamp") BETWEEN 5 AND 11 THEN 'morning'
              WHEN hour("timestamp") BETWEEN 12 AND 17 THEN 'afternoon' ELSE 'night' END AS time_of_day,
         dayname("timestamp") AS day_of_week
  FROM wide)"""

# The same with the keys that device and behavior lack in the queries about missing keys.
_GAPS = _RAW.replace(
    "device_hash, ip_address FROM wide)", f"device_hash, ip_address FROM wide WHERE transaction_type <> '{NO_TELEMETRY}')"
).replace("(SELECT * FROM rollup_all)", f"(SELECT * FROM rollup_all WHERE merchant_category <> '{NO_BEHAVIOR}')")

_SILVER = """
payments AS (
  SELECT tx_id AS transaction_id, event_time, sender_account, receiver_account, amount, payment_channel,
         location, 'payments' AS source_system, location IS NULL AS location_missing FROM raw_payments),
merchant AS (
  SELECT ID AS transaction_id, Category, Type, Amount AS amount, Location AS location,
         'merchant' AS source_system, Location IS NULL AS location_missing FROM raw_merchant),
device AS (
  SELECT transaction_id, 'device' AS source_system, device_hash, device_used, ip_address FROM raw_device),
customer_behavior AS (
  SELECT sender_account, ((mean_amount + 5000) // 10000) / 100.0::DOUBLE AS avg_amount_last_24h,
         tx_count_last_24h, max_velocity_score,
         ((mean_velocity + 5000) // 10000) / 100.0::DOUBLE AS mean_velocity_score,
         min_velocity_score, avg_geo_anomaly_score, avg_spending_deviation_score,
         'customer_behavior' AS source_system FROM rollup),
fraud_timing AS (
  SELECT *, 'fraud_timing' AS source_system, location IS NULL AS location_missing,
         is_fraud AND fraud_type IS NULL AS is_fraud_inconsistent FROM raw_fraud_timing)"""

_FACTS = """
facts AS (
  SELECT p.transaction_id, p.event_time, p.sender_account, p.receiver_account, p.amount, p.payment_channel,
         p.location, p.source_system, p.location_missing, m.Category, m.Type,
         d.device_hash, d.device_used, d.ip_address,
         f."timestamp", f.is_fraud, f.fraud_type, f.time_of_day, f.day_of_week, f.is_fraud_inconsistent
  FROM payments p
  LEFT JOIN merchant m ON m.transaction_id = p.transaction_id
  LEFT JOIN device d ON d.transaction_id = p.transaction_id
  LEFT JOIN fraud_timing f ON f.transaction_id = p.transaction_id)"""

_BEHAVIOR = """b.avg_amount_last_24h, b.tx_count_last_24h,
         CAST(b.max_velocity_score AS DOUBLE) AS max_velocity_score, b.mean_velocity_score,
         CAST(b.min_velocity_score AS DOUBLE) AS min_velocity_score,
         b.avg_geo_anomaly_score, b.avg_spending_deviation_score"""


def _over(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_ON_WIDE = _over(_WIDE)
_ON_RAW = _over(_WIDE, _RAW)
_ON_SILVER = _over(_WIDE, _RAW, _SILVER)
_ON_FACTS = _over(_WIDE, _RAW, _SILVER, _FACTS)
_ON_GAPS = _over(_WIDE, _GAPS, _SILVER, _FACTS)

_PAYMENTS_RAW = """SELECT tx_id, event_time, sender_account, receiver_account,
       CAST(amount AS DOUBLE) AS amount, payment_channel, location FROM raw_payments"""

def _fraud_by(key: str, extra: str = "") -> str:
    return f"""SELECT {key}, count(DISTINCT transaction_id) AS fraud_transaction_count,
       CAST(sum(CAST(is_fraud AS INT)) AS BIGINT) AS fraud_count,
       CAST(sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS DOUBLE) AS fraud_amount,
       count(DISTINCT "timestamp") AS timestamps_size,
       count(DISTINCT fraud_type) AS fraud_types_size,
       'fraud_by_{key.lower()}' AS dataset_type{extra}
FROM facts GROUP BY {key}"""


def _scaled(key: str) -> str:
    return f"""SELECT {key},
       round(coalesce((n - min(n) OVER ()) / nullif(CAST(max(n) OVER () - min(n) OVER () AS DOUBLE), 0), 0), 9)
         AS fraud_transaction_count,
       round(coalesce((a - min(a) OVER ()) / nullif(max(a) OVER () - min(a) OVER (), 0), 0), 9) AS fraud_amount
FROM (SELECT {key}, count(DISTINCT transaction_id) AS n,
             CAST(sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS DOUBLE) AS a
      FROM facts GROUP BY {key})"""


# Silver columns by source: name, profile type in Bronze, expression over the raw table.
_BRONZE_COLUMNS = {
    "payments": (
        "raw_payments",
        [
            ("tx_id", "string"),
            ("event_time", "timestamp"),
            ("sender_account", "string"),
            ("receiver_account", "string"),
            ("amount", "decimal(18,2)"),
            ("payment_channel", "string"),
            ("location", "string"),
        ],
    ),
    "merchant": (
        "raw_merchant",
        [
            ("ID", "string"),
            ("Category", "string"),
            ("Type", "string"),
            ("Amount", "decimal(18,2)"),
            ("Location", "string"),
        ],
    ),
    "device": (
        "(SELECT transaction_id, {'device_used': device_used, 'device_hash': device_hash} AS device, "
        "{'ip_address': ip_address} AS network FROM raw_device)",
        [
            ("transaction_id", "string"),
            ("device", "struct<device_used:string,device_hash:string>"),
            ("network", "struct<ip_address:string>"),
        ],
    ),
    "customer_behavior": (
        "(SELECT sender_account, mean_amount AS avg_amount_last_24h, tx_count_last_24h, max_velocity_score, "
        "mean_velocity AS mean_velocity_score, min_velocity_score, avg_geo_anomaly_score, "
        "avg_spending_deviation_score FROM rollup)",
        [
            ("sender_account", "string"),
            ("avg_amount_last_24h", "double"),
            ("tx_count_last_24h", "bigint"),
            ("max_velocity_score", "decimal(18,2)"),
            ("mean_velocity_score", "double"),
            ("min_velocity_score", "decimal(18,2)"),
            ("avg_geo_anomaly_score", "double"),
            ("avg_spending_deviation_score", "double"),
        ],
    ),
    "fraud_timing": (
        "raw_fraud_timing",
        [
            ("transaction_id", "string"),
            ("timestamp", "timestamp"),
            ("location", "string"),
            ("is_fraud", "boolean"),
            ("fraud_type", "string"),
            ("time_of_day", "string"),
            ("day_of_week", "string"),
        ],
    ),
}
_LINEAGE_COLUMNS = [("source_system", "string"), ("ingestion_timestamp", "timestamp")]


def _profile_select(sources=tuple(_BRONZE_COLUMNS)) -> str:
    rows = []
    for source in sources:
        relation, columns = _BRONZE_COLUMNS[source]
        for name, kind in [*columns, *_LINEAGE_COLUMNS]:
            value = "1" if (name, kind) in _LINEAGE_COLUMNS else f'"{name}"'
            distinct = f"count(DISTINCT {value}) + coalesce(max(CASE WHEN {value} IS NULL THEN 1 ELSE 0 END), 0)"
            nulls = f"count(*) FILTER (WHERE {value} IS NULL)"
            metrics = {
                "row_count": "count(*)",
                "null_count": nulls,
                "null_pct": f"CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST({nulls} AS DOUBLE) / count(*) * 100 END",
                "distinct_count": distinct,
            }
            rows += [
                f"SELECT '{source}' AS source, '{name}' AS column_name, '{metric}' AS metric, "
                f"CAST({value_sql} AS DOUBLE) AS metric_value, '{kind}' AS data_type FROM {relation}"
                for metric, value_sql in metrics.items()
            ]
    return "\nUNION ALL\n".join(rows)


def _on_profiles(select: str) -> str:
    return _over(_WIDE, _RAW, f"\nprofiles AS ({_profile_select()})") + select


def _alert(source: str, check: str, column: str, observed: str, expected: str, message: str) -> str:
    return (
        f"SELECT CAST({source} AS VARCHAR) AS source, '{check}' AS \"check\", CAST({column} AS VARCHAR) AS \"column\", "
        f"CAST({observed} AS DOUBLE) AS observed, CAST({expected} AS DOUBLE) AS expected, {message} AS message"
    )


def _uniqueness(source: str, column: str, relation: str) -> str:
    text = f"'{source}: {column} not unique (' || n || ' rows vs ' || d || ' distinct)'"
    return (
        _alert(f"'{source}'", "uniqueness", f"'{column}'", "n", "d", text)
        + f" FROM (SELECT count(*) AS n, count(DISTINCT {column}) "
        f"+ coalesce(max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END), 0) AS d FROM {relation}) WHERE n <> d"
    )


# Columns that can be NULL decide completeness; the others are listed for the whole check.
_SILVER_COLUMNS = {
    "payments": "transaction_id event_time sender_account receiver_account amount payment_channel location "
    "source_system location_missing",
    "merchant": "transaction_id Category Type amount location source_system location_missing",
    "device": "transaction_id source_system device_hash device_used ip_address",
    "customer_behavior": "sender_account avg_amount_last_24h tx_count_last_24h max_velocity_score "
    "mean_velocity_score min_velocity_score avg_geo_anomaly_score avg_spending_deviation_score source_system",
    "fraud_timing": "transaction_id timestamp location is_fraud fraud_type time_of_day day_of_week "
    "source_system location_missing is_fraud_inconsistent",
}


def _completeness(threshold: float) -> str:
    text = "source || ': ' || \"column\" || ' has ' || printf('%.2f', share * 100) || '% nulls'"
    shares = "\nUNION ALL\n".join(
        f"SELECT '{source}' AS source, '{column}' AS \"column\", "
        f"CAST(count(*) FILTER (WHERE \"{column}\" IS NULL) AS DOUBLE) / count(*) AS share FROM {source}"
        for source, columns in _SILVER_COLUMNS.items()
        for column in columns.split()
    )
    return _alert("source", "completeness", '"column"', "share", str(threshold), text) + (
        f" FROM ({shares}) WHERE share > {threshold}"
    )


def _counts(sources) -> str:
    return " UNION ALL ".join(
        f"SELECT {at} AS pos, '{name}' AS source, count(*) AS n FROM {relation}"
        for at, (name, relation) in enumerate(sources.items())
    )


def _row_count_checks(sources: dict[str, str]) -> str:
    counts = _counts(sources)
    listed = "string_agg(source, ', ' ORDER BY pos)"
    pairs = "string_agg(source || '=' || n, ', ' ORDER BY pos)"
    return (
        _alert("NULL", "empty_datasets", "NULL", "e", "0", "'Empty datasets detected: ' || t")
        + f" FROM (SELECT count(*) AS e, {listed} AS t FROM ({counts}) WHERE n = 0) WHERE e > 0\nUNION ALL\n"
        + _alert("NULL", "row_count_mismatch", "NULL", "d", "1", "'Row count mismatch across sources: ' || t")
        + f" FROM (SELECT count(DISTINCT n) AS d, {pairs} AS t FROM ({counts})) WHERE d > 1"
    )


def _number(column: str) -> str:
    return f"CAST(substr({column}, 3) AS BIGINT)"


def _missing(other: str, key: str, base: str = "payments") -> str:
    return f"(SELECT count(*) AS missing FROM (SELECT {key} FROM {base} EXCEPT SELECT {key} FROM {other}))"


def _coverage(other: str, key: str) -> str:
    text = f"'{other}: ' || missing || ' {key}s missing vs payments'"
    return _alert(f"'{other}'", "key_coverage", f"'{key}'", "missing", "0", text) + (
        f" FROM {_missing(other, key)} WHERE missing > 0"
    )


_SOURCES = {name: name for name in _SILVER_COLUMNS}

_HASHED = (
    "transaction_id event_time sender_account receiver_account amount payment_channel location location_missing "
    "Category Type device_hash device_used ip_address timestamp is_fraud fraud_type time_of_day day_of_week "
    "is_fraud_inconsistent avg_amount_last_24h tx_count_last_24h max_velocity_score mean_velocity_score "
    "min_velocity_score avg_geo_anomaly_score avg_spending_deviation_score"
).split()


def _row_text() -> str:
    """Each Gold column by name, its length before it; times in microseconds."""
    parts = []
    for column in sorted(_HASHED):
        text = f'epoch_us("{column}")' if column in ("timestamp", "event_time") else f'"{column}"'
        if column in ("avg_amount_last_24h", "mean_velocity_score"):
            text = f"CAST({text} AS DECIMAL(18,2))"
        text = f"CAST({text} AS VARCHAR)"
        parts.append(f"coalesce(length({text}) || ':' || {text}, '-')")
    return " || ".join(parts)


def oracle_sql() -> dict[str, str]:
    payments_ms = _PAYMENTS_RAW.replace("event_time,", "date_trunc('millisecond', event_time) AS event_time,")
    sql = {
        "csv_roundtrip": _ON_RAW + _PAYMENTS_RAW,
        "json_scan": _ON_RAW + _PAYMENTS_RAW,
        "json_multiline_scan": _ON_RAW + _PAYMENTS_RAW,
        "parquet_overwrite_scan": _ON_RAW + payments_ms,
        "wide_csv_scan": _ON_WIDE
        + """SELECT transaction_id, "timestamp", sender_account, receiver_account, CAST(amount AS DOUBLE) AS amount,
       transaction_type, merchant_category, location, device_used, is_fraud, fraud_type,
       CAST(velocity_score AS DOUBLE) AS velocity_score, geo_anomaly_score, spending_deviation_score,
       payment_channel, ip_address, device_hash FROM wide""",
        "jsonl_roundtrip": _ON_RAW + "SELECT transaction_id, device_hash, device_used, ip_address FROM raw_device",
        "generic_scan_orc": _ON_RAW
        + "SELECT ID, Category, Type, CAST(Amount AS DOUBLE) AS Amount, Location FROM raw_merchant",
        "dataset_reassembly": _ON_RAW + "SELECT * FROM raw_fraud_timing",
        "uneven_parts": _ON_RAW
        + f"""SELECT tx_id, n, CASE WHEN n % 3 <> 1 THEN payment_channel END AS payment_channel,
       CASE WHEN n % 3 = 1 THEN location END AS location, CASE WHEN n % 3 <> 2 THEN n END AS x,
       CASE WHEN n % 3 = 1 THEN location END AS y
FROM (SELECT *, {_number("tx_id")} AS n FROM raw_payments)""",
        "file_row_audit": _ON_RAW
        + "SELECT source, NULL AS file_name, true AS has_files, n AS row_count FROM ("
        + _counts(
            {
                "payments": "raw_payments",
                "merchant": "raw_merchant",
                "device": "raw_device",
                "customer_behavior": "rollup",
                "fraud_timing": "raw_fraud_timing",
            }
        )
        + f""") UNION ALL
SELECT 'payments_files', printf('payments-%s-%03d.csv', payment_channel, {_number("tx_id")} // 5000), true, count(*)
FROM raw_payments GROUP BY ALL
UNION ALL
SELECT 'device_files', printf('device-%03d.json.gz', {_number("transaction_id")} // 5000), true, count(*) FROM raw_device GROUP BY ALL""",
        "quarantine": _ON_RAW
        + f"""SELECT 'payments_broken' AS source, CASE n WHEN 0 THEN 'TX' || substr(tx_id, 3, 1) ELSE 'cut' END AS "start",
       CASE n WHEN 0 THEN tx_id ELSE 'cut' END AS "key"
FROM (SELECT tx_id, {_number("tx_id")} % 50 AS n FROM raw_payments) WHERE n IN (0, 1)
UNION ALL
SELECT 'device_broken', '{{"t', NULL FROM raw_device WHERE {_number("transaction_id")} % 50 = 2""",
        "ingest_status": _ON_RAW
        + "SELECT source, 'loaded' AS status, n AS row_count, CAST(0 AS BIGINT) AS malformed FROM ("
        + _counts(
            {
                "payments": "raw_payments",
                "merchant": "raw_merchant",
                "device": "raw_device",
                "customer_behavior": "rollup",
                "fraud_timing": "raw_fraud_timing",
            }
        )
        + f""") UNION ALL SELECT 'no_rows', 'empty', CAST(0 AS BIGINT), CAST(0 AS BIGINT)
UNION ALL SELECT 'no_path', 'missing', NULL, NULL UNION ALL SELECT 'no_match', 'failed', NULL, NULL
UNION ALL SELECT 'payments_broken', 'loaded', count(*), count(*) FILTER ({_number("tx_id")} % 50 IN (0, 1)) FROM raw_payments
UNION ALL SELECT 'device_broken', 'loaded', count(*), count(*) FILTER ({_number("transaction_id")} % 50 = 2) FROM raw_device""",
        "rename_by_map": _ON_RAW
        + """SELECT ID AS transaction_id, Category, Type, CAST(Amount AS DOUBLE) AS amount,
       Location AS location FROM raw_merchant""",
        "lineage_columns": _ON_RAW
        + """SELECT ID, Category, Type, CAST(Amount AS DOUBLE) AS Amount, Location,
       'merchant' AS source_system FROM raw_merchant""",
        "struct_flatten": _ON_SILVER + "SELECT * FROM device",
        "safe_decimal": """WITH t AS (
  SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v FROM events)
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN v WHEN 1 THEN '  ' || v || '5 ' WHEN 2 THEN v || ' EUR'
            ELSE '12345678901234567890' || v END AS amount_text,
       CAST(CASE event_id % 4 WHEN 0 THEN CAST(v AS DECIMAL(18,2))
            WHEN 1 THEN CAST(v AS DECIMAL(18,2)) + CASE WHEN v LIKE '-%' THEN -0.01 ELSE 0.01 END END AS DOUBLE) AS amount
FROM t""",
        "timestamp_normalize": """SELECT event_id, ts, ts AS event_time,
       date_trunc('millisecond', ts) AS ts_ms FROM events""",
        "parse_timestamp_coerce": """SELECT count(*) FILTER (WHERE event_type IN ('error', 'view')) AS unparsed,
       count(*) FILTER (WHERE event_type = 'error') AS malformed FROM events""",
        "stringify_objects": _ON_WIDE
        + """SELECT transaction_id AS ID, coalesce(merchant_category, 'nan') AS Category,
       coalesce(transaction_type, 'nan') AS Type, CAST(amount AS DOUBLE) AS Amount,
       coalesce(location, 'nan') AS Location FROM wide""",
        "location_missing": _ON_SILVER
        + """SELECT location, location_missing, count(*) AS row_count FROM payments
GROUP BY location, location_missing""",
        "fraud_inconsistent": _ON_SILVER
        + "SELECT transaction_id, location_missing, is_fraud_inconsistent FROM fraud_timing",
        "time_of_day": _ON_RAW + 'SELECT time_of_day, count(*) AS "count" FROM raw_fraud_timing GROUP BY time_of_day',
        "day_of_week": _ON_RAW + "SELECT transaction_id, day_of_week FROM raw_fraud_timing",
        "null_injection": _ON_RAW + "SELECT transaction_id, location FROM raw_fraud_timing",
        "row_hash": _ON_FACTS
        + f"SELECT transaction_id, sha256({_row_text()}) AS row_hash FROM (SELECT g.*, b.* EXCLUDE (sender_account, "
        "source_system) FROM facts g LEFT JOIN customer_behavior b ON b.sender_account = g.sender_account)",
        "decompose": _ON_RAW
        + " UNION ALL ".join(
            f"SELECT '{name}' AS source, {key} AS \"key\" FROM {relation}"
            for name, key, relation in (
                ("payments", "tx_id", "raw_payments"),
                ("merchant", "ID", "raw_merchant"),
                ("device", "transaction_id", "raw_device"),
                ("customer_behavior", "sender_account", "rollup"),
                ("fraud_timing", "transaction_id", "raw_fraud_timing"),
            )
        ),
        "transaction_join": _ON_FACTS + "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM facts",
        "behavior_join": _ON_SILVER
        + f"""SELECT p.* REPLACE (CAST(p.amount AS DOUBLE) AS amount), {_BEHAVIOR}
FROM payments p LEFT JOIN customer_behavior b ON b.sender_account = p.sender_account""",
        "gold_table": _ON_GAPS
        + f"""SELECT g.* REPLACE (CAST(g.amount AS DOUBLE) AS amount), {_BEHAVIOR}
FROM facts g LEFT JOIN customer_behavior b ON b.sender_account = g.sender_account""",
        "duplicate_key_join": """SELECT o_orderkey AS transaction_id, o_orderstatus AS status,
       l_linenumber, l_quantity, l_returnflag
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
        "heavy_key_join": """SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity, flag_rows
FROM lineitem LEFT JOIN (SELECT l_returnflag AS flag, count(*) AS flag_rows FROM lineitem GROUP BY l_returnflag)
  ON flag = l_returnflag""",
        "heavy_right_join": """SELECT f.l_returnflag, l_orderkey, l_linenumber, l_quantity
FROM (SELECT DISTINCT l_returnflag FROM lineitem UNION ALL SELECT 'none-' || r_regionkey FROM region) f
LEFT JOIN lineitem l ON l.l_returnflag = f.l_returnflag""",
        "key_coverage": _ON_GAPS
        + "\nUNION ALL\n".join(
            f"SELECT '{other}' AS source, '{key}' AS \"key\", missing FROM {_missing(other, key)}"
            for other, key in (
                ("merchant", "transaction_id"),
                ("device", "transaction_id"),
                ("fraud_timing", "transaction_id"),
                ("customer_behavior", "sender_account"),
            )
        ),
        "missing_keys": "SELECT o_orderkey AS order_key FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
        "customer_behavior": _ON_RAW
        + """SELECT sender_account, CAST(mean_amount AS DOUBLE) / 1e6 AS avg_amount_last_24h, tx_count_last_24h,
       CAST(max_velocity_score AS DOUBLE) AS max_velocity_score,
       CAST(mean_velocity AS DOUBLE) / 1e6 AS mean_velocity_score,
       CAST(min_velocity_score AS DOUBLE) AS min_velocity_score,
       avg_geo_anomaly_score, avg_spending_deviation_score FROM rollup_all""",
        "key_sketches": " UNION ALL ".join(
            f"SELECT 'lineitem' AS source, '{c}' AS \"column\", {c} AS item, count(*) AS item_count FROM lineitem GROUP BY {c}"
            for c in ("l_returnflag", "l_linestatus")
        ),
        "bucketed_census": _ON_GAPS
        + " UNION ALL ".join(
            f"SELECT '{name}' AS source, 'transaction_id' AS \"key\", count(*) AS row_count, "
            f"count(DISTINCT transaction_id) AS distinct_count, (SELECT missing FROM {_missing(name, 'transaction_id')}) AS missing FROM {name}"
            for name in _SOURCES
            if name != "customer_behavior"
        ),
        "fraud_summaries": _ON_FACTS
        + " UNION ALL ".join(
            _fraud_by(key).replace(f"SELECT {key},", f'SELECT {key} AS "key",', 1) for key in ("Category", "Type", "location")
        ),
        "row_counts": _ON_SILVER + f"SELECT source, n AS row_count FROM ({_counts(_SOURCES)})",
        "uniqueness": _uniqueness("orders", "o_orderkey", "orders")
        + "\nUNION ALL\n"
        + _uniqueness("lineitem", "l_orderkey", "lineitem"),
        "completeness": _ON_SILVER + _completeness(0.01),
        "row_count_checks": _ON_SILVER
        + _row_count_checks({**_SOURCES, "refunds": "(SELECT * FROM payments WHERE amount < 0)"}),
        "alerts": _ON_GAPS
        + "\nUNION ALL\n".join(
            [
                *[
                    _uniqueness(name, "transaction_id", name)
                    for name in _SOURCES
                    if name != "customer_behavior"
                ],
                _completeness(0.05),
                _row_count_checks(_SOURCES),
                _coverage("device", "transaction_id"),
                _coverage("fraud_timing", "transaction_id"),
                _coverage("customer_behavior", "sender_account"),
                _alert("'payments'", "cast", "'amount'", "n", "0", "'payments: ' || n || ' values of amount could not be read'")
                + f" FROM (SELECT count(*) AS n FROM raw_payments WHERE {_number('tx_id')} % 50 = 0) WHERE n > 0",
                _alert("'refunds'", "processing", "NULL", "NULL", "NULL", "'refunds: processing failed'"),
            ]
        ),
        "profile": _ON_RAW + _profile_select(),
        "profile_written": _ON_RAW + _profile_select(),
        "nested_profile": """WITH t AS (SELECT epoch_us(ts) + event_id % 3 AS a, event_type, user_id FROM events)
SELECT 'stamp' AS column_name, CAST(count(DISTINCT a || event_type) AS DOUBLE) AS metric_value FROM t
UNION ALL SELECT 'times', CAST(count(DISTINCT a) AS DOUBLE) FROM t
UNION ALL SELECT 'users', CAST(count(DISTINCT event_type || user_id) AS DOUBLE) FROM t""",
        "profile_columns": _on_profiles(
            """SELECT source, string_agg(DISTINCT column_name, ',' ORDER BY column_name) AS column_names
FROM profiles GROUP BY source"""
        ),
        "column_names": _on_profiles("SELECT DISTINCT column_name FROM profiles"),
        "data_types": _on_profiles("SELECT DISTINCT data_type FROM profiles"),
        "struct_columns": _on_profiles("SELECT * FROM profiles WHERE data_type LIKE 'struct<%'"),
        "profile_row_counts": _on_profiles(
            "SELECT source, max(metric_value) AS row_count FROM profiles WHERE metric = 'row_count' GROUP BY source"
        ),
        "null_issues": _on_profiles(
            """SELECT source, column_name, metric, round_even(metric_value, 1) AS metric_value FROM profiles
WHERE metric IN ('null_count', 'null_pct') AND metric_value > 0"""
        ),
        "medallion_run": _ON_FACTS
        + " UNION ALL ".join(
            _fraud_by(key, ", count(*) AS hashes").replace(f"SELECT {key},", f'SELECT {key} AS "key",', 1)
            for key in ("Category", "Type", "location")
        ),
    }
    sql["bucketed_join"] = sql["transaction_join"]
    for key in ("Category", "Type", "location"):
        low = key.lower()
        sql[f"fraud_by_{low}"] = _ON_FACTS + _fraud_by(key)
        sql[f"timestamps_by_{low}"] = (
            _ON_FACTS + f'SELECT DISTINCT {key}, "timestamp" FROM facts WHERE "timestamp" IS NOT NULL'
        )
        sql[f"fraud_types_by_{low}"] = (
            _ON_FACTS + f"SELECT DISTINCT {key}, fraud_type FROM facts WHERE fraud_type IS NOT NULL"
        )
        sql[f"scaled_{low}"] = _ON_FACTS + _scaled(key)
    for label, measure in (("count", "fraud_transaction_count"), ("amount", "fraud_amount")):
        for name, key in (("top_locations", "location"), ("ranked_category", "Category"), ("ranked_type", "Type")):
            order = f"{measure} DESC NULLS LAST, {key} NULLS FIRST"
            sql[f"{name}_by_{label}"] = _ON_FACTS + (
                f"SELECT row_number() OVER (ORDER BY {order}) AS rank, {key}, {measure} FROM ({_scaled(key)}) "
                f"ORDER BY {order} LIMIT 20"
            )
    return sql
