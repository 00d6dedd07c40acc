"""DuckDB SQL equal to each registered query, over the driver's test tables (views of the same names).

Each text builds the same usage/version mapping as :mod:`meterline.testdata`.  The as-of join uses
DuckDB's ``ASOF JOIN``; running totals and first hits use window functions.  ``0.9`` is written as a
double, like the Java comparison it mirrors.
"""

from __future__ import annotations

from ..testdata import HOT_ACCOUNT, LONG_RANGE_QUOTA, RANGE_END, RANGE_START

USAGE = """usage AS (
  SELECT printf('%06d', user_id) AS account, CAST(round(value * 100) AS BIGINT) AS bytesUsed,
         ts, event_id
  FROM events WHERE event_type <> 'signup')"""

VERSIONS = """versions AS (
  SELECT printf('%06d', user_id) AS id, 50000 + CAST(round(value * 100) AS BIGINT) AS quota, ts
  FROM events WHERE event_type = 'signup')"""

ENRICHED = """enriched AS (
  SELECT u.account, u.bytesUsed, u.ts, u.event_id, v.quota,
         CAST(year(u.ts) AS BIGINT) AS billingYear, CAST(month(u.ts) AS BIGINT) AS billingMonth
  FROM usage u ASOF JOIN versions v ON u.account = v.id AND u.ts >= v.ts)"""

HOT_USAGE = f"""usage AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN '{HOT_ACCOUNT}' ELSE printf('%06d', user_id) END AS account,
         CAST(round(value * 100) AS BIGINT) AS bytesUsed, ts, event_id
  FROM events WHERE event_type <> 'signup')"""

HOT_SECOND_USAGE = f"""usage AS (
  SELECT account, bytesUsed, event_id,
         CASE WHEN account = '{HOT_ACCOUNT}' THEN TIMESTAMP '{RANGE_START}' ELSE ts END AS ts
  FROM (SELECT CASE WHEN event_id % 3 = 0 THEN '{HOT_ACCOUNT}' ELSE printf('%06d', user_id) END AS account,
               CAST(round(value * 100) AS BIGINT) AS bytesUsed, ts, event_id
        FROM events WHERE event_type <> 'signup'))"""

HOT_VERSIONS = f"""versions AS (
  SELECT id, quota, ts FROM (
    SELECT printf('%06d', user_id) AS id, 50000 + CAST(round(value * 100) AS BIGINT) AS quota, ts
    FROM events WHERE event_type = 'signup') WHERE id <> '{HOT_ACCOUNT}'
  UNION ALL
  SELECT '{HOT_ACCOUNT}' AS id, max(50000 + CAST(round(value * 100) AS BIGINT)) AS quota, ts
  FROM events WHERE event_type = 'signup' GROUP BY ts)"""

LONG_USAGE = """usage AS (
  SELECT printf('%06d', o_custkey) AS account, CAST(round(o_totalprice) AS BIGINT) AS bytesUsed,
         o_orderdate AS ts, o_orderkey AS event_id
  FROM orders)"""

LONG_VERSIONS = f"""versions AS (
  SELECT printf('%06d', c_custkey) AS id, CAST({LONG_RANGE_QUOTA} AS BIGINT) AS quota,
         TIMESTAMP '1990-01-01 00:00:00' AS ts
  FROM customer)"""

# Usage as the log holds it: whole milliseconds, and no position in the log but the bytes as a tie.
LOG_USAGE = """usage AS (
  SELECT printf('%06d', user_id) AS account, CAST(round(value * 100) AS BIGINT) AS bytesUsed,
         date_trunc('millisecond', ts) AS ts, CAST(round(value * 100) AS BIGINT) AS event_id
  FROM events WHERE event_type <> 'signup')"""

RUNNING = """running AS (
  SELECT *, SUM(bytesUsed) OVER (PARTITION BY account, billingYear, billingMonth, quota
                                 ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM enriched)"""


def _iso(ts: str) -> str:
    us = f"(epoch_us({ts}) % 1000000)"
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {us} = 0 THEN '' "
            f"WHEN {us} % 1000 = 0 THEN printf('.%03d', {us} // 1000) "
            f"ELSE printf('.%06d', {us}) END || 'Z')")


ALERTS = f"""alerts AS (
  SELECT ts, account, billingYear, billingMonth, quota, CAST(total AS BIGINT) AS total,
         printf('WARNING: as of %s account %s has used %d out of %d bytes',
                {_iso('ts')}, account, total, quota) AS message
  FROM (SELECT *, row_number() OVER (PARTITION BY account, billingYear, billingMonth, quota
                                     ORDER BY ts, event_id) AS rn
        FROM running
        WHERE CAST(total AS DOUBLE) > CAST(0.9 AS DOUBLE) * CAST(quota AS DOUBLE)) h
  WHERE rn = 1)"""


MONTH_RUNNING = """running AS (
  SELECT *, SUM(bytesUsed) OVER (PARTITION BY account, billingYear, billingMonth
                                 ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM enriched)"""

MONTH_ALERTS = f"""alerts AS (
  SELECT ts, account, billingYear, billingMonth, quota, CAST(total AS BIGINT) AS total,
         printf('WARNING: as of %s account %s has used %d out of %d bytes',
                {_iso('ts')}, account, total, quota) AS message
  FROM (SELECT *, row_number() OVER (PARTITION BY account, billingYear, billingMonth
                                     ORDER BY ts, event_id) AS rn
        FROM running
        WHERE CAST(total AS DOUBLE) > CAST(0.9 AS DOUBLE) * CAST(quota AS DOUBLE)) h
  WHERE rn = 1)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _json(ts: str = "ts") -> str:
    return ("'{\"ts\":\"' || strftime(" + ts + ", '%Y-%m-%dT%H:%M:%S.%g') || '+0000\",\"account\":\"' "
            "|| account || '\",\"bytesUsed\":' || CAST(bytesUsed AS VARCHAR) || '}'")


CHANGES = """changes AS (
  SELECT account, ts, event_id, bytesUsed,
         SUM(bytesUsed) OVER w AS total,
         lag(ts) OVER (PARTITION BY account ORDER BY ts, event_id) AS prev_ts
  FROM usage
  WINDOW w AS (PARTITION BY account ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["usage_scan"] = _with(USAGE) + "SELECT account, bytesUsed, ts, event_id FROM usage"
    q["usage_json"] = _with(USAGE) + f"SELECT {_json()} AS value, event_id FROM usage"
    q["usage_json_roundtrip"] = _with(USAGE) + (
        "SELECT date_trunc('millisecond', ts) AS ts, account, bytesUsed, event_id FROM usage")
    q["usage_record_time"] = _with(USAGE) + (
        "SELECT date_trunc('millisecond', ts) AS ts, account, bytesUsed, event_id FROM usage")
    q["usage_range"] = _with(USAGE) + (
        f"SELECT account, bytesUsed, ts, event_id FROM usage "
        f"WHERE ts >= TIMESTAMP '{RANGE_START}' AND ts < TIMESTAMP '{RANGE_END}'")
    q["account_totals"] = _with(USAGE) + (
        "SELECT account, CAST(SUM(bytesUsed) AS BIGINT) AS totalConsumption, MAX(ts) AS asOf "
        "FROM usage GROUP BY account")
    q["account_totals_range"] = _with(USAGE) + (
        "SELECT account, CAST(SUM(bytesUsed) AS BIGINT) AS totalConsumption, MAX(ts) AS asOf FROM usage "
        f"WHERE ts >= TIMESTAMP '{RANGE_START}' AND ts < TIMESTAMP '{RANGE_END}' GROUP BY account")
    q["account_totals_changes"] = _with(USAGE, CHANGES) + """
SELECT '+I' AS op, account, CAST(total AS BIGINT) AS totalUsage, ts AS asOf, ts, event_id
FROM changes WHERE prev_ts IS NULL
UNION ALL
SELECT '-U' AS op, account, CAST(total - bytesUsed AS BIGINT) AS totalUsage, prev_ts AS asOf, ts, event_id
FROM changes WHERE prev_ts IS NOT NULL
UNION ALL
SELECT '+U' AS op, account, CAST(total AS BIGINT) AS totalUsage, ts AS asOf, ts, event_id
FROM changes WHERE prev_ts IS NOT NULL"""
    q["account_totals_changes_sliced"] = q["account_totals_changes"]
    q["account_totals_changes_hot_second"] = q["account_totals_changes"].replace(USAGE, HOT_SECOND_USAGE)
    q["quota_intervals"] = _with(VERSIONS) + (
        "SELECT id, quota, ts AS valid_from, lead(ts) OVER (PARTITION BY id ORDER BY ts) AS valid_to "
        "FROM versions")
    q["quota_intervals_sliced"] = q["quota_intervals"]
    enriched_cols = "account, bytesUsed, ts, event_id, quota, billingYear, billingMonth"
    q["quota_enriched"] = _with(USAGE, VERSIONS, ENRICHED) + f"SELECT {enriched_cols} FROM enriched"
    q["quota_enriched_shuffle"] = q["quota_enriched"]
    q["quota_enriched_merge"] = q["quota_enriched"]
    q["quota_enriched_merge_sliced"] = q["quota_enriched"]
    q["quota_enriched_ordered"] = _with(USAGE, VERSIONS, ENRICHED) + (
        "SELECT account, bytesUsed, quota, ts FROM enriched ORDER BY ts, event_id")
    q["quota_enriched_sql"] = _with(USAGE, VERSIONS, ENRICHED) + (
        "SELECT account, bytesUsed, quota, ts, billingYear, billingMonth FROM enriched")
    q["quota_enriched_dense_sql"] = _with(HOT_USAGE, HOT_VERSIONS, ENRICHED) + (
        "SELECT account, bytesUsed, quota, ts, billingYear, billingMonth FROM enriched")
    q["account_totals_sql"] = q["account_totals"]
    q["billing_usage"] = _with(USAGE, VERSIONS, ENRICHED) + (
        "SELECT account, billingYear, billingMonth, quota, CAST(SUM(bytesUsed) AS BIGINT) AS total, "
        "COUNT(*) AS records, MAX(ts) AS asOf FROM enriched "
        "GROUP BY account, billingYear, billingMonth, quota")
    q["running_usage"] = _with(USAGE, VERSIONS, ENRICHED, RUNNING) + (
        f"SELECT {enriched_cols}, CAST(total AS BIGINT) AS total FROM running")
    q["usage_alerts"] = _with(USAGE, VERSIONS, ENRICHED, RUNNING, ALERTS) + (
        "SELECT ts, account, billingYear, billingMonth, quota, total, message FROM alerts")
    q["running_usage_sliced"] = q["running_usage"]
    q["usage_alerts_sliced"] = q["usage_alerts"]
    q["usage_alerts_bucketed"] = q["usage_alerts"]
    q["running_usage_hot_account"] = _with(HOT_USAGE, VERSIONS, ENRICHED, RUNNING) + (
        f"SELECT {enriched_cols}, CAST(total AS BIGINT) AS total FROM running")
    q["usage_alerts_hot_account"] = _with(HOT_USAGE, VERSIONS, ENRICHED, RUNNING, ALERTS) + (
        "SELECT ts, account, billingYear, billingMonth, quota, total, message FROM alerts")
    q["quota_enriched_dense_versions"] = _with(HOT_USAGE, HOT_VERSIONS, ENRICHED) + (
        f"SELECT {enriched_cols} FROM enriched")
    q["quota_enriched_dense_versions_stream"] = q["quota_enriched_dense_versions"]
    q["usage_alerts_month_key"] = _with(USAGE, VERSIONS, ENRICHED, MONTH_RUNNING, MONTH_ALERTS) + (
        "SELECT ts, account, billingYear, billingMonth, quota, total, message FROM alerts")
    q["usage_alert_messages"] = _with(USAGE, VERSIONS, ENRICHED, RUNNING, ALERTS) + "SELECT message FROM alerts"
    q["usage_alerts_long_range"] = _with(LONG_USAGE, LONG_VERSIONS, ENRICHED, RUNNING, ALERTS) + (
        "SELECT ts, account, billingYear, billingMonth, quota, total, message FROM alerts")
    q["account_keys"] = _with(USAGE, VERSIONS, ENRICHED) + (
        "SELECT DISTINCT printf('%s/%d/%d/%d', account, billingYear, billingMonth, quota) AS key "
        "FROM enriched")
    # Streamed forms: replayed to completion, they must equal the batch results.
    q["account_totals_stream"] = _with(USAGE) + (
        "SELECT account, CAST(SUM(bytesUsed) AS BIGINT) AS totalUsage, MAX(ts) AS asOf "
        "FROM usage GROUP BY account")
    q["account_totals_unique_stream"] = _with(USAGE) + (
        "SELECT account, CAST(SUM(bytesUsed) AS BIGINT) AS totalUsage, date_trunc('millisecond', MAX(ts)) AS asOf "
        "FROM usage GROUP BY account")
    q["usage_log_stream"] = q["usage_json_roundtrip"]
    q["account_totals_changes_stream"] = q["account_totals_changes"]
    q["quota_enriched_stream"] = q["quota_enriched"]
    q["quota_enriched_versions_stream"] = q["quota_enriched"]
    q["usage_alerts_stream"] = q["usage_alerts"]
    q["usage_alerts_handover_stream"] = q["usage_alerts"]
    q["usage_alerts_carried_stream"] = q["usage_alerts"]
    q["usage_alerts_hot_account_stream"] = q["usage_alerts_hot_account"]
    q["usage_alerts_versions_stream"] = q["usage_alerts"]
    q["usage_alerts_clearing_stream"] = q["usage_alerts"]
    q["quota_enriched_ordered_stream"] = q["quota_enriched_ordered"]
    q["usage_publish_stream"] = _with(USAGE) + (
        "SELECT date_trunc('millisecond', ts) AS ts, account, bytesUsed FROM usage")
    q["log_account_totals_range"] = _with(USAGE) + (
        "SELECT account, CAST(SUM(bytesUsed) AS BIGINT) AS totalConsumption, "
        "date_trunc('millisecond', MAX(ts)) AS asOf FROM usage "
        f"WHERE ts >= TIMESTAMP '{RANGE_START}' AND ts < TIMESTAMP '{RANGE_END}' GROUP BY account")
    q["quota_enriched_late_stream"] = q["quota_enriched"]
    for name in ("lagging_versions", "delay", "changes"):
        q[f"quota_enriched_{name}_stream"] = q["quota_enriched"]
    q["quota_enriched_ordered_late_stream"] = q["quota_enriched_ordered"]
    q["usage_alerts_late_clearing_stream"] = _with(LONG_USAGE, LONG_VERSIONS, ENRICHED, RUNNING, ALERTS) + (
        "SELECT account, billingYear, billingMonth, quota FROM alerts")
    q["usage_alerts_clearing_orders_stream"] = q["usage_alerts_long_range"]
    q["usage_alerts_published"] = _with(LOG_USAGE, VERSIONS, ENRICHED, RUNNING, ALERTS) + (
        "SELECT ts, account, billingYear, billingMonth, quota, total, message FROM alerts")
    q["usage_alerts_published_stream"] = q["usage_alerts_published"]
    q["quota_enriched_log_sql"] = _with(LOG_USAGE, VERSIONS, ENRICHED) + (
        "SELECT account, bytesUsed, quota, ts, billingYear, billingMonth FROM enriched")
    q["quota_enriched_json_versions"] = q["quota_enriched"]
    q["enriched_records"] = q["quota_enriched"]
    q["usage_range_micros"] = _with(USAGE) + (
        "SELECT account, bytesUsed, ts, event_id FROM usage "
        "WHERE ts >= TIMESTAMP '2024-01-08 00:00:00.0005' AND ts < TIMESTAMP '2024-01-15 11:59:59.999999'")
    return q
