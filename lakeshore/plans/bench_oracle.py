"""DuckDB SQL for the benchmark-statistics queries."""

from __future__ import annotations

from lakeshore.operators.fingerprint import TREE_LEVELS
from lakeshore.plans.oracle_sql import TRIP_ORACLE


#: The columns of ``lineitem``.
LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)

_R3 = "CAST(ROUND(CAST({} AS DECIMAL(38,9)), 3) AS DOUBLE)"

RUN_RECORDS = """
rec AS (
  SELECT
    event_id, CASE WHEN event_id % 4 = 0 THEN 'warmup' ELSE 'measured' END AS phase,
    event_type AS query_name,
    CASE WHEN event_id % 50 = 0 THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN event_id % 50 = 0 THEN NULL
         WHEN event_type = 'error' THEN 10 + event_id % 2
         ELSE length(event_type) * 4 END AS rows_returned,
    value AS duration_seconds,
    'layout_' || CAST(user_id % 2 AS VARCHAR) AS layout,
    CASE WHEN event_id % 50 = 0 THEN ''
         WHEN event_type = 'click' THEN sha256(event_type || 'layout_' || CAST(user_id % 2 AS VARCHAR))
         ELSE sha256(event_type) END AS result_sha256
  FROM events
),
ok AS (SELECT * FROM rec WHERE phase = 'measured' AND status = 'success')
"""


def _stats():
    return ", ".join([
        _R3.format("MIN(duration_seconds)") + " AS min_seconds",
        _R3.format("quantile_cont(duration_seconds, 0.5)") + " AS median_seconds",
        _R3.format("quantile_cont(duration_seconds, 0.95)") + " AS p95_seconds",
        _R3.format("MAX(duration_seconds)") + " AS max_seconds",
    ])


_ROWS = ("CASE WHEN COUNT(DISTINCT rows_returned) = 1 THEN CAST(MIN(rows_returned) AS VARCHAR) "
         "ELSE 'inconsistent' END AS rows_returned")

STORAGE_RECORDS = """
st AS (
  SELECT
    event_id, CASE WHEN event_id % 4 = 0 THEN 'warmup' ELSE 'measured' END AS phase,
    ['put', 'get', 'mixed'][CAST(event_id % 3 + 1 AS INTEGER)] AS scenario_operation,
    CAST(CASE WHEN user_id % 2 = 0 THEN 4096 ELSE 1048576 END AS BIGINT) AS object_size_bytes,
    CAST(CASE WHEN user_id % 4 < 2 THEN 1 ELSE 4 END AS BIGINT) AS concurrency,
    CASE WHEN event_id % 50 = 0 THEN 'failed' ELSE 'success' END AS status,
    CAST(CASE WHEN event_id % 50 = 0 THEN 0 WHEN user_id % 2 = 0 THEN 4096 ELSE 1048576 END AS BIGINT) AS logical_bytes,
    value / 1000.0 AS latency_seconds,
    value AS phase_elapsed_seconds
  FROM events
)
"""

_MS = "COALESCE(" + _R3.format("quantile_cont(latency_seconds, {p}) FILTER (WHERE status = 'success') * 1000") + ", 0.0)"

BENCH_ORACLE = {
    "run_summary": f"WITH {RUN_RECORDS.strip()}\nSELECT query_name, COUNT(*) AS runs, {_ROWS}, {_stats()} FROM ok GROUP BY query_name",
    "layout_summary": f"""WITH {RUN_RECORDS.strip()},
pq AS (SELECT query_name, COUNT(DISTINCT result_sha256) = 1 AS result_consistent FROM ok GROUP BY query_name),
pl AS (SELECT layout, query_name, COUNT(*) AS runs, {_ROWS}, {_stats()} FROM ok GROUP BY layout, query_name)
SELECT pl.layout, pl.query_name, runs, rows_returned, result_consistent, min_seconds, median_seconds, p95_seconds, max_seconds
FROM pl LEFT JOIN pq USING (query_name)""",
    "storage_summary": f"""WITH {STORAGE_RECORDS.strip()},
agg AS (
  SELECT scenario_operation AS operation, object_size_bytes, concurrency, COUNT(*) AS runs,
    COUNT(*) FILTER (WHERE status = 'success') AS successes,
    COALESCE(MAX(phase_elapsed_seconds), 0.0) AS total,
    COALESCE(SUM(logical_bytes) FILTER (WHERE status = 'success'), 0) AS bytes,
    {_MS.format(p=0.5)} AS latency_p50_ms,
    {_MS.format(p=0.95)} AS latency_p95_ms,
    {_MS.format(p=0.99)} AS latency_p99_ms
  FROM st WHERE phase = 'measured' GROUP BY 1, 2, 3
)
SELECT operation, object_size_bytes, concurrency, runs, runs - successes AS errors,
  {_R3.format('total')} AS total_seconds,
  CASE WHEN total > 0 THEN {_R3.format('bytes / 1048576.0 / total')} ELSE 0.0 END AS throughput_mib_s,
  CASE WHEN total > 0 THEN {_R3.format('successes / total')} ELSE 0.0 END AS ops_per_second,
  latency_p50_ms, latency_p95_ms, latency_p99_ms
FROM agg""",
    "percentiles": """
SELECT event_type, COUNT(value) AS n,
  CAST(ROUND(CAST(quantile_cont(value, 0.5) AS DECIMAL(38,9)), 6) AS DOUBLE) AS p50,
  CAST(ROUND(CAST(quantile_cont(value, 0.95) AS DECIMAL(38,9)), 6) AS DOUBLE) AS p95,
  CAST(ROUND(CAST(quantile_cont(value, 0.99) AS DECIMAL(38,9)), 6) AS DOUBLE) AS p99
FROM events GROUP BY event_type""",
    "table_fingerprint": None,
    # A18/P12 on q04: the same normalised JSON lines (keys sorted, numbers rounded to 6
    # places), sorted, newline-terminated and hashed.
    "result_fingerprint": f"""
SELECT CAST(COUNT(*) AS BIGINT) AS rows_returned,
  sha256(string_agg(j, chr(10) ORDER BY j) || chr(10)) AS result_sha256
FROM (
  SELECT to_json(json_object(
    'avg_fare_amount', round(avg_fare_amount, 6), 'avg_total_amount', round(avg_total_amount, 6),
    'avg_trip_distance', round(avg_trip_distance, 6), 'pickup_hour', pickup_hour, 'trip_count', trip_count
  ))::VARCHAR AS j
  FROM ({TRIP_ORACLE["q04_hourly_distance_fare"]}) q04
) lines""",
}
BENCH_ORACLE = {k: v for k, v in BENCH_ORACLE.items() if v is not None}


def _counts() -> str:
    names = [n for n in TRIP_ORACLE if n.startswith(("q0", "smoke_"))]
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS query_name, COUNT(*) AS rows_returned FROM ({TRIP_ORACLE[n]})" for n in names)


def _lineitem_text(*dropped: str) -> str:
    def text(c: str) -> str:
        if c in ("l_discount", "l_extendedprice", "l_quantity", "l_tax"):
            return f"CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)"
        return f"strftime({c}, '%Y-%m-%dT%H:%M:%S')" if c.endswith("date") else f"CAST({c} AS VARCHAR)"

    columns = [text(c) for c in sorted(LINEITEM_COLUMNS) if c not in dropped]
    return " || ".join(f"coalesce(length({c}) || ':' || {c}, '~')" for c in columns)


def _tree() -> str:
    level = f"""l AS (
  SELECT key, COUNT(*) AS n, key || ':' || COUNT(*) AS item
  FROM (SELECT sha256({_lineitem_text("l_orderkey", "l_extendedprice", "l_partkey")}) AS key FROM lineitem) GROUP BY key
)"""
    below, digest = "l", "sha256(string_agg(item, chr(10) ORDER BY item))"
    for digits in TREE_LEVELS[:-1]:
        level += f""",
l{digits} AS (
  SELECT substr(key, 1, {digits}) AS key, SUM(n) AS n, substr(key, 1, {digits}) || ':' || {digest} AS item
  FROM {below} GROUP BY substr(key, 1, {digits})
)"""
        below = f"l{digits}"
    return f"WITH {level}\nSELECT CAST(SUM(n) AS BIGINT) AS row_count, {digest} AS root_sha256 FROM {below}"


BENCH_ORACLE |= {
    "run_records": f"""WITH {RUN_RECORDS.strip()}
SELECT 'events' AS run_id, phase, CAST(event_id % 3 + 1 AS BIGINT) AS iteration, query_name, status,
  CAST(rows_returned AS BIGINT) AS rows_returned, duration_seconds, CASE WHEN status = 'failed' THEN 'boom' END AS error,
  layout, result_sha256 FROM rec""",
    "query_row_counts": _counts(),
    "gold_daily_from_measures": TRIP_ORACLE["gold_daily"],
    "gold_location_from_measures": TRIP_ORACLE["gold_location"],
    "gold_payment_from_measures": TRIP_ORACLE["gold_payment"],
    "table_fingerprint": f"""
SELECT COUNT(*) AS row_count,
  CAST(SUM(CAST(('0x' || substr(sha256({_lineitem_text()}), 1, 15))::BIGINT AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS hash_sum
FROM lineitem""",
    "tree_fingerprint": _tree(),
}
