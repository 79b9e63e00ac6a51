"""Independent ANSI SQL (DuckDB dialect) for every registered query.

The driver runs these next to the Spark queries on the same Parquet tables; they are
written from the operator semantics, not generated from the Spark plans.  Sums use
exact DECIMAL on both sides; DuckDB ``SUM(BIGINT)`` (HUGEINT) and ``HOUR`` (BIGINT)
are cast back to Spark's types.
"""

from __future__ import annotations

_SECS = "to_seconds((l_partkey * 9973 + l_suppkey * 131) % 86400)"

RAW_CTE = f"""
raw AS (
  SELECT l_linenumber AS src_line,
    o_orderdate + {_SECS} AS tpep_pickup_datetime,
    l_shipdate + {_SECS} AS tpep_dropoff_datetime,
    CASE WHEN l_partkey % 55 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
    l_quantity AS trip_distance,
    l_suppkey AS PULocationID,
    l_partkey % 265 + 1 AS DOLocationID,
    CASE WHEN l_partkey % 70 = 0 THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS payment_type,
    CASE WHEN l_partkey % 25 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS tip_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 + l_tax AS DECIMAL(4,2)) AS DOUBLE) AS total_amount,
    l_tax AS airport_fee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
typed AS (
  SELECT src_line, airport_fee,
    tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime,
    CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
    trip_distance,
    CAST(PULocationID AS INTEGER) AS pu_location_id,
    CAST(DOLocationID AS INTEGER) AS do_location_id,
    CAST(payment_type AS INTEGER) AS payment_type,
    fare_amount, tip_amount, total_amount,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date
  FROM raw
),
src AS (
  SELECT *, 'A' AS src FROM typed WHERE src_line <= 5
  UNION ALL
  SELECT *, 'B' AS src FROM typed WHERE src_line >= 4
),
labelled AS (
  SELECT *, CASE
    WHEN pickup_datetime IS NULL THEN 'null_pickup_datetime'
    WHEN dropoff_datetime IS NULL THEN 'null_dropoff_datetime'
    WHEN NOT coalesce(dropoff_datetime > pickup_datetime, false) THEN 'dropoff_not_after_pickup'
    WHEN pickup_date IS NULL THEN 'null_pickup_date'
    WHEN NOT coalesce(trip_distance >= 0, false) THEN 'invalid_trip_distance'
    WHEN NOT coalesce(fare_amount >= 0, false) THEN 'invalid_fare_amount'
    WHEN NOT coalesce(tip_amount >= 0, false) THEN 'invalid_tip_amount'
    WHEN NOT coalesce(total_amount >= 0, false) THEN 'invalid_total_amount'
  END AS reason
  FROM src
),
valid AS (SELECT * FROM labelled WHERE reason IS NULL),
silver AS (
  SELECT pickup_datetime, dropoff_datetime, passenger_count, trip_distance, pu_location_id,
         do_location_id, payment_type, fare_amount, tip_amount, total_amount, pickup_date
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY pickup_datetime, dropoff_datetime, pu_location_id, do_location_id,
                   passenger_count, trip_distance, total_amount
      ORDER BY payment_type NULLS FIRST, fare_amount NULLS FIRST, tip_amount NULLS FIRST) AS rn
    FROM valid
  ) WHERE rn = 1
),
daily_trip_metrics AS (
  SELECT pickup_date, COUNT(*) AS trip_count,
    CAST(SUM(CAST(total_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue,
    CAST(SUM(CAST(fare_amount AS DECIMAL(38,10))) AS DOUBLE) AS fare_revenue,
    CAST(SUM(CAST(tip_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_tip,
    CAST(SUM(CAST(trip_distance AS DECIMAL(38,10))) AS DOUBLE) / nullif(COUNT(trip_distance), 0) AS avg_trip_distance,
    CAST(SUM(passenger_count) AS DOUBLE) / nullif(COUNT(passenger_count), 0) AS avg_passenger_count
  FROM silver GROUP BY pickup_date
),
location_metrics AS (
  SELECT pickup_date, pu_location_id, do_location_id, COUNT(*) AS trip_count,
    CAST(SUM(CAST(total_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue,
    CAST(SUM(CAST(trip_distance AS DECIMAL(38,10))) AS DOUBLE) / nullif(COUNT(trip_distance), 0) AS avg_trip_distance
  FROM silver GROUP BY pickup_date, pu_location_id, do_location_id
),
payment_metrics AS (
  SELECT pickup_date, payment_type, COUNT(*) AS trip_count,
    CAST(SUM(CAST(total_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue,
    CAST(SUM(CAST(fare_amount AS DECIMAL(38,10))) AS DOUBLE) AS fare_revenue,
    CAST(SUM(CAST(tip_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_tip,
    CAST(SUM(CAST(tip_amount AS DECIMAL(38,10))) AS DOUBLE) / nullif(COUNT(tip_amount), 0) AS avg_tip_amount
  FROM silver GROUP BY pickup_date, payment_type
)
"""


def _with(body: str) -> str:
    return "WITH " + RAW_CTE.strip() + "\n" + body.strip()


TRIP_ORACLE = {
    "silver_trips": _with("SELECT * FROM silver"),
    "rejection_report": _with("""
SELECT reason, CAST(COUNT(*) AS BIGINT) AS row_count FROM labelled WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'kept', (SELECT COUNT(*) FROM silver)
UNION ALL SELECT 'duplicate', (SELECT COUNT(*) FROM valid) - (SELECT COUNT(*) FROM silver)
"""),
    "silver_union_drift": _with("""
SELECT pickup_datetime, dropoff_datetime, passenger_count, trip_distance, pu_location_id, do_location_id,
       payment_type, fare_amount, tip_amount, total_amount, pickup_date,
       CASE WHEN src = 'B' THEN airport_fee END AS airport_fee
FROM valid
"""),
    "silver_type_drift": _with("""
SELECT pickup_datetime, dropoff_datetime, passenger_count, trip_distance, pu_location_id, do_location_id,
       payment_type, fare_amount, tip_amount, total_amount, pickup_date,
       CAST(pu_location_id AS VARCHAR) AS zone, CAST(do_location_id AS DOUBLE) AS fee,
       CAST(do_location_id AS VARCHAR) AS level, CASE WHEN src_line > 5 THEN 'late ' || pu_location_id END AS note,
       CAST(pu_location_id AS VARCHAR) AS tag, CAST(pu_location_id AS BIGINT) AS prop
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY pickup_datetime, dropoff_datetime, pu_location_id, do_location_id, passenger_count, trip_distance, total_amount) AS rn
  FROM valid
) WHERE rn = 1
"""),
    "gold_daily": _with("SELECT * FROM daily_trip_metrics"),
    "gold_location": _with("SELECT * FROM location_metrics"),
    "gold_payment": _with("SELECT * FROM payment_metrics"),
    "date_params": _with("""
SELECT CAST(MIN(pickup_date) AS VARCHAR) AS start_date, CAST(MAX(pickup_date) AS VARCHAR) AS end_date,
       CAST(MIN(pickup_date) AS VARCHAR) AS pickup_date FROM daily_trip_metrics
"""),
    "q01_daily_revenue": _with("""
SELECT pickup_date, trip_count, total_revenue, fare_revenue, total_tip FROM daily_trip_metrics ORDER BY pickup_date
"""),
    "q02_top_pickup_locations": _with("""
SELECT pickup_date, pu_location_id, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
       CAST(SUM(CAST(total_revenue AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue
FROM location_metrics
WHERE pickup_date BETWEEN (SELECT MIN(pickup_date) FROM silver) AND (SELECT MAX(pickup_date) FROM silver)
GROUP BY pickup_date, pu_location_id
ORDER BY trip_count DESC, pickup_date, pu_location_id
LIMIT 10
"""),
    "q03_avg_tip_by_payment": _with("""
SELECT payment_type, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
       CAST(SUM(CAST(total_tip AS DECIMAL(38,10))) AS DOUBLE) / CAST(SUM(trip_count) AS BIGINT) AS avg_tip_per_trip,
       CAST(SUM(CAST(total_revenue AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue
FROM payment_metrics GROUP BY payment_type ORDER BY payment_type
"""),
    "q04_hourly_distance_fare": _with("""
SELECT CAST(HOUR(pickup_datetime) AS INTEGER) AS pickup_hour, COUNT(*) AS trip_count,
       CAST(SUM(CAST(trip_distance AS DECIMAL(38,10))) AS DOUBLE) / COUNT(trip_distance) AS avg_trip_distance,
       CAST(SUM(CAST(fare_amount AS DECIMAL(38,10))) AS DOUBLE) / COUNT(fare_amount) AS avg_fare_amount,
       CAST(SUM(CAST(total_amount AS DECIMAL(38,10))) AS DOUBLE) / COUNT(total_amount) AS avg_total_amount
FROM silver GROUP BY 1 ORDER BY 1
"""),
    "q05_selective_pickup_date": _with("""
SELECT pickup_date, COUNT(*) AS trip_count,
       CAST(SUM(CAST(total_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue,
       CAST(SUM(CAST(trip_distance AS DECIMAL(38,10))) AS DOUBLE) / COUNT(trip_distance) AS avg_trip_distance
FROM silver WHERE pickup_date = (SELECT MIN(pickup_date) FROM daily_trip_metrics)
GROUP BY pickup_date
"""),
    "q06_full_scan_location_aggregation": _with("""
SELECT pu_location_id, do_location_id, COUNT(*) AS trip_count,
       CAST(SUM(CAST(total_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue,
       CAST(SUM(CAST(trip_distance AS DECIMAL(38,10))) AS DOUBLE) / COUNT(trip_distance) AS avg_trip_distance
FROM silver GROUP BY pu_location_id, do_location_id
ORDER BY trip_count DESC, pu_location_id, do_location_id
LIMIT 20
"""),
    "smoke_totals": _with("""
SELECT COUNT(*) AS daily_rows, CAST(SUM(trip_count) AS BIGINT) AS total_trips,
       CAST(ROUND(SUM(CAST(total_revenue AS DECIMAL(38,10))), 2) AS DOUBLE) AS total_revenue
FROM daily_trip_metrics
"""),
    "smoke_daily": _with("""
SELECT pickup_date, trip_count, CAST(ROUND(CAST(total_revenue AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_revenue
FROM daily_trip_metrics ORDER BY pickup_date LIMIT 10
"""),
    "smoke_tip": _with("""
SELECT payment_type, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
       CAST(ROUND(CAST(CAST(SUM(CAST(total_tip AS DECIMAL(38,10))) AS DOUBLE) / CAST(SUM(trip_count) AS BIGINT)
                  AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_tip_per_trip
FROM payment_metrics GROUP BY payment_type ORDER BY payment_type
"""),
}
