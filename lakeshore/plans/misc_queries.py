"""Registered generator and metric time-series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshore.operators import generate
from lakeshore.sources.metric_samples import counter_samples, gauge_samples, up_samples
from lakeshore.sources.tables import read_table
from lakeshore.streaming import metrics

GEN_DAYS = 7
GEN_SEED = 42
RATE_WINDOW = "5 minutes"


def _synthetic(spark, sf_dir):
    """One synthetic trip per event (record index = event_id)."""
    idx = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("idx"))
    return generate.generate_from_index(idx, GEN_DAYS, GEN_SEED)


def q_synthetic_trips(spark, sf_dir):
    return _synthetic(spark, sf_dir)


def q_quality_counts(spark, sf_dir):
    return generate.quality_counts(_synthetic(spark, sf_dir))


def q_latest_gauge(spark, sf_dir):
    return metrics.latest_values(gauge_samples(read_table(spark, sf_dir, "events")))


def q_latest_gauge_by_job(spark, sf_dir):
    """``{job=~"..."}``: 'view' and 'click' match as a whole, 'iew' is no job."""
    return metrics.latest_values(gauge_samples(read_table(spark, sf_dir, "events")), job_pattern="view|click|iew|sign")


def q_rate_by_label(spark, sf_dir):
    samples = counter_samples(read_table(spark, sf_dir, "events"))
    return metrics.rate_by(samples, RATE_WINDOW, "series_label", acc_type="decimal(38,2)")


def q_rate_total(spark, sf_dir):
    samples = counter_samples(read_table(spark, sf_dir, "events"))
    return metrics.rate_by(samples, RATE_WINDOW, None, acc_type="decimal(38,2)")


def q_down_targets(spark, sf_dir):
    return metrics.down_targets(up_samples(read_table(spark, sf_dir, "events")), "view|click|error|purch")


def q_down_targets_all(spark, sf_dir):
    return metrics.down_targets(up_samples(read_table(spark, sf_dir, "events")), ".*")


QUERIES = {
    "synthetic_trips": q_synthetic_trips,
    "quality_counts": q_quality_counts,
    "latest_gauge": q_latest_gauge,
    "latest_gauge_by_job": q_latest_gauge_by_job,
    "rate_by_label": q_rate_by_label,
    "rate_total": q_rate_total,
    "down_targets": q_down_targets,
    "down_targets_all": q_down_targets_all,
}

_LATEST = """
SELECT event_type AS metric, CAST(user_id % 5 AS VARCHAR) AS series_label, MAX(ts) AS ts, arg_max(value, ts) AS value
FROM events {where} GROUP BY 1, 2"""

_INCREASES = """
WITH s AS (
  SELECT event_type AS metric, CAST(user_id % 5 AS VARCHAR) AS series_label, ts,
    SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type, user_id % 5, event_id // 100 ORDER BY event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
  FROM events
), p AS (SELECT *, lag(v) OVER (PARTITION BY metric, series_label ORDER BY ts, v) AS pv FROM s),
d AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, series_label,
    CASE WHEN pv IS NULL THEN 0 WHEN v >= pv THEN v - pv ELSE v END AS d
  FROM p
)
"""

_DOWN = """
WITH up AS (
  SELECT event_type AS job, CAST(user_id % 5 AS VARCHAR) AS instance, ts,
    CASE WHEN value < 5 THEN 0.0 ELSE 1.0 END AS value
  FROM events {where}
), l AS (SELECT job, instance, arg_max(value, ts) AS value FROM up GROUP BY ALL)
SELECT COUNT(*) AS targets, COUNT(*) FILTER (WHERE value = 0) AS down_targets FROM l"""

def _generated() -> str:
    """The generator's definition again: SHA-256 digits, cents, cases."""
    def u(field: str) -> str:
        digest, place = divmod(generate.FIELDS.index(field), generate.NUMBERS)
        return f"CAST(('0x' || substr(d{digest}, {place * generate.NUMBER_STEP + 1}, {generate.NUMBER_DIGITS}))::BIGINT AS DOUBLE) / {16**generate.NUMBER_DIGITS}.0::DOUBLE"

    def uniform(field: str, lo: float, hi: float) -> str:
        return f"({lo}::DOUBLE + {u(field)} * {hi - lo!r}::DOUBLE)"

    def randrange(field: str, lo: int, hi: int) -> str:
        return f"CAST({lo} + floor({u(field)} * {hi - lo}::DOUBLE) AS INTEGER)"

    def cents(text: str) -> str:
        return f"floor(({text}) * 100::DOUBLE + 0.5::DOUBLE) / 100::DOUBLE"

    rules = " ".join(f"WHEN event_id > 0 AND event_id % {m} = 0 THEN '{name}'" for m, name in generate.QUALITY_RULES)
    digests = ", ".join(f"sha256('{GEN_SEED}:' || src || ':{k}') AS d{k}" for k in range(-(-len(generate.FIELDS) // generate.NUMBERS)))
    stamp = "strftime({}, '%Y-%m-%dT%H:%M:%S+00:00')"
    return f"""
WITH q AS (SELECT event_id, CASE {rules} ELSE 'valid' END AS quality_case FROM events),
s AS (SELECT *, CASE quality_case WHEN 'duplicate_candidate' THEN event_id - 1 ELSE event_id END AS src FROM q),
r AS (SELECT *, {digests} FROM s),
t AS (
  SELECT *, TIMESTAMP '{generate.BASE_TIMESTAMP}' + to_days(CAST(src % {GEN_DAYS} AS INTEGER)) + to_minutes((src * 17) % 1440)
      + to_seconds({randrange("sec", 0, 60)}) AS pickup,
    {cents(uniform("dist", 0.4, 35.0))} AS distance
  FROM r
),
f AS (SELECT *, {cents("3.0::DOUBLE + distance * " + uniform("rate", 2.1, 4.5))} AS fare FROM t),
g AS (SELECT *, {cents("fare * " + uniform("tip", 0.0, 0.3))} AS tip FROM f)
SELECT printf('synthetic-%08d', src) AS record_id, {stamp.format("pickup")} AS pickup_datetime,
  {stamp.format(f"CASE quality_case WHEN 'bad_timestamp' THEN pickup - INTERVAL 5 MINUTE ELSE pickup + to_minutes({randrange('dur', 4, 61)}) END")} AS dropoff_datetime,
  CASE quality_case WHEN 'null_passenger_count' THEN '' ELSE CAST({randrange("pax", 1, 7)} AS VARCHAR) END AS passenger_count,
  distance AS trip_distance, {randrange("pu", 1, 266)} AS pickup_location_id, {randrange("do", 1, 266)} AS dropoff_location_id,
  {list(generate.PAYMENT_CHOICES)}[{randrange("pay", 1, 6)}] AS payment_type,
  CASE quality_case WHEN 'negative_amount' THEN -abs(fare) ELSE fare END AS fare_amount, tip AS tip_amount,
  CASE quality_case WHEN 'negative_amount' THEN {cents("-abs(fare) + tip")} ELSE {cents("fare + tip + " + uniform("extra", 0.5, 5.0))} END AS total_amount,
  quality_case, event_id AS record_index
FROM g"""


ORACLE = {
    "synthetic_trips": _generated(),
    "quality_counts": """
SELECT CASE WHEN event_id > 0 AND event_id % 25 = 0 THEN 'negative_amount'
            WHEN event_id > 0 AND event_id % 40 = 0 THEN 'bad_timestamp'
            WHEN event_id > 0 AND event_id % 55 = 0 THEN 'null_passenger_count'
            WHEN event_id > 0 AND event_id % 70 = 0 THEN 'duplicate_candidate'
            ELSE 'valid' END AS quality_case, COUNT(*) AS records
FROM events GROUP BY 1""",
    "latest_gauge": _LATEST.format(where=""),
    "latest_gauge_by_job": _LATEST.format(where="WHERE event_type IN ('view', 'click')"),
    "rate_by_label": _INCREASES + "SELECT window_start, series_label, CAST(SUM(d) AS DOUBLE) / 300.0 AS rate FROM d GROUP BY ALL",
    "rate_total": _INCREASES + "SELECT window_start, CAST(SUM(d) AS DOUBLE) / 300.0 AS rate FROM d GROUP BY ALL",
    "down_targets": _DOWN.format(where="WHERE event_type IN ('view', 'click', 'error')"),
    "down_targets_all": _DOWN.format(where=""),
}
