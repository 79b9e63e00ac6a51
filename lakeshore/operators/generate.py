"""Deterministic synthetic trip records with labelled quality cases.

Randomness is counter-based: digits of SHA-256 over (seed, record index), four numbers of
52 bits from a digest.  Every row is computed independently, so the output is identical for
any partitioning, executor count or retry -- no driver-side RNG stream, no ordering -- and
any engine with SHA-256 computes the same values.

Quality cases (G2), first match wins, for index > 0:
``% 25`` negative_amount, ``% 40`` bad_timestamp, ``% 55`` null_passenger_count,
``% 70`` duplicate_candidate (a real copy of the previous trip's values, so it is a
duplicate on the seven trip keys, T21), else valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generator.
SCHEMA_VERSION = "synthetic_trip_v1"
MANIFEST_VERSION = "synthetic_tabular_manifest_v1"
BASE_TIMESTAMP = "2025-01-01 00:00:00"
PAYMENT_CHOICES = (1, 1, 1, 2, 3)
QUALITY_RULES = (
    (25, "negative_amount"),
    (40, "bad_timestamp"),
    (55, "null_passenger_count"),
    (70, "duplicate_candidate"),
)
#: The random fields of a record, in the order of their numbers.
FIELDS = ("sec", "dur", "dist", "rate", "tip", "extra", "pay", "pax", "pu", "do")
#: Hex digits of a number, the distance of two numbers in a digest, and numbers a digest.
NUMBER_DIGITS, NUMBER_STEP, NUMBERS = 13, 16, 4
_RANGE = float(16**NUMBER_DIGITS)


def _u(seed: int, idx: Column, field: str) -> Column:
    """Uniform [0, 1) from (seed, index, field): digits of sha256("seed:index:digest")."""
    digest, place = divmod(FIELDS.index(field), NUMBERS)
    text = F.sha2(F.concat_ws(":", F.lit(str(seed)), idx.cast("string"), F.lit(str(digest))), 256)
    return F.conv(F.substring(text, place * NUMBER_STEP + 1, NUMBER_DIGITS), 16, 10).cast("bigint").cast("double") / _RANGE


def _uniform(seed, idx, field, lo, hi) -> Column:
    return F.lit(lo) + _u(seed, idx, field) * F.lit(hi - lo)


def _randrange(seed, idx, field, lo, hi) -> Column:
    """Integer in [lo, hi)."""
    return (F.lit(lo) + F.floor(_u(seed, idx, field) * F.lit(float(hi - lo)))).cast("int")


def _cents(value: Column) -> Column:
    """Rounded to cents in plain double arithmetic, which is the same everywhere."""
    return F.floor(value * F.lit(100.0) + F.lit(0.5)).cast("double") / F.lit(100.0)


def quality_case(idx: Column) -> Column:
    expr = F.lit("valid")
    for mod, name in reversed(QUALITY_RULES):
        expr = F.when((idx > 0) & (idx % mod == 0), F.lit(name)).otherwise(expr)
    return expr


def generate_from_index(index: DataFrame, days: int, seed: int, index_col: str = "idx") -> DataFrame:
    """G1+G2 over any DataFrame of record indexes (e.g. ``spark.range(rows)``)."""
    if days < 1:
        raise ValueError("days must be >= 1")
    i = F.col(index_col).cast("bigint")
    case = quality_case(i)
    # Duplicates re-draw the previous record's trip, making them key-duplicates.
    src = F.when(case == "duplicate_candidate", i - 1).otherwise(i)
    pickup = (
        F.lit(BASE_TIMESTAMP).cast("timestamp_ntz")
        + F.make_dt_interval(src % days, F.lit(0), (src * 17) % 1440, _randrange(seed, src, "sec", 0, 60))
    )
    dropoff = pickup + F.make_dt_interval(F.lit(0), F.lit(0), _randrange(seed, src, "dur", 4, 61), F.lit(0))
    distance = _cents(_uniform(seed, src, "dist", 0.4, 35.0))
    fare = _cents(F.lit(3.0) + distance * _uniform(seed, src, "rate", 2.1, 4.5))
    tip = _cents(fare * _uniform(seed, src, "tip", 0.0, 0.3))
    total = _cents(fare + tip + _uniform(seed, src, "extra", 0.5, 5.0))
    payment = F.element_at(F.array(*[F.lit(p) for p in PAYMENT_CHOICES]), _randrange(seed, src, "pay", 1, 6))
    neg = case == "negative_amount"
    out = index.select(
        F.format_string("synthetic-%08d", src).alias("record_id"),
        F.date_format(pickup, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("pickup_datetime"),
        F.date_format(
            F.when(case == "bad_timestamp", pickup - F.expr("INTERVAL 5 MINUTES")).otherwise(dropoff),
            "yyyy-MM-dd'T'HH:mm:ss'+00:00'",
        ).alias("dropoff_datetime"),
        F.when(case == "null_passenger_count", F.lit("")).otherwise(
            _randrange(seed, src, "pax", 1, 7).cast("string")).alias("passenger_count"),
        distance.alias("trip_distance"),
        _randrange(seed, src, "pu", 1, 266).alias("pickup_location_id"),
        _randrange(seed, src, "do", 1, 266).alias("dropoff_location_id"),
        payment.alias("payment_type"),
        F.when(neg, -F.abs(fare)).otherwise(fare).alias("fare_amount"),
        tip.alias("tip_amount"),
        F.when(neg, _cents(-F.abs(fare) + tip)).otherwise(total).alias("total_amount"),
        case.alias("quality_case"),
        i.alias("record_index"),
    )
    return out


def generate_records(spark: SparkSession, rows: int, days: int, seed: int) -> DataFrame:
    """G1: ``rows`` records spread over ``days`` days (``rows``, ``days`` >= 1)."""
    if rows < 1:
        raise ValueError("rows must be >= 1")
    return generate_from_index(spark.range(rows).withColumnRenamed("id", "idx"), days, seed)


def quality_counts(records: DataFrame) -> DataFrame:
    """Records per quality case."""
    return records.groupBy("quality_case").agg(F.count(F.lit(1)).alias("records"))


def to_raw_trips(records: DataFrame) -> DataFrame:
    """Map generated records to the raw trip-file contract so B1 can ingest them."""
    return records.select(
        F.to_timestamp_ntz(F.substring("pickup_datetime", 1, 19)).alias("tpep_pickup_datetime"),
        F.to_timestamp_ntz(F.substring("dropoff_datetime", 1, 19)).alias("tpep_dropoff_datetime"),
        F.nullif(F.col("passenger_count"), F.lit("")).try_cast("double").alias("passenger_count"),
        F.col("trip_distance"),
        F.col("pickup_location_id").alias("PULocationID"),
        F.col("dropoff_location_id").alias("DOLocationID"),
        F.col("payment_type").cast("bigint").alias("payment_type"),
        "fare_amount", "tip_amount", "total_amount",
        F.col("record_id"),
    )
