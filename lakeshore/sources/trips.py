"""Raw trip sources (bronze) built from the driver tables.

The driver ships TPC-H-like tables, not taxi files, so this adapter derives two
overlapping raw trip "files" with the raw column names (``tpep_*``, ``PULocationID`` ...)
from ``lineitem JOIN orders``.  Source A holds lines 1-5, source B lines 4-7: lines
4-5 are exact cross-file duplicates, and B carries the usual schema drift
(``passenger_count`` stored as BIGINT, one extra column).

Scale note: the join is left to Catalyst (sort-merge on ``l_orderkey``; AQE turns it
into a broadcast only when the runtime size of ``orders`` is under the broadcast
threshold).  Which sources a line belongs to is decided after the join, so both sources, and
all uses of them in one query, have the same join inputs: Spark shuffles each table once and
reads that shuffle again.  Line filters pushed into the ``lineitem`` scan would make every
source shuffle its own rows, lines 4-5 twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.sources.tables import read_table

# Fixed values of the fixture specification.
SOURCE_A_MAX_LINE = 5
SOURCE_B_MIN_LINE = 4
SECONDS_PER_DAY = 86400


def _offset_seconds() -> Column:
    # Deterministic time of day that covers all 24 hours.
    return (F.col("l_partkey") * 9973 + F.col("l_suppkey") * 131) % SECONDS_PER_DAY


def _money(price: Column, factor: Column) -> Column:
    # Exact decimal product, so both engines agree to the cent.
    return (price.cast("decimal(12,2)") * factor.cast("decimal(4,2)")).cast("double")


def _of_source(joined: DataFrame, source: str) -> DataFrame:
    """The joined lines of source ``A`` or ``B``."""
    line = F.col("l_linenumber")
    in_a, in_b = line <= SOURCE_A_MAX_LINE, line >= SOURCE_B_MIN_LINE
    held_by = F.when(in_a & in_b, F.array(F.lit("A"), F.lit("B"))).when(in_a, F.array(F.lit("A"))).when(in_b, F.array(F.lit("B")))
    return joined.withColumn("_source", F.explode(held_by)).where(F.col("_source") == source)


def raw_trip_lines(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The raw trips of one source with ``src_line`` (the line number that tells the sources)."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner")
    joined = _of_source(joined, source)
    offset = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _offset_seconds())
    partkey = F.col("l_partkey")
    return joined.select(
        F.col("l_linenumber").alias("src_line"),
        (F.col("o_orderdate") + offset).alias("tpep_pickup_datetime"),
        (F.col("l_shipdate") + offset).alias("tpep_dropoff_datetime"),
        F.when(partkey % 55 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_linenumber").cast("double")).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_suppkey").alias("PULocationID"),
        (partkey % 265 + 1).alias("DOLocationID"),
        F.when(partkey % 70 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.substring("o_orderpriority", 1, 1).cast("bigint")).alias("payment_type"),
        F.when(partkey % 25 == 0, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice")).alias("fare_amount"),
        _money(F.col("l_extendedprice"), F.col("l_discount")).alias("tip_amount"),
        _money(F.col("l_extendedprice"), F.lit(1) + F.col("l_tax")).alias("total_amount"),
        F.col("l_tax").alias("_tax"),
    )


def raw_source_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source A: lines 1..5, the reference raw schema (passenger_count as DOUBLE)."""
    return raw_trip_lines(spark, sf_dir, "A").drop("src_line", "_tax")


def raw_source_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source B: lines 4.., drifted schema (passenger_count BIGINT, extra ``airport_fee``)."""
    return (
        raw_trip_lines(spark, sf_dir, "B")
        .withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        .withColumnRenamed("_tax", "airport_fee")
        .drop("src_line")
    )


def drifted_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Sources A and B whose carried columns differ in type, case and nested fields; the
    lines that both hold have equal values in them."""
    pickup, dropoff = F.col("PULocationID"), F.col("DOLocationID")
    a = raw_trip_lines(spark, sf_dir, "A").select(
        "*", pickup.cast("int").alias("Zone"), dropoff.cast("int").alias("fee"), F.lit("not a date").alias("Pickup_Date"),
        F.struct(dropoff.cast("int").alias("level")).alias("info"), F.array(pickup.cast("int")).alias("tags"),
        F.create_map(F.lit("pickup"), pickup.cast("int")).alias("props"))
    late = F.when(F.col("src_line") > SOURCE_A_MAX_LINE, F.concat(F.lit("late "), pickup))
    b = raw_trip_lines(spark, sf_dir, "B").select(
        "*", pickup.cast("string").alias("zone"), dropoff.cast("double").alias("Fee"),
        F.struct(late.alias("note"), dropoff.cast("string").alias("Level")).alias("info"), F.array(pickup.cast("string")).alias("tags"),
        F.create_map(F.lit("pickup"), pickup.cast("bigint")).alias("props"))
    return [df.drop("src_line", "_tax") for df in (a, b)]


def raw_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [raw_source_a(spark, sf_dir), raw_source_b(spark, sf_dir)]
