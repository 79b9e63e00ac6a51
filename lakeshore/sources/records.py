"""Run / layout / storage-operation records: schemas, JSONL source (S8) and the fixture
mapping from the driver's ``events`` table.

The benchmark loops write one JSON line per execution; at cluster scale these logs are
read back with an explicit schema (no inference pass) and summarised by
``lakeshore.operators.stats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("phase", T.StringType()),
    T.StructField("iteration", T.LongType()),
    T.StructField("query_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_returned", T.LongType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("layout", T.StringType()),
    T.StructField("result_sha256", T.StringType()),
])

STORAGE_RECORD_SCHEMA = T.StructType([
    T.StructField("phase", T.StringType()),
    T.StructField("scenario_operation", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("object_size_bytes", T.LongType()),
    T.StructField("concurrency", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("logical_bytes", T.LongType()),
    T.StructField("latency_seconds", T.DoubleType()),
    T.StructField("phase_elapsed_seconds", T.DoubleType()),
])


def read_records(spark: SparkSession, path: str, schema: T.StructType = RUN_RECORD_SCHEMA) -> DataFrame:
    """JSON-lines records with an explicit schema."""
    return spark.read.schema(schema).json(path)


def records_frame(spark: SparkSession, records: list[dict], schema: T.StructType = RUN_RECORD_SCHEMA) -> DataFrame:
    """Records produced by one driver-side benchmark loop (small by construction)."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


# Fixture mapping (events -> records).  Fixed values of the fixture specification:
# one event type returns a varying row count, another a layout-dependent result hash.
INCONSISTENT_ROWS_TYPE = "error"
SALTED_HASH_TYPE = "click"


def run_records(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    layout = F.concat(F.lit("layout_"), (F.col("user_id") % 2).cast("string"))
    failed = eid % 50 == 0
    rows = F.when(F.col("event_type") == INCONSISTENT_ROWS_TYPE, 10 + eid % 2).otherwise(
        F.length("event_type").cast("bigint") * 4
    )
    digest_in = F.when(F.col("event_type") == SALTED_HASH_TYPE, F.concat("event_type", layout)).otherwise(
        F.col("event_type")
    )
    return events.select(
        F.lit("events").alias("run_id"),
        F.when(eid % 4 == 0, "warmup").otherwise("measured").alias("phase"),
        (eid % 3 + 1).alias("iteration"),
        F.col("event_type").alias("query_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.lit(None).cast("bigint")).otherwise(rows.cast("bigint")).alias("rows_returned"),
        F.col("value").alias("duration_seconds"),
        F.when(failed, F.lit("boom")).alias("error"),
        layout.alias("layout"),
        F.when(failed, F.lit("")).otherwise(F.sha2(digest_in, 256)).alias("result_sha256"),
    )


def storage_records(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    op = F.element_at(F.array(F.lit("put"), F.lit("get"), F.lit("mixed")), (eid % 3 + 1).cast("int"))
    size = F.when(F.col("user_id") % 2 == 0, F.lit(4096)).otherwise(F.lit(1048576)).cast("bigint")
    failed = eid % 50 == 0
    return events.select(
        F.when(eid % 4 == 0, "warmup").otherwise("measured").alias("phase"),
        op.alias("scenario_operation"),
        F.when((op == "mixed") & (eid % 10 < 3), "get").when(op == "mixed", "put").otherwise(op).alias("operation"),
        size.alias("object_size_bytes"),
        F.when(F.col("user_id") % 4 < 2, F.lit(1)).otherwise(F.lit(4)).cast("bigint").alias("concurrency"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.lit(0)).otherwise(size).cast("bigint").alias("logical_bytes"),
        (F.col("value") / 1000.0).alias("latency_seconds"),
        F.col("value").alias("phase_elapsed_seconds"),
    )
