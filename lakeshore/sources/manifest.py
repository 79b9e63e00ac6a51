"""Manifest file rows derived from the driver's ``documents`` table (fixture for S5, J1,
J2, A19): every ``source`` becomes one monthly trip file.

Size = sum of ``n_chars``, rows = document count, checksum = SHA-256 of a bounded
per-source digest (count, sizes, id sum) -- an aggregate, never a list of the group's
rows.  The ``actual`` (already stored) side drops every third file and alters the
checksum of every seventh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.text import bronze_key, object_uri, trip_file_name

# Fixed values of the fixture.
BRONZE_BUCKET = "bronze"
FIRST_MONTH = "2023-01-01"


def manifest_file_rows(documents: DataFrame) -> DataFrame:
    per_source = documents.groupBy("source").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("n_chars").alias("size_bytes"),
        F.sum("doc_id").alias("_id_sum"),
    )
    n = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    month_date = F.add_months(F.lit(FIRST_MONTH).cast("date"), n)
    year, month = F.date_format(month_date, "yyyy"), F.date_format(month_date, "MM")
    name = trip_file_name(F.lit("yellow"), F.date_format(month_date, "yyyy-MM"))
    key = bronze_key(year, month, name)
    return per_source.select(
        n.alias("file_no"),
        F.lit("source").alias("role"),
        F.lit("parquet").alias("format"),
        name.alias("file_name"),
        F.lit("yellow").alias("taxi_type"),
        year.alias("year"),
        month.alias("month"),
        "row_count",
        "size_bytes",
        F.sha2(F.concat_ws(":", "source", F.col("row_count").cast("string"), F.col("size_bytes").cast("string"),
                           F.col("_id_sum").cast("string")), 256).alias("checksum_sha256"),
        key.alias("bronze_key"),
        object_uri(F.lit(BRONZE_BUCKET), key, scheme="s3").alias("bronze_uri"),
    )


def stored_object_rows(expected: DataFrame) -> DataFrame:
    """The 'actual' side: every third file missing, every seventh with another checksum."""
    return expected.where(F.col("file_no") % 3 != 0).withColumn(
        "checksum_sha256",
        F.when(F.col("file_no") % 7 == 0, F.sha2(F.concat("checksum_sha256", F.lit("x")), 256)).otherwise(
            F.col("checksum_sha256")
        ),
    )


def manifest_document(files: DataFrame, generated_at: str) -> DataFrame:
    """Nested manifests (one per taxi type) built from file rows, as read by S5."""
    return files.groupBy("taxi_type").agg(
        F.sort_array(F.collect_list(F.struct(*[c for c in files.columns]))).alias("files")
    ).select(
        F.lit("nyc_taxi_manifest_v1").alias("manifest_version"),
        F.lit(generated_at).alias("generated_at"),
        F.lit("nyc_taxi").alias("dataset"),
        "taxi_type",
        F.lit("scale").alias("year"),
        F.lit("batch").alias("month"),
        F.lit(BRONZE_BUCKET).alias("bronze_bucket"),
        "files",
    )
