"""Registered manifest / inventory / ingest-plan / text-function queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakeshore.functions import text as tx
from lakeshore.operators import inventory
from lakeshore.sources.manifest import manifest_document, manifest_file_rows, stored_object_rows
from lakeshore.sources.tables import TABLES, read_table

# Fixed values of the size-text fixture (index = doc_id % 9); 'XB' is not a unit.
SIZE_SUFFIXES = ("", "b", "KiB", "kb", "MiB", "MB", "GiB", "GB", "XB")
DOWNLOAD_BASE = "https://downloads.example.org/trip-data"


def _files(spark, sf_dir):
    return manifest_file_rows(read_table(spark, sf_dir, "documents"))


def q_manifest_files(spark, sf_dir):
    """File rows with parsed names, source URIs and download URLs."""
    f = _files(spark, sf_dir)
    parsed = tx.parse_trip_file_name("file_name")
    return f.select(
        "file_no", "file_name", "year", "month", "row_count", "size_bytes", "checksum_sha256",
        "bronze_key", "bronze_uri",
        tx.object_uri(F.lit("bronze"), F.col("bronze_key")).alias("source_uri"),
        tx.download_url(DOWNLOAD_BASE, F.col("file_name")).alias("url"),
        parsed["valid"].alias("name_valid"),
    )


def q_manifest_rollup(spark, sf_dir):
    return inventory.manifest_rollup(_files(spark, sf_dir))


def q_ingest_plan(spark, sf_dir):
    expected = _files(spark, sf_dir)
    return inventory.ingest_plan(expected, stored_object_rows(expected))


def q_manifest_diff(spark, sf_dir):
    expected = _files(spark, sf_dir).withColumn("generated_at", F.lit("2025-01-01T00:00:00+00:00"))
    actual = stored_object_rows(_files(spark, sf_dir)).withColumn("generated_at", F.lit("2025-02-01T00:00:00+00:00"))
    cols = ["file_name", "size_bytes", "checksum_sha256", "generated_at"]
    return inventory.manifest_differences(expected.select(*cols), actual.select(*cols))


def q_duplicate_texts(spark, sf_dir):
    """U3 over whole document texts, keyed by their SHA-256."""
    docs = read_table(spark, sf_dir, "documents").select(tx.sha256_hex("text").alias("text_sha256"))
    return inventory.duplicate_keys(docs, "text_sha256")


def q_checksums(spark, sf_dir):
    """SHA-256 and byte length of every document text."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.sha256_hex("text").alias("sha256"), F.octet_length("text").cast("bigint").alias("bytes"))


def q_size_parse(spark, sf_dir):
    """F6 over size texts built from documents."""
    docs = read_table(spark, sf_dir, "documents")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SIZE_SUFFIXES]), (F.col("doc_id") % 9 + 1).cast("int"))
    t = F.concat(F.col("n_chars").cast("string"), suffix)
    return docs.select("doc_id", t.alias("size_text"), tx.parse_size(t).alias("size_bytes"))


def _order_months(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()


def q_month_list(spark, sf_dir):
    """every month between the first and last order month, with file name and key."""
    orders = read_table(spark, sf_dir, "orders")
    months = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).select(
        F.explode(tx.month_sequence("lo", "hi")).alias("month")
    )
    name = tx.trip_file_name(F.lit("yellow"), F.col("month"))
    return months.select(
        "month",
        tx.is_valid_month("month").alias("valid"),
        name.alias("file_name"),
        tx.bronze_key(F.substring("month", 1, 4), F.substring("month", 6, 2), name).alias("bronze_key"),
    )


def q_file_name_parse(spark, sf_dir):
    """F3 over well-formed and malformed names for every order month and taxi type."""
    months = _order_months(spark, sf_dir)
    types = F.array(*[F.lit(t) for t in tx.TAXI_TYPES])
    typed = months.select("month", F.explode(types).alias("t"))
    shapes = F.array(
        tx.trip_file_name(F.col("t"), F.col("month")),
        F.concat(F.col("t"), F.lit("_tripdata_"), F.regexp_replace("month", "-", ""), F.lit(".parquet")),
        F.concat(F.col("t"), F.lit("_tripdata_"), F.col("month"), F.lit(".csv")),
    )
    names = typed.select(F.explode(shapes).alias("file_name"))
    p = tx.parse_trip_file_name("file_name")
    return names.select("file_name", p["valid"].alias("valid"), p["taxi_type"].alias("taxi_type"),
                        p["year"].alias("year"), p["month"].alias("month"))


def q_file_row_counts(spark, sf_dir):
    """Rows per Parquet file of every driver table."""
    frames = [inventory.parquet_row_counts(read_table(spark, sf_dir, t)) for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), frames).drop("file_path")


def q_file_inventory(spark, sf_dir):
    """Name, size, SHA-256 of every driver Parquet file."""
    return inventory.file_inventory(spark, sf_dir, "*.parquet").drop("file_path")


def q_manifest_batch(spark, sf_dir):
    """Manifest texts built from ``documents``, parsed and described as batches."""
    files = _files(spark, sf_dir)
    texts = manifest_document(files, "2025-01-01T00:00:00+00:00").select(F.to_json(F.struct("*")).alias("manifest"))
    manifests = texts.select(F.from_json("manifest", inventory.MANIFEST_SCHEMA).alias("m")).select("m.*")
    batches = inventory.batch_descriptors(manifests, "silver")
    return batches.withColumn("source_uris", F.array_join("source_uris", ","))


QUERIES = {
    "manifest_files": q_manifest_files,
    "manifest_batch": q_manifest_batch,
    "manifest_rollup": q_manifest_rollup,
    "ingest_plan": q_ingest_plan,
    "manifest_diff": q_manifest_diff,
    "duplicate_texts": q_duplicate_texts,
    "checksums": q_checksums,
    "size_parse": q_size_parse,
    "month_list": q_month_list,
    "file_name_parse": q_file_name_parse,
    "file_row_counts": q_file_row_counts,
    "file_inventory": q_file_inventory,
}
