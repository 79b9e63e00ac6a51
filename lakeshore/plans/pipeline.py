"""Pipeline jobs: bronze -> silver (B1), silver -> gold (B2), query smoke (B3), chain.

Each job is a single pass per output: row accounting is collected with
``DataFrame.observe`` during the write instead of extra ``count()`` actions (T14).
Metrics are one small dict per run (the control plane), written as one JSON file.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators import gold, silver
from lakeshore.operators.inventory import TRIP_DATASET, batch_descriptors, read_manifests, require_batch
from lakeshore.plans import SQL_DIR
from lakeshore.plans.runner import load_sql_queries, run_query_set, stored_parameters
from lakeshore.sinks.parquet import remove_folder, write_clustered, write_partitioned
from lakeshore.session import ensure_checkpoint_dir
from lakeshore.sources.tables import read_parquet, register_views


def _observed_source(df: DataFrame, idx: int, passthrough: Sequence[str] | None) -> tuple[DataFrame, Observation]:
    obs = Observation(f"source_{idx}")
    labelled = silver.normalize(df, passthrough).withColumn("reason", silver.rejection_reason())
    metrics = [F.count(F.lit(1)).alias("input_rows")]
    metrics += [F.count_if(F.col("reason") == r).alias(r) for r in silver.REASONS]
    return labelled.observe(obs, *metrics), obs


def group_sources_by_schema(spark: SparkSession, source_uris: Sequence[str]) -> list[list[str]]:
    """Source files grouped by their Parquet schema, groups in first-seen order.

    Files of one schema are read by a single scan, so a batch of thousands of monthly or
    hourly files becomes a handful of scans (one per schema variant) instead of a
    thousands-way union; the drifted variants are normalised separately before the union
    (T12).  Only footers are read here (metadata, on a small driver thread pool).
    """
    with ThreadPoolExecutor(max_workers=min(16, max(1, len(source_uris)))) as pool:
        schemas = list(pool.map(lambda u: spark.read.parquet(u).schema.json(), source_uris))
    groups: dict[str, list[str]] = {}
    for uri, schema in zip(source_uris, schemas):
        groups.setdefault(schema, []).append(uri)
    return list(groups.values())


def bronze_to_silver(
    spark: SparkSession,
    source_uris: Sequence[str],
    silver_uri: str,
    mode: str = "overwrite",
    passthrough: Sequence[str] | None = None,
) -> dict[str, Any]:
    """B1: read every source, normalise + validate, union by name, dedup, write by date.

    All source columns reach silver; ``passthrough`` narrows the untyped ones to those named.

    The write goes through ``REBALANCE(pickup_date)``: no extra pass over the data, AQE
    sizes the writers and splits a hot date.  The session's 64 KiB coalescing floor keeps
    about one writer per core even for a batch of ~1 MiB spread over thousands of dates;
    ``layout="range"`` with ``range_cols=("pickup_datetime",)`` fixes the writer count
    exactly, at the price of a range-sampling pass over the deduplicated rows.
    """
    if not source_uris:
        raise ValueError("At least one trip source URI is required")
    started = time.perf_counter()
    groups = group_sources_by_schema(spark, source_uris)
    observed = [_observed_source(spark.read.parquet(*g), i, passthrough) for i, g in enumerate(groups)]
    valid = [df.where(F.col("reason").isNull()).drop("reason") for df, _ in observed]
    result = silver.deduplicate(silver.union_sources(valid))
    out_obs = Observation("silver_out")
    write_partitioned(result, silver_uri, mode, observation=out_obs)

    per_source = [obs.get for _, obs in observed]
    input_rows = sum(m["input_rows"] for m in per_source)
    invalid = {r: sum(m[r] for m in per_source) for r in silver.REASONS}
    output_rows = out_obs.get["rows"]
    valid_rows = input_rows - sum(invalid.values())
    return {
        "job_name": "bronze_to_silver",
        "dataset": TRIP_DATASET,
        "source_uris": list(source_uris),
        "source_file_count": len(source_uris),
        "source_schema_count": len(groups),
        "silver_uri": silver_uri,
        "input_rows": input_rows,
        "output_rows": output_rows,
        "rejected_rows": input_rows - output_rows,
        "invalid_rows_by_reason": invalid,
        "duplicate_rows": valid_rows - output_rows,
        "write_mode": mode,
        "duration_seconds": round(time.perf_counter() - started, 3),
    }


def bronze_to_silver_from_manifest(
    spark: SparkSession,
    manifest_path: str,
    silver_bucket: str,
    mode: str = "overwrite",
    bronze_root: str | None = None,
    silver_root: str | None = None,
    passthrough: Sequence[str] | None = None,
) -> dict[str, Any]:
    """B1 driven by an ingest manifest (S5): exactly one batch per manifest; an unsupported
    dataset or an empty file list is an error.  Sources are the manifest's files in
    order; silver goes to the batch's ``year=/month=`` prefix (the batch, not trip dates,
    T9/T10).

    ``bronze_root`` / ``silver_root`` replace the object-store buckets by folders (for
    local runs); by default the ``s3a://bucket/key`` URIs of the manifest are used.
    """
    batches = require_batch(batch_descriptors(read_manifests(spark, manifest_path), silver_bucket))
    if len(batches) != 1:
        raise ValueError(f"expected one manifest batch, found {len(batches)}")
    batch = batches[0]
    if bronze_root:
        files = read_manifests(spark, manifest_path).select(F.explode("files.bronze_key").alias("k"))
        keys = [r["k"] for r in files.collect()]  # one entry per source file (control plane)
        sources = [os.path.join(bronze_root, k) for k in keys]
    else:
        sources = list(batch["source_uris"])
    silver_uri = os.path.join(silver_root, batch["silver_prefix"]) if silver_root else batch["silver_uri"]
    metrics = bronze_to_silver(spark, sources, silver_uri, mode, passthrough)
    metrics.update(batch_year=batch["year"], batch_month=batch["month"], taxi_type=batch["taxi_type"])
    return metrics


def gold_uris(gold_root: str, year: str | None = None, month: str | None = None) -> dict[str, str]:
    """``<gold root>/<table>``, or ``<gold root>/<table>/year=YYYY/month=MM`` for one batch."""
    batch = [f"year={year}", f"month={month}"] if year and month else []
    return {name: os.path.join(gold_root, name, *batch) for name in gold.GOLD_TABLES}


GOLD_LAYOUTS = ("clustered", "partitioned")


def silver_to_gold(
    spark: SparkSession,
    silver_uri: str,
    gold_root: str,
    mode: str = "overwrite",
    layout: str = "partitioned",
    year: str | None = None,
    month: str | None = None,
    replace_all: bool = False,
) -> dict[str, Any]:
    """B2: the three gold tables, each written with an observed row count.

    Silver is aggregated to the two finest grains (``gold.gold_measures``), each from a scan
    of the columns it needs.  The location table is one of them; the other, a few rows per
    date, is written to the shared checkpoint folder, the payment and the daily table are
    made from it, and it is deleted.  The location table is built beside them.

    ``layout``: ``partitioned`` (default) has a directory per ``pickup_date``; an overwrite
    replaces the dates present and keeps all others, and the external tables read it.
    ``clustered`` writes each table as date-ordered files sized by AQE (see
    ``write_clustered``), for gold of many dates with few rows each; its overwrite replaces
    the table and is refused where that would lose dates, unless ``replace_all``.
    """
    if layout not in GOLD_LAYOUTS:
        raise ValueError(f"unsupported gold layout: {layout}")
    started = time.perf_counter()
    silver_df = read_parquet(spark, silver_uri)
    uris = gold_uris(gold_root, year, month)
    scratch = f"{ensure_checkpoint_dir(spark)}/gold-measures-{uuid.uuid4().hex}"
    measures = gold.gold_measures(silver_df)
    schema = measures["payment"].schema

    dates = Observation("gold_dates")

    def build_and_write(name, measures):
        obs, df = Observation(name), gold.gold_table(name, measures)
        if name == "daily_trip_metrics":  # a row per date
            df = df.observe(dates, F.collect_set(F.col("pickup_date").cast("string")).alias("dates"))
        if layout == "clustered":
            write_clustered(df, uris[name], mode, observation=obs, replace_all=replace_all)
        else:
            write_partitioned(df, uris[name], mode, layout="range", observation=obs)
        return name, obs.get["rows"]

    # Independent writes submitted concurrently: the scheduler interleaves their tasks and
    # the driver-side commits overlap.
    try:
        with ThreadPoolExecutor(max_workers=3) as pool:
            jobs = [pool.submit(build_and_write, "location_metrics", measures)]
            measures["payment"].write.parquet(scratch)
            stored = {"payment": spark.read.schema(schema).parquet(scratch)}
            jobs += [pool.submit(build_and_write, name, stored) for name in ("daily_trip_metrics", "payment_metrics")]
            rows = dict(job.result() for job in jobs)
    finally:
        remove_folder(spark, scratch)
    return {
        "job_name": "silver_to_gold",
        "silver_uri": silver_uri,
        **{f"{k}_uri": v for k, v in uris.items()},
        "daily_rows": rows["daily_trip_metrics"],
        "location_rows": rows["location_metrics"],
        "payment_rows": rows["payment_metrics"],
        "dates": sorted(dates.get["dates"]),
        "write_mode": mode,
        "layout": layout,
        "duration_seconds": round(time.perf_counter() - started, 3),
    }


def register_tables(spark: SparkSession, silver_uri: str, gold_root: str,
                    year: str | None = None, month: str | None = None) -> dict[str, DataFrame]:
    """K9: the four views the SQL files query."""
    frames = {"silver_trips": read_parquet(spark, silver_uri)}
    frames.update({name: read_parquet(spark, uri) for name, uri in gold_uris(gold_root, year, month).items()})
    register_views(spark, frames)
    return frames


def query_smoke(
    spark: SparkSession,
    silver_uri: str,
    gold_root: str,
    sql_dir: Path = SQL_DIR,
    sample_limit: int = 5,
    year: str | None = None,
    month: str | None = None,
) -> dict[str, Any]:
    """Run every SQL file once, recording rows, seconds and a short sample."""
    started = time.perf_counter()
    register_tables(spark, silver_uri, gold_root, year, month)
    params = stored_parameters(spark, silver_uri, gold_uris(gold_root, year, month)["daily_trip_metrics"])
    results = run_query_set(spark, load_sql_queries(sql_dir), params, sample_limit)
    return {
        "job_name": "query_smoke",
        "parameters": {k: str(v) for k, v in params.items()},
        "query_count": len(results),
        "queries": results,
        "duration_seconds": round(time.perf_counter() - started, 3),
    }


def metrics_path(output_dir: str, job_name: str, year: str, month: str) -> str:
    """K7: ``<output>/<job>/year=YYYY/month=MM/metrics.json`` (the batch, not trip dates)."""
    return os.path.join(output_dir, job_name, f"year={year}", f"month={month}", "metrics.json")


def write_metrics(spark: SparkSession, path: str, metrics: dict[str, Any]) -> None:
    """K7: one JSON line per run, written through Spark so ``path`` may be any shared
    file system (HDFS, object store), not the driver's local disk."""
    line = json.dumps(metrics, default=str, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def run_pipeline(
    spark: SparkSession,
    source_uris: Sequence[str],
    lake_root: str,
    metrics_dir: str | None = None,
    year: str | None = None,
    month: str | None = None,
    mode: str = "overwrite",
    gold_layout: str = "partitioned",
    passthrough: Sequence[str] | None = None,
) -> dict[str, dict[str, Any]]:
    """Bronze -> silver -> gold -> query smoke, in that order; with ``metrics_dir``
    one metrics record per job under the batch's ``year=/month=`` (both required)."""
    if metrics_dir and not (year and month):
        raise ValueError("metrics need the batch year and month")
    silver_uri = os.path.join(lake_root, "silver", "trips")
    gold_root = os.path.join(lake_root, "gold")
    out = {
        "bronze_to_silver": bronze_to_silver(spark, source_uris, silver_uri, mode, passthrough),
        "silver_to_gold": silver_to_gold(spark, silver_uri, gold_root, mode, gold_layout, replace_all=True),  # all of silver
        "query_smoke": query_smoke(spark, silver_uri, gold_root),
    }
    if metrics_dir:
        for name, m in out.items():
            write_metrics(spark, metrics_path(metrics_dir, name, year, month), m)
    return out
