"""A generated batch -- synthetic records as JSON lines and CSV (K6), an inventory
of the written files (S6), quality-case counts (A13) and one manifest record.

Everything is written through Spark to ``output_root`` (any shared file system).  The
manifest is a control-plane record built from two small aggregates -- one row per
written file and one per quality case -- never from the records themselves.
"""

from __future__ import annotations

import json
import os
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeshore.operators import generate
from lakeshore.operators.inventory import file_inventory
from lakeshore.sinks.parquet import write_csv, write_json

# Output formats of a generated batch.
FORMATS = ("jsonl", "csv")


def write_generated_batch(
    spark: SparkSession,
    rows: int,
    days: int,
    seed: int,
    output_root: str,
    generated_at: str,
    files_per_format: int = 0,
) -> dict[str, Any]:
    """Generate ``rows`` records over ``days`` days and write the batch; returns the
    manifest as a dict (control-plane sized: one entry per file and per quality case).

    ``files_per_format`` > 0 fixes the number of files of each format (``coalesce``);
    0 leaves it to the data's partitioning.
    """
    if rows < 1 or days < 1:
        raise ValueError("rows and days must be >= 1")
    records = generate.generate_records(spark, rows, days, seed)
    outputs = {fmt: os.path.join(output_root, f"records_{fmt}") for fmt in FORMATS}
    write_json(records, outputs["jsonl"], coalesce=files_per_format)
    write_csv(records, outputs["csv"], coalesce=files_per_format)

    inventories = [
        file_inventory(spark, uri, "part-*").withColumn("format", F.lit(fmt))
        for fmt, uri in outputs.items()
    ]
    files = inventories[0].unionByName(inventories[1])
    file_rows = sorted(
        (r.asDict() for r in files.select("format", "file_name", "size_bytes", "checksum_sha256").collect()),
        key=lambda r: (r["format"], r["file_name"]),
    )
    counts = {r["quality_case"]: r["records"] for r in generate.quality_counts(records).collect()}
    manifest = {
        "manifest_version": generate.MANIFEST_VERSION,
        "schema_version": generate.SCHEMA_VERSION,
        "generated_at": generated_at,
        "rows": rows,
        "days": days,
        "seed": seed,
        "files": file_rows,
        "total_size_bytes": sum(r["size_bytes"] for r in file_rows),
        "quality_counts": dict(sorted(counts.items())),
    }
    line = json.dumps(manifest, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(output_root, "manifest")
    )
    return manifest
