"""Parquet table scans (S1) and the partitioned-table scan (S3)."""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; Catalyst prunes columns and pushes filters into this scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_parquet(spark: SparkSession, uri: str) -> DataFrame:
    """Parquet scan of one URI; a ``pickup_date=`` directory tree is discovered as a
    partition column, so date predicates become ``PartitionFilters``."""
    return spark.read.parquet(uri)


def partition_values(spark: SparkSession, uri: str, column: str = "pickup_date") -> list[str]:
    """The values of a partitioned table's first partition column, sorted, from the names of
    the folders below ``uri``: one listing, no file is opened.  Empty for a table that is not
    partitioned by it, or is not there.  Folders without a data file are left out at both
    ends, where they would change the range."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(uri)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    mark = f"{column}="
    names = sorted(s.getPath().getName() for s in system.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith(mark))

    def filled(name: str) -> bool:
        return any(s.getLen() > 0 and s.getPath().getName()[0] not in "._" for s in system.listStatus(jvm.org.apache.hadoop.fs.Path(root, name)))

    while names and not filled(names[-1]):
        names.pop()
    while names and not filled(names[0]):
        names.pop(0)
    values = [unquote(name[len(mark):]) for name in names]
    return [v for v in values if v != NULL_PARTITION]


#: Spark's folder of the rows without a value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """K9: register DataFrames as temp views for the SQL query files."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
