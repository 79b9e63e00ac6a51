"""External partitioned tables over written Parquet folders (K8).

The three gold tables (and silver) become catalog tables whose data stay where the jobs
wrote them.  A partitioned external table starts with no registered partitions, so nothing
is visible until they are: :func:`add_partitions` registers the dates that a write reports
(``silver_to_gold`` returns them), :func:`sync_partitions` compares the folders with the
catalog in full (adds new ones, drops vanished ones).  A table whose folder has changed its
layout or place is an error, never a stale view of it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeshore.sources.tables import partition_values

# Gold table schemas (columns and types) of the external tables.
GOLD_TABLE_COLUMNS = {
    "daily_trip_metrics": (
        "trip_count BIGINT, total_revenue DOUBLE, fare_revenue DOUBLE, total_tip DOUBLE, "
        "avg_trip_distance DOUBLE, avg_passenger_count DOUBLE, pickup_date DATE"
    ),
    "location_metrics": (
        "pu_location_id INT, do_location_id INT, trip_count BIGINT, total_revenue DOUBLE, "
        "avg_trip_distance DOUBLE, pickup_date DATE"
    ),
    "payment_metrics": (
        "payment_type INT, trip_count BIGINT, total_revenue DOUBLE, fare_revenue DOUBLE, "
        "total_tip DOUBLE, avg_tip_amount DOUBLE, pickup_date DATE"
    ),
}

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


def create_external_table(
    spark: SparkSession,
    schema: str,
    table: str,
    columns: str,
    location: str,
    partition_col: str | None = "pickup_date",
) -> None:
    """``CREATE TABLE IF NOT EXISTS schema.table (...) USING PARQUET [PARTITIONED BY] LOCATION``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(schema)}")
    partitioned = f"PARTITIONED BY ({_ident(partition_col)})" if partition_col else ""
    location = location.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {schema}.{_ident(table)} ({columns}) "
        f"USING PARQUET {partitioned} LOCATION '{location}'"
    )


def sync_partitions(spark: SparkSession, schema: str, table: str) -> None:
    """Full partition sync (add and drop) from the table's directory tree."""
    spark.sql(f"MSCK REPAIR TABLE {_ident(schema)}.{_ident(table)} SYNC PARTITIONS")


#: Partitions that one statement registers.
PARTITIONS_A_STATEMENT = 500


def add_partitions(spark: SparkSession, schema: str, table: str, values: Sequence[str], partition_col: str = "pickup_date") -> None:
    """Register the partitions of ``values`` (as text); those known already stay."""
    name, column = f"{_ident(schema)}.{_ident(table)}", _ident(partition_col)
    for start in range(0, len(values), PARTITIONS_A_STATEMENT):
        parts = " ".join("PARTITION ({} = '{}')".format(column, v.replace("'", "\\'")) for v in values[start: start + PARTITIONS_A_STATEMENT])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def _require_same_layout(spark: SparkSession, schema: str, table: str, location: str, partition_col: str | None) -> None:
    """An error if the catalog's table has other partition columns or another place."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.{table}").collect()}
    columns = [c.name for c in spark.catalog.listColumns(f"{schema}.{table}") if c.isPartition]
    wanted = [partition_col] if partition_col else []
    if columns != wanted:
        raise ValueError(f"{schema}.{table} is partitioned by {columns or 'nothing'}, its folder by {wanted or 'nothing'}; drop the table first")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def place(uri: str) -> str:
        return path(uri).toUri().getPath().rstrip("/")

    if place(described["Location"]) != place(location):
        raise ValueError(f"{schema}.{table} lies in {described['Location']}, not in {location}; drop the table first")


def register_gold_tables(spark: SparkSession, gold_uris: dict[str, str], schema: str = "lake",
                         dates: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """K8: create the three tables over either gold layout; date directories become
    partitions, a clustered folder is a plain table.

    ``dates`` names the dates to register, as a write reports them; without it the folders
    and the catalog are compared in full.  The layout is read from one listing of each
    table's folder."""
    out = {}
    for table, columns in GOLD_TABLE_COLUMNS.items():
        partitioned = bool(partition_values(spark, gold_uris[table]))
        column = "pickup_date" if partitioned else None
        create_external_table(spark, schema, table, columns, gold_uris[table], column)
        _require_same_layout(spark, schema, table, gold_uris[table], column)
        if partitioned and dates is not None:
            add_partitions(spark, schema, table, dates)
        elif partitioned:
            sync_partitions(spark, schema, table)
        else:
            spark.catalog.refreshTable(f"{schema}.{table}")
        out[table] = spark.table(f"{schema}.{table}")
    return out
