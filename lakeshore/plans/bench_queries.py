"""Registered benchmark-statistics queries over records derived from ``events``."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from lakeshore.operators import fingerprint, gold, stats
from lakeshore.plans.trip_queries import QUERIES as TRIP_QUERIES
from lakeshore.plans.trip_queries import QUERY_FILES, silver_frame
from lakeshore.session import ensure_checkpoint_dir
from lakeshore.sinks.parquet import write_json
from lakeshore.sources.records import RUN_RECORD_SCHEMA, read_records, run_records, storage_records
from lakeshore.sources.tables import read_table


def q_run_summary(spark, sf_dir):
    return stats.run_summary(run_records(read_table(spark, sf_dir, "events")))


def q_layout_summary(spark, sf_dir):
    return stats.layout_summary(run_records(read_table(spark, sf_dir, "events")))


def q_storage_summary(spark, sf_dir):
    return stats.storage_summary(storage_records(read_table(spark, sf_dir, "events")))


def q_percentiles(spark, sf_dir):
    return stats.percentile_table(read_table(spark, sf_dir, "events"), "event_type", "value")


def q_result_fingerprint(spark, sf_dir):
    """A18 on the hourly profile (q04), the layout benchmark's first query."""
    return fingerprint.result_fingerprint(TRIP_QUERIES["q04_hourly_distance_fare"](spark, sf_dir))


def q_table_fingerprint(spark, sf_dir):
    """A18 at scale: additive fingerprint of the whole lineitem table."""
    return fingerprint.table_fingerprint(read_table(spark, sf_dir, "lineitem"))


def q_tree_fingerprint(spark, sf_dir):
    """A18 at scale: Merkle tree of lineitem without its order's number, so with equal rows."""
    return fingerprint.tree_fingerprint(read_table(spark, sf_dir, "lineitem").drop("l_orderkey", "l_extendedprice", "l_partkey"))


def q_run_records(spark, sf_dir):
    """Run records written as JSON-lines files and read with their schema."""
    uri = f"{ensure_checkpoint_dir(spark)}/run-records-{uuid.uuid4().hex}"
    write_json(run_records(read_table(spark, sf_dir, "events")), uri)
    return read_records(spark, uri, RUN_RECORD_SCHEMA)


def q_query_row_counts(spark, sf_dir):
    """The rows that every file of the query set returns."""
    counts = [TRIP_QUERIES[name](spark, sf_dir).agg(F.count(F.lit(1)).alias("rows_returned")).select(
        F.lit(name).alias("query_name"), "rows_returned") for name in QUERY_FILES]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _from_measures(table):
    def run(spark, sf_dir):
        """B2 as the job runs it: one table from the measures of its grain."""
        return gold.gold_table(table, gold.gold_measures(silver_frame(spark, sf_dir)))
    return run


QUERIES = {
    "run_records": q_run_records,
    "query_row_counts": q_query_row_counts,
    "gold_daily_from_measures": _from_measures("daily_trip_metrics"),
    "gold_location_from_measures": _from_measures("location_metrics"),
    "gold_payment_from_measures": _from_measures("payment_metrics"),
    "run_summary": q_run_summary,
    "layout_summary": q_layout_summary,
    "storage_summary": q_storage_summary,
    "percentiles": q_percentiles,
    "result_fingerprint": q_result_fingerprint,
    "table_fingerprint": q_table_fingerprint,
    "tree_fingerprint": q_tree_fingerprint,
}
