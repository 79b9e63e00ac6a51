"""Registered trip queries: raw driver tables -> silver -> gold -> SQL query set.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose work grows
with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators import gold, silver
from lakeshore.plans import SMOKE_SQL_DIR, SQL_DIR
from lakeshore.plans.runner import lazy_parameters, parameter_row, run_sql
from lakeshore.sources.tables import register_views
from lakeshore.sources.trips import drifted_sources, raw_sources


def silver_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_trips(raw_sources(spark, sf_dir), passthrough=())


def register_lakehouse_views(spark: SparkSession, silver_df: DataFrame) -> dict[str, DataFrame]:
    frames = {"silver_trips": silver_df}
    frames.update({name: build(silver_df) for name, build in gold.GOLD_TABLES.items()})
    register_views(spark, frames)
    return frames


def _sql(spark: SparkSession, sf_dir: str, folder, file_name: str) -> DataFrame:
    frames = register_lakehouse_views(spark, silver_frame(spark, sf_dir))
    return run_sql(spark, folder / file_name, lazy_parameters(frames["silver_trips"]))


def q_silver_trips(spark, sf_dir):
    return silver_frame(spark, sf_dir)


def q_rejection_report(spark, sf_dir):
    return silver.rejection_report(raw_sources(spark, sf_dir))


def q_silver_union_drift(spark, sf_dir):
    """Bag union of the cleaned, drifted sources, with the columns that they carry:
    ``airport_fee`` only exists in B, which here also has its passenger counts as text."""
    a, b = raw_sources(spark, sf_dir)
    b = b.withColumn("passenger_count", F.concat(F.col("passenger_count").cast("string"), F.lit(".0")))
    return silver.union_sources([silver.clean(df) for df in (a, b)])


def q_silver_type_drift(spark, sf_dir):
    """Sources whose carried columns drift in type, case and nested fields (maps
    among them), resolved, united and deduplicated."""
    df = silver.silver_trips(drifted_sources(spark, sf_dir))
    return df.select(
        *silver.SILVER_COLUMNS, F.col("zone").alias("zone"), F.col("fee").alias("fee"), F.col("info.level").alias("level"), F.col("info.note").alias("note"),
        F.col("tags")[0].alias("tag"), F.col("props")["pickup"].alias("prop"))


def q_gold_daily(spark, sf_dir):
    return gold.daily_trip_metrics(silver_frame(spark, sf_dir))


def q_gold_location(spark, sf_dir):
    return gold.location_metrics(silver_frame(spark, sf_dir))


def q_gold_payment(spark, sf_dir):
    return gold.payment_metrics(silver_frame(spark, sf_dir))


def q_date_params(spark, sf_dir):
    """P11 as a one-row DataFrame (strings, as the runner records them)."""
    row = parameter_row(silver_frame(spark, sf_dir))
    return row.select(*[F.col(c).cast("string").alias(c) for c in row.columns])


QUERY_FILES = {
    "q01_daily_revenue": (SQL_DIR, "01_daily_revenue.sql"),
    "q02_top_pickup_locations": (SQL_DIR, "02_top_pickup_locations.sql"),
    "q03_avg_tip_by_payment": (SQL_DIR, "03_avg_tip_by_payment.sql"),
    "q04_hourly_distance_fare": (SQL_DIR, "04_hourly_distance_fare.sql"),
    "q05_selective_pickup_date": (SQL_DIR, "05_selective_pickup_date.sql"),
    "q06_full_scan_location_aggregation": (SQL_DIR, "06_full_scan_location_aggregation.sql"),
    "smoke_totals": (SMOKE_SQL_DIR, "01_gold_totals.sql"),
    "smoke_daily": (SMOKE_SQL_DIR, "02_gold_daily_preview.sql"),
    "smoke_tip": (SMOKE_SQL_DIR, "03_gold_tip_by_payment.sql"),
}


def _file_query(folder, file_name):
    def run(spark, sf_dir):
        return _sql(spark, sf_dir, folder, file_name)
    run.__name__ = f"q_{file_name[:-4]}"
    return run


QUERIES = {
    "silver_trips": q_silver_trips,
    "rejection_report": q_rejection_report,
    "silver_union_drift": q_silver_union_drift,
    "silver_type_drift": q_silver_type_drift,
    "gold_daily": q_gold_daily,
    "gold_location": q_gold_location,
    "gold_payment": q_gold_payment,
    "date_params": q_date_params,
    **{key: _file_query(folder, name) for key, (folder, name) in QUERY_FILES.items()},
}
