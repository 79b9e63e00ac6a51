"""Metric samples derived from the driver's ``events`` table (fixture for M1-M3).

* gauge: job = metric = event_type, series label = user_id % 5, value = event value;
* counter: per series, the running sum of values, restarting at every block of 100
  event ids (a counter reset).  The running sum is a window over (series, block), so
  each window partition holds at most 100 rows;
* up: job = event_type, instance = user_id % 5, 0 when the value is below 5 else 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the fixture.
RESET_EVERY = 100
UP_THRESHOLD = 5.0
COUNTER_TYPE = "decimal(28,2)"


def _series(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", F.col("event_type").alias("metric"),
        (F.col("user_id") % 5).cast("string").alias("series_label"), "value",
    )


def gauge_samples(events: DataFrame) -> DataFrame:
    return _series(events).select("ts", F.col("metric").alias("job"), "metric", "series_label", "value")


def counter_samples(events: DataFrame) -> DataFrame:
    s = _series(events)
    block = F.floor(F.col("event_id") / RESET_EVERY)
    w = Window.partitionBy("metric", "series_label", block).orderBy("event_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counter = F.sum(F.col("value").cast("decimal(18,2)")).over(w).cast(COUNTER_TYPE)
    return s.select("ts", "metric", "series_label", counter.alias("value"))


def up_samples(events: DataFrame) -> DataFrame:
    return events.select(
        "ts", F.col("event_type").alias("job"), (F.col("user_id") % 5).cast("string").alias("instance"),
        F.when(F.col("value") < UP_THRESHOLD, F.lit(0.0)).otherwise(F.lit(1.0)).alias("value"),
    )
