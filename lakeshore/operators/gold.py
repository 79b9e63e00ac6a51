"""Silver -> gold: three aggregate tables (A1-A3).

Each is one hash aggregate with partial (map-side) aggregation, so a hot
``pickup_date`` holding a third of the trips is reduced before the shuffle.  Sums are
of whole millionths wherever that loses nothing (see ``exact_sum``), so gold is reproducible
bit for bit on money values; averages are that sum / count.
No ``orderBy`` before the write (T15): row order is not a property of a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.functions import choose_sum, exact_avg, exact_sum, is_lossy, millionths


def daily_trip_metrics(silver: DataFrame) -> DataFrame:
    """A1: per pickup_date; AVG skips NULL passenger counts."""
    return silver.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_sum("fare_amount").alias("fare_revenue"),
        exact_sum("tip_amount").alias("total_tip"),
        exact_avg("trip_distance").alias("avg_trip_distance"),
        F.try_divide(F.sum("passenger_count").cast("double"), F.count("passenger_count").cast("double"))
        .alias("avg_passenger_count"),
    )


def location_metrics(silver: DataFrame) -> DataFrame:
    """A2: per (pickup_date, pickup location, dropoff location)."""
    return silver.groupBy("pickup_date", "pu_location_id", "do_location_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("trip_distance").alias("avg_trip_distance"),
    )


def payment_metrics(silver: DataFrame) -> DataFrame:
    """A3: per (pickup_date, payment_type); a NULL payment type is its own group."""
    return silver.groupBy("pickup_date", "payment_type").agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_sum("fare_amount").alias("fare_revenue"),
        exact_sum("tip_amount").alias("total_tip"),
        exact_avg("tip_amount").alias("avg_tip_amount"),
    )


#: The finest grains that no other table can be rolled up from, and what each measures.
#: ``daily_trip_metrics`` is rolled up from the payment grain, a few rows per date.
GRAINS = {
    "location": (("pickup_date", "pu_location_id", "do_location_id"), ("total_amount", "trip_distance")),
    "payment": (("pickup_date", "payment_type"), ("total_amount", "fare_amount", "tip_amount", "trip_distance")),
}


def gold_measures(silver: DataFrame) -> dict[str, DataFrame]:
    """The additive measures of each grain, one hash aggregate of primitive buffers each.

    Per amount: the total in millionths (``s_``), the number of values that those would change
    (``l_``; a total beyond 64 bits counts as one), the plain double sum (``f_``, used where
    there are such values) and the number of values (``n_``).  Sums of these over the rows of
    a coarser group are that group's measures, so every gold column is a sum or a ratio of
    them.  The two grains read different columns of silver, and the location grain is about
    as large as silver: rolling both up from one aggregate over all four keys, or expanding
    every row into a row per table, shuffles more than the second, pruned scan costs.
    """
    return {name: _totals(silver, keys, amounts) for name, (keys, amounts) in GRAINS.items()}


def _totals(silver: DataFrame, keys: tuple[str, ...], amounts: tuple[str, ...]) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("trip_count")]
    for c in amounts:
        measures += [F.try_sum(millionths(c)).alias(f"s_{c}"), F.count_if(is_lossy(c)).alias(f"l_{c}"), F.sum(c).alias(f"f_{c}"),
                     F.count(c).alias(f"n_{c}")]
    if "payment_type" in keys:
        measures += [F.sum("passenger_count").alias("s_passengers"), F.count("passenger_count").alias("n_passengers")]
    return _overflows_counted(silver.groupBy(*keys).agg(*measures), amounts)


def _overflows_counted(measures: DataFrame, amounts: tuple[str, ...]) -> DataFrame:
    return measures.withColumns({
        f"l_{c}": F.col(f"l_{c}") + F.when(F.col(f"s_{c}").isNull() & (F.col(f"n_{c}") > 0), 1).otherwise(0) for c in amounts})


def roll_up(measures: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Measures of a coarser grain."""
    amounts = tuple(c[2:] for c in measures.columns if c.startswith("f_"))
    added = [c for c in measures.columns if c == "trip_count" or c[:2] in ("s_", "l_", "f_", "n_")]
    totals = [(F.try_sum(c) if c.startswith("s_") else F.sum(c)).alias(c) for c in added]
    return _overflows_counted(measures.groupBy(*keys).agg(*totals), amounts)


def _total(c: str):
    return choose_sum(F.col(f"s_{c}"), F.col(f"l_{c}"), F.col(f"f_{c}"))


def _average(c: str):
    return F.try_divide(_total(c), F.col(f"n_{c}").cast("double"))


def _daily(measures: dict[str, DataFrame]) -> DataFrame:
    passengers = F.try_divide(F.col("s_passengers").cast("double"), F.col("n_passengers").cast("double"))
    return roll_up(measures["payment"], ("pickup_date",)).select(
        "pickup_date", "trip_count", _total("total_amount").alias("total_revenue"), _total("fare_amount").alias("fare_revenue"),
        _total("tip_amount").alias("total_tip"), _average("trip_distance").alias("avg_trip_distance"), passengers.alias("avg_passenger_count"))


def _location(measures: dict[str, DataFrame]) -> DataFrame:
    return measures["location"].select(
        "pickup_date", "pu_location_id", "do_location_id", "trip_count",
        _total("total_amount").alias("total_revenue"), _average("trip_distance").alias("avg_trip_distance"))


def _payment(measures: dict[str, DataFrame]) -> DataFrame:
    return measures["payment"].select(
        "pickup_date", "payment_type", "trip_count", _total("total_amount").alias("total_revenue"),
        _total("fare_amount").alias("fare_revenue"), _total("tip_amount").alias("total_tip"), _average("tip_amount").alias("avg_tip_amount"))


_FROM_MEASURES = {"daily_trip_metrics": _daily, "location_metrics": _location, "payment_metrics": _payment}


def gold_table(name: str, measures: dict[str, DataFrame]) -> DataFrame:
    """One gold table from :func:`gold_measures`, in its column order."""
    return _FROM_MEASURES[name](measures)


def split_gold(measures: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three gold tables from :func:`gold_measures`."""
    return {name: gold_table(name, measures) for name in _FROM_MEASURES}


GOLD_TABLES = {
    "daily_trip_metrics": daily_trip_metrics,
    "location_metrics": location_metrics,
    "payment_metrics": payment_metrics,
}
