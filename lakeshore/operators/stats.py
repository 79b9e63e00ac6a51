"""Benchmark statistics as DataFrame jobs: run summary (A14), layout summary with the
cross-layout consistency join (A15, J3), storage-operation summary (A16), exact
percentiles (A17).

Percentiles are exact, with linear interpolation on rank ``(n-1)*p`` (the reference's
rule and Spark's).  Spark's own ``percentile`` keeps all distinct values of a group in
one aggregation buffer, i.e. one task per group; ``exact_percentiles`` selects the same
ranks by radix histograms: counts by the leading digits of the value, refined level by
level, so no task holds more than the digits below one prefix of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.functions import round_half_up


#: Bits that a value's number is shifted by at each level; digits have ``DIGIT_BITS``.
DIGIT_BITS = 16
LEVEL_SHIFTS = (48, 32, 16, 0)


def ordered_bits(value: Column) -> Column:
    """A BIGINT in the order of the doubles (NaN last): the bits of the number, those below
    the sign turned round for negative ones."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _levels(df: DataFrame, keys: list[str], value: str) -> list[DataFrame]:
    """Counts (``_c``) by group and by the value's leading digits (``_prefix``, ``_parent``
    without the last of them), coarsest first; the last level has the values (``_v``)."""
    def digits(level: DataFrame, shift: int, number: Column) -> DataFrame:
        parent = F.shiftright(number, DIGIT_BITS) if shift < LEVEL_SHIFTS[0] else F.lit(0).cast("bigint")
        return level.withColumn("_prefix", number).withColumn("_parent", parent)

    # (group, value) -> count: partial map-side, so repeated values shrink before the shuffle,
    # and a group with many values is spread over all tasks
    counted = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v"))
               .agg(F.count(F.lit(1)).alias("_c")))
    levels = [digits(counted, 0, ordered_bits(F.col("_v")))]
    for shift in LEVEL_SHIFTS[-2::-1]:
        finer = levels[0].groupBy(*keys, F.col("_parent").alias("_number")).agg(F.sum("_c").alias("_c"))
        levels.insert(0, digits(finer, shift, F.col("_number")).drop("_number"))
    return levels


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float]) -> DataFrame:
    """A17 at scale: one row per group of ``keys`` that has a non-NULL ``value``, with
    ``n`` (non-NULL values) and one column ``p<p>`` per requested percentile.

    Rank selection by radix histograms: the values' order-preserving bits are four digits of
    16 bits.  Each level counts the rows by one more digit (hash aggregates, partial
    map-side, each from the level below); a wanted rank finds its digit by an equi join on
    (group, digits so far) with the running count there, and goes on below it with the
    rank that is left.  A group with a third of the rows is spread by its values; what
    meets in one task are the at most 65,536 digits below one prefix.  All of it is one lazy
    plan: nothing runs, and nothing is written, until the result is asked for.
    """
    for p in ps:
        if p < 0 or p > 100:
            raise ValueError("percentile must be between 0 and 100")
    keys = list(keys)
    levels = _levels(df, keys, value)
    groups = levels[0].groupBy(*keys).agg(F.sum("_c").alias("n"))

    # two ranks per (group, percentile): floor and ceil of (n-1)*p
    wanted = groups.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("_p"), ((F.col("n") - 1) * (F.lit(float(p)) / 100.0)).alias("_pos")) for p in ps])).alias("_t"))
    ranks = wanted.select(*keys, "_t.*").select(
        *keys, "_p", "_pos", F.explode(F.array_distinct(F.array(F.floor("_pos").cast("bigint"), F.ceil("_pos").cast("bigint")))).alias("_at"))
    found = ranks.withColumn("_rank", F.col("_at")).withColumn("_parent", F.lit(0).cast("bigint"))
    for level in levels:
        running = Window.partitionBy(*keys, "_parent").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = level.withColumn("_end", F.sum("_c").over(running)).withColumn("_start", F.col("_end") - F.col("_c"))
        values = ["_v"] if "_v" in level.columns else []
        found = _null_safe_join(found, placed, [*keys, "_parent"], "inner").where(
            (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end"))).select(
            *keys, "_p", "_pos", "_at", (F.col("_rank") - F.col("_start")).alias("_rank"), F.col("_prefix").alias("_parent"), *values)

    def interpolated(p: float) -> Column:
        # the arithmetic of Spark's percentile: (hi - pos) * v_lo + (pos - lo) * v_hi
        mine = F.col("_p") == float(p)
        lo, hi = F.floor("_pos"), F.ceil("_pos")
        v_lo = F.max(F.when(mine & (F.col("_at") == lo), F.col("_v")))
        v_hi = F.max(F.when(mine & (F.col("_at") == hi), F.col("_v")))
        pos = F.max(F.when(mine, F.col("_pos")))
        return F.when((F.floor(pos) == F.ceil(pos)) | (v_lo == v_hi), v_lo).otherwise(
            (F.ceil(pos) - pos) * v_lo + (pos - F.floor(pos)) * v_hi)

    per_group = found.groupBy(*keys).agg(*[interpolated(p).alias(f"p{_label(p)}") for p in ps])
    return _null_safe_join(groups, per_group, keys, "left").select(*keys, "n", *[f"p{_label(p)}" for p in ps])


def _label(p: float) -> str:
    return str(int(p)) if float(p).is_integer() else str(p).replace(".", "_")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys that may be NULL (a NULL query name is still a group): ``<=>`` on
    every key, which the planner still executes as an equi join.  The right side's keys
    are renamed first, so frames that share lineage cannot resolve ambiguously."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def _with_duration_stats(measured: DataFrame, keys: Sequence[str], counts: list[Column],
                         col: str = "duration_seconds") -> DataFrame:
    base = measured.groupBy(*keys).agg(
        *counts,
        round_half_up(F.min(col), 3).alias("min_seconds"),
        round_half_up(F.max(col), 3).alias("max_seconds"),
    )
    pct = exact_percentiles(measured, keys, col, (50, 95)).select(
        *keys,
        round_half_up("p50", 3).alias("median_seconds"),
        round_half_up("p95", 3).alias("p95_seconds"),
    )
    return _null_safe_join(base, pct, keys)


def _rows_returned() -> Column:
    # The value when every run returned the same row count, else "inconsistent".
    return F.when(
        F.count_distinct("rows_returned") == 1, F.min("rows_returned").cast("string")
    ).otherwise(F.lit("inconsistent")).alias("rows_returned")


def measured_successes(records: DataFrame) -> DataFrame:
    return records.where((F.col("phase") == "measured") & (F.col("status") == "success"))


def run_summary(records: DataFrame) -> DataFrame:
    """Per query over measured, successful runs."""
    out = _with_duration_stats(
        measured_successes(records), ["query_name"], [F.count(F.lit(1)).alias("runs"), _rows_returned()]
    )
    return out.select("query_name", "runs", "rows_returned", "min_seconds", "median_seconds", "p95_seconds", "max_seconds")


def layout_summary(records: DataFrame) -> DataFrame:
    """A15 + J3: per (layout, query) stats and whether every layout produced one result hash.

    The per-query distinct-hash count has one row per query, so the join back is a
    broadcast-sized equi join chosen by the planner.
    """
    measured = measured_successes(records)
    per_query = measured.groupBy("query_name").agg(
        (F.count_distinct("result_sha256") == 1).alias("result_consistent")
    )
    per_layout = _with_duration_stats(
        measured, ["layout", "query_name"], [F.count(F.lit(1)).alias("runs"), _rows_returned()]
    )
    return _null_safe_join(per_layout, per_query, ["query_name"], "left").select(
        "layout", "query_name", "runs", "rows_returned", "result_consistent",
        "min_seconds", "median_seconds", "p95_seconds", "max_seconds",
    )


def storage_summary(records: DataFrame) -> DataFrame:
    """Per (operation, object size, concurrency) over measured records.

    ``total_seconds`` is the longest phase including failures; throughput and ops/s use
    successes only; latency percentiles are of successes, 0 when there are none.
    """
    ok = F.col("status") == "success"
    measured = records.where(F.col("phase") == "measured")
    agg = measured.groupBy(
        F.col("scenario_operation").alias("operation"),
        F.col("object_size_bytes").cast("bigint").alias("object_size_bytes"),
        F.col("concurrency").cast("bigint").alias("concurrency"),
    ).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("successes"),
        F.coalesce(F.max("phase_elapsed_seconds"), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum(F.when(ok, F.col("logical_bytes"))), F.lit(0)).alias("bytes"),
    )
    keys = ["operation", "object_size_bytes", "concurrency"]
    successes = measured.where(ok).select(
        F.col("scenario_operation").alias("operation"),
        F.col("object_size_bytes").cast("bigint").alias("object_size_bytes"),
        F.col("concurrency").cast("bigint").alias("concurrency"),
        "latency_seconds",
    )
    pct = exact_percentiles(successes, keys, "latency_seconds", (50, 95, 99)).drop("n")
    agg = _null_safe_join(agg, pct, keys)
    total = F.col("total")
    has_time = total > 0

    def ms(c: str) -> Column:
        return F.coalesce(round_half_up(F.col(c) * 1000, 3), F.lit(0.0))

    return agg.select(
        "operation", "object_size_bytes", "concurrency", "runs",
        (F.col("runs") - F.col("successes")).alias("errors"),
        round_half_up(total, 3).alias("total_seconds"),
        F.when(has_time, round_half_up(F.col("bytes") / 1048576.0 / total, 3)).otherwise(0.0).alias("throughput_mib_s"),
        F.when(has_time, round_half_up(F.col("successes") / total, 3)).otherwise(0.0).alias("ops_per_second"),
        ms("p50").alias("latency_p50_ms"),
        ms("p95").alias("latency_p95_ms"),
        ms("p99").alias("latency_p99_ms"),
    )


def percentile_table(df: DataFrame, group: str, value: str, ps=(50, 95, 99)) -> DataFrame:
    """A17 over a table: exact percentiles of ``value`` per ``group`` (distributed)."""
    counts = df.groupBy(group).agg(F.count(value).alias("n"))
    pct = exact_percentiles(df, [group], value, ps).drop("n")
    out = _null_safe_join(counts, pct, [group])
    return out.select(group, "n", *[round_half_up(f"p{_label(p)}", 6).alias(f"p{_label(p)}") for p in ps])
