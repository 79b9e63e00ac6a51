"""Table sinks: partitioned Parquet (K1), plain Parquet with coalesce (K2), CSV (K3),
compaction (K4), small-files layout (K5), JSON lines (K6), date-clustered Parquet.

File sizing at scale: a date-partitioned write first goes through a ``REBALANCE`` on the
partition column.  With AQE this is one shuffle that puts every date into one task
(one file per date) while splitting an oversized date across several tasks and merging
small ones, so neither a hot date nor thousands of tiny dates produce pathological files.
``maxRecordsPerFile`` bounds the largest file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bound of a partitioned or clustered table's files; plain writes have none, so that
#: ``coalesce=n`` means n files.
MAX_RECORDS_PER_FILE = 5_000_000


def _file_system(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Whether a file or folder exists, on whatever file system the URI names."""
    system, path = _file_system(spark, uri)
    return system.exists(path)


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder that a job has made, with all below it; one that is gone is fine."""
    system, path = _file_system(spark, uri)
    system.delete(path, True)


def write_partitioned(
    df: DataFrame,
    uri: str,
    mode: str = "overwrite",
    partition_col: str = "pickup_date",
    layout: str = "rebalance",
    tasks: int | None = None,
    observation: Observation | None = None,
    range_cols: tuple[str, ...] = (),
) -> None:
    """K1: ``overwrite`` replaces only the partitions present in ``df`` (dynamic overwrite,
    T11: stale dates survive a rerun); ``append`` adds files (a rerun duplicates rows).

    ``layout``:
    * ``rebalance`` (default, for tables whose rows per date are unbounded, e.g. silver):
      AQE sizes the write tasks from the data and splits a hot date across tasks;
    * ``range`` (for tables with a proven per-date row bound, e.g. gold, whose keys per day
      are bounded by the location/payment domains): ``repartitionByRange(tasks, col)`` keeps
      one file per date and spreads the many small files over ``tasks`` writers, each with a
      contiguous date range.  (A hash ``repartition`` on the grouping key would be folded
      into the aggregate's own exchange, which AQE then coalesces into a single writer.)
      ``range_cols`` extend the range key below the date (e.g. ``pickup_datetime``) so a
      date holding a third of all rows is split by time of day over many writers, while
      every writer still covers a contiguous slice of dates (files ~ dates + tasks).
      The explicit task count is not coalesced by AQE, so a small batch spread over
      thousands of dates is still written by ``tasks`` writers, not by one.

    ``observation`` receives ``rows`` = rows written, counted by the write job itself
    (placed above the repartition so the range-sampling job does not count too).
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unsupported write mode: {mode}")
    if layout == "rebalance":
        out = df.hint("rebalance", partition_col)
    elif layout == "range":
        n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartitionByRange(n, partition_col, *range_cols)
    elif layout == "none":
        out = df
    else:
        raise ValueError(f"unsupported layout: {layout}")
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(partition_col)
        .parquet(uri)
    )


def write_clustered(
    df: DataFrame,
    uri: str,
    mode: str = "overwrite",
    cluster_col: str = "pickup_date",
    observation: Observation | None = None,
    replace_all: bool = False,
) -> None:
    """Non-partitioned Parquet, globally ordered on ``cluster_col``.

    For tables with a bounded number of rows per date (the gold aggregates: one row per
    day, or per day and location pair) a directory per date means one tiny file per row
    group.  Here the global sort is a range exchange that AQE coalesces to the advisory
    partition size, so every file holds a contiguous date range of ~64 MiB and the
    Parquet min/max statistics of ``cluster_col`` skip files and row groups for date
    predicates (``PushedFilters``) much as directory pruning would.  Range bounds are
    sampled from the input's shuffle output, so the upstream scan is not repeated.
    ``overwrite`` replaces the whole table (static), ``append`` adds files.  An overwrite
    that would lose dates of the stored table is refused unless ``replace_all`` says that
    ``df`` is the whole table; a partitioned table is overwritten date by date.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unsupported write mode: {mode}")
    if mode == "overwrite" and not replace_all and path_exists(df.sparkSession, uri):
        stored = df.sparkSession.read.schema(df.schema).parquet(uri)
        lost = stored.select(cluster_col).distinct().join(df.select(cluster_col).distinct(), cluster_col, "left_anti").count()
        if lost:
            raise ValueError(f"{uri}: overwriting would lose {lost} value(s) of {cluster_col}; "
                             "use the partitioned layout, a folder per batch, or replace_all")
    out = df.orderBy(cluster_col)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(uri)
    )


def write_parquet(df: DataFrame, uri: str, coalesce: int = 0, mode: str = "overwrite",
                  max_records_per_file: int = 0) -> None:
    """K2: non-partitioned Parquet; ``coalesce`` > 0 narrows to that many files without a
    shuffle.  ``max_records_per_file`` > 0 splits files that hold more rows."""
    if coalesce < 0:
        raise ValueError("coalesce must be >= 0")
    out = df.coalesce(coalesce) if coalesce else df
    out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(uri)


def write_csv(df: DataFrame, uri: str, coalesce: int = 0, mode: str = "overwrite") -> None:
    """K3: CSV with a header line."""
    out = df.coalesce(coalesce) if coalesce else df
    out.write.mode(mode).option("header", True).csv(uri)


def write_json(df: DataFrame, uri: str, coalesce: int = 0, mode: str = "overwrite") -> None:
    """K6: JSON lines."""
    out = df.coalesce(coalesce) if coalesce else df
    out.write.mode(mode).json(uri)


def compact(df: DataFrame, uri: str, files: int) -> None:
    """K4: rewrite into exactly ``files`` files (n > 0)."""
    if files <= 0:
        raise ValueError("coalesce must be > 0 for compaction")
    df.repartition(files).write.mode("overwrite").parquet(uri)


def small_files(df: DataFrame, uri: str, partitions: int, partition_col: str = "pickup_date") -> None:
    """K5: hash-spread rows of each date over ``partitions`` tasks (explicit count, T17)."""
    if partitions <= 0:
        raise ValueError("partitions must be > 0")
    df.repartition(partitions, partition_col).write.mode("overwrite").parquet(uri)
