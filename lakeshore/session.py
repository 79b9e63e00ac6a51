"""SparkSession factory.

Settings that change results are pinned here (UTC session zone, dynamic partition
overwrite); the rest are scale defaults that a cluster submit may override.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL defaults; each applies only when the cluster configuration (spark-defaults,
# ``spark-submit --conf``) has not set the key, so a cluster's tuning always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # ~128 MiB input splits; 64 MiB is the target when AQE splits a skewed partition
    # (and when it coalesces, on clusters that set parallelismFirst=false).
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * 1024 * 1024),
    # Floor for AQE coalescing.  A small batch spread over thousands of dates (a ~1 MiB
    # REBALANCE by pickup_date) keeps about one writer per core instead of collapsing to
    # a single writer of every date file; large shuffles are far above the floor.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Settings that change results: always applied (T8 zone, T11 overwrite semantics).
_PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# Static settings that must exist before the context starts (no web UI server).
_STATIC_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "lakeshore",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session.

    ``master`` / ``shuffle_partitions`` fall back to ``LAKESHORE_MASTER`` /
    ``LAKESHORE_SHUFFLE_PARTITIONS`` and then to Spark's own defaults, so the
    same code runs under ``spark-submit`` on a cluster and in local tests.  ``extra``
    settings are explicit and always applied; the SQL defaults above only fill gaps.
    """
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("LAKESHORE_MASTER")
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or os.environ.get("LAKESHORE_SHUFFLE_PARTITIONS")
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    for key, value in {**_STATIC_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in _PINNED.items():
        spark.conf.set(key, value)
    apply_defaults(spark, _DEFAULTS | _listing_defaults(spark), explicit=extra or {})
    return spark


#: Spark's own limit of the tasks that list a table's directories, and the tasks a core.
MOST_LISTING_TASKS, LISTING_TASKS_PER_CORE = 10_000, 4


def _listing_defaults(spark: SparkSession) -> dict[str, str]:
    """Directories of a partitioned table are listed by a job.  Spark gives each directory a
    task of its own up to its limit, which costs more than the listing where there are
    thousands of dates and few cores; a few tasks a core list many directories each."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect: the server's own setting applies
        return {}
    tasks = min(MOST_LISTING_TASKS, LISTING_TASKS_PER_CORE * cores)
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}


def apply_defaults(spark: SparkSession, defaults: dict[str, str], explicit: dict[str, str] | None = None) -> list[str]:
    """Set each default the cluster configuration leaves unset; returns the keys set."""
    try:
        cluster = spark.sparkContext.getConf()
        configured = {k for k, _ in cluster.getAll()}
    except Exception:  # Spark Connect: only the session's own values are visible
        configured = set()
    applied = []
    for key, value in defaults.items():
        if key in configured or key in (explicit or {}):
            continue
        spark.conf.set(key, value)
        applied.append(key)
    return applied


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder, setting a scratch one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object-store) folder and is
    used as is (a cluster without it is an error); only ``local[...]`` runs without it
    get a fresh temporary folder.  Called by the jobs that checkpoint, not at session
    start.  A Spark Connect session has no driver-side context: its server's own
    checkpoint setting applies.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        # executors on other machines cannot read a folder local to this one
        raise ValueError("spark.checkpoint.dir must name a shared folder (HDFS / object store) on a cluster")
    path = tempfile.mkdtemp(prefix="lakeshore-ckpt-")
    sc.setCheckpointDir(path)
    return path
