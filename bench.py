"""Benchmark: bronze -> silver -> gold pipeline and the six headline queries.

Reads the driver tables at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1), runs on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

Steps (mirroring the reference's published timings):
* ingest (untimed): the two raw trip sources are written as bronze Parquet files;
* bronze_to_silver / silver_to_gold: the pipeline jobs, timed end to end;
* q01..q06: each SQL file over the written silver/gold tables, executed through the
  ``noop`` sink; 1 warm-up + 3 measured runs, median reported;
* layouts (reported separately, not in the total): the layout benchmark's three
  comparisons (date-partitioned vs flat silver, small files vs compacted, CSV vs
  Parquet; compaction to one file per core) on q04..q06 with result fingerprints;
  1 warm-up + 2 measured runs, median;
* folded (reported separately): q04 and q06 over the same silver rows folded into as many
  dates as the reference's month has (33), since the fixture's 2,400 dates of some 120 rows
  each measure the opening of files rather than the queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeshore.plans import SQL_DIR  # noqa: E402
from lakeshore.plans.layouts import benchmark_layouts  # noqa: E402
from lakeshore.plans.pipeline import bronze_to_silver, register_tables, silver_to_gold  # noqa: E402
from lakeshore.plans.runner import execute_timed, load_sql_queries, query_parameters, run_sql  # noqa: E402
from lakeshore.session import build_session  # noqa: E402
from lakeshore.sinks.parquet import write_parquet, write_partitioned  # noqa: E402
from lakeshore.sources.tables import register_views  # noqa: E402
from lakeshore.sources.trips import raw_sources  # noqa: E402


#: Dates of the reference's month.
FOLDED_DATES = 33


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="lakeshore-bench-")
    spark = build_session(
        "lakeshore-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": "16g", "spark.local.dir": scratch},
    )
    spark.sparkContext.setLogLevel("ERROR")

    bronze = []
    for i, df in enumerate(raw_sources(spark, sf_dir)):
        uri = os.path.join(scratch, "bronze", f"yellow_tripdata_part{i}.parquet")
        write_parquet(df, uri)
        bronze.append(uri)

    timings: dict[str, float] = {}
    silver_uri = os.path.join(scratch, "silver", "trips")
    gold_root = os.path.join(scratch, "gold")
    t = time.perf_counter()
    b1 = bronze_to_silver(spark, bronze, silver_uri)
    timings["bronze_to_silver"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    b2 = silver_to_gold(spark, silver_uri, gold_root, layout="clustered")
    timings["silver_to_gold"] = round(time.perf_counter() - t, 3)

    frames = register_tables(spark, silver_uri, gold_root)
    params = query_parameters(frames["silver_trips"], frames["daily_trip_metrics"])
    rows = {}
    for path in load_sql_queries(SQL_DIR):
        name = "q" + path.stem.split("_", 1)[0]
        runs = []
        for i in range(4):
            started = time.perf_counter()
            n, _ = execute_timed(run_sql(spark, path, params))
            if i:
                runs.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(runs), 3)
        rows[name] = n

    layout_files = [p for p in load_sql_queries(SQL_DIR) if p.name[:2] in ("04", "05", "06")]
    layouts = {}
    for comparison, coalesce in (("partition", 0), ("compaction", int(cpus)), ("format", 0)):
        out = benchmark_layouts(spark, silver_uri, layout_files, os.path.join(scratch, "layouts"),
                                comparison=comparison, coalesce=coalesce, iterations=2, warmup=1)
        per = {}
        for r in out["summary"]:
            per.setdefault(r["layout"], {})["q" + r["query_name"][:2]] = r["median_seconds"]
        per["result_consistent"] = all(r["result_consistent"] for r in out["summary"])
        layouts[comparison] = per

    folded_uri = os.path.join(scratch, "silver", "folded")
    days = F.pmod(F.datediff("pickup_date", F.lit("2001-01-01")), F.lit(FOLDED_DATES))
    write_partitioned(spark.read.parquet(silver_uri).withColumn("pickup_date", F.date_add(F.lit("2001-01-01"), days)), folded_uri)
    register_views(spark, {"silver_trips": spark.read.parquet(folded_uri)})
    folded = {}
    for path in (p for p in layout_files if p.name[:2] in ("04", "06")):
        seconds = [execute_timed(run_sql(spark, path, params))[1] for _ in range(4)]
        folded["q" + path.name[:2]] = round(statistics.median(seconds[1:]), 3)

    print(json.dumps({
        "metric": "pipeline_plus_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "rows": {"silver": b1["output_rows"], "rejected": b1["rejected_rows"],
                 "daily": b2["daily_rows"], "location": b2["location_rows"],
                 "payment": b2["payment_rows"], **rows},
        "cpus": int(cpus),
        "layouts": layouts,
        "folded": folded,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
