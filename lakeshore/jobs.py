"""Command-line entry for ``spark-submit`` (one subcommand per job).

    spark-submit lakeshore/jobs.py bronze-to-silver --manifest s3a://.../manifest.json \
        --silver-bucket datalake-silver --metrics-dir s3a://.../metrics
    spark-submit lakeshore/jobs.py --year 2025 --month 01 silver-to-gold --silver-uri ... --gold-root ...
    spark-submit lakeshore/jobs.py query-smoke --silver-uri ... --gold-root ...
    spark-submit lakeshore/jobs.py query-benchmark --silver-uri ... --gold-root ... --iterations 3 --warmup 1
    spark-submit lakeshore/jobs.py layout-benchmark --silver-uri ... --scratch ... --comparison partition
    spark-submit lakeshore/jobs.py generate --rows 100000 --days 7 --seed 42 --output ...

``--year/--month`` (before the subcommand) name the batch: gold tables then live under
``<gold root>/<table>/year=/month=`` and metrics under ``<metrics>/<job>/year=/month=``.
Every subcommand builds (or reuses) the session, runs one plan function and, with
``--metrics-dir``, writes its metrics record through Spark.  Exit code 0 on success,
1 on failure (the message goes to stderr).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys
from typing import Any

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeshore.plans import SQL_DIR  # noqa: E402
from lakeshore.plans import pipeline  # noqa: E402
from lakeshore.plans.generated_batch import write_generated_batch  # noqa: E402
from lakeshore.plans.layouts import COMPARISONS, benchmark_layouts  # noqa: E402
from lakeshore.plans.runner import benchmark_queries, load_sql_queries, query_parameters  # noqa: E402
from lakeshore.operators.stats import run_summary  # noqa: E402
from lakeshore.session import build_session  # noqa: E402
from lakeshore.sinks.parquet import write_json  # noqa: E402
from lakeshore.sources.records import RUN_RECORD_SCHEMA, records_frame  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeshore-jobs")
    p.add_argument("--metrics-dir", default=None)
    p.add_argument("--records-dir", default=None, help="benchmarks: append the run records there as JSON lines")
    p.add_argument("--year", default=None, help="batch year for metrics paths")
    p.add_argument("--month", default=None, help="batch month for metrics paths")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("bronze-to-silver")
    s.add_argument("--manifest", required=True)
    s.add_argument("--silver-bucket", required=True)
    s.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    s.add_argument("--bronze-root", default=None, help="folder replacing the bronze bucket")
    s.add_argument("--silver-root", default=None, help="folder replacing the silver bucket")
    s.add_argument("--passthrough", nargs="*", default=None, help="untyped source columns to carry (default: all)")

    g = sub.add_parser("silver-to-gold")
    g.add_argument("--silver-uri", required=True)
    g.add_argument("--gold-root", required=True)
    g.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    g.add_argument("--layout", choices=pipeline.GOLD_LAYOUTS, default="partitioned")
    g.add_argument("--replace-all", action="store_true", help="clustered overwrite: the silver given is all there is")

    q = sub.add_parser("query-smoke")
    q.add_argument("--silver-uri", required=True)
    q.add_argument("--gold-root", required=True)
    q.add_argument("--sql-dir", default=str(SQL_DIR))
    q.add_argument("--sample-limit", type=int, default=5)

    b = sub.add_parser("query-benchmark")
    b.add_argument("--silver-uri", required=True)
    b.add_argument("--gold-root", required=True)
    b.add_argument("--sql-dir", default=str(SQL_DIR))
    b.add_argument("--iterations", type=int, default=3)
    b.add_argument("--warmup", type=int, default=1)
    b.add_argument("--run-id", default="local")

    lb = sub.add_parser("layout-benchmark")
    lb.add_argument("--silver-uri", required=True)
    lb.add_argument("--scratch", required=True, help="shared folder for the generated layouts")
    lb.add_argument("--sql-dir", default=str(SQL_DIR))
    lb.add_argument("--comparison", choices=COMPARISONS, default="partition")
    lb.add_argument("--coalesce", type=int, default=0)
    lb.add_argument("--iterations", type=int, default=1)
    lb.add_argument("--warmup", type=int, default=0)
    lb.add_argument("--keep-layout", action="store_true")

    gen = sub.add_parser("generate")
    gen.add_argument("--rows", type=int, required=True)
    gen.add_argument("--days", type=int, default=7)
    gen.add_argument("--seed", type=int, default=42)
    gen.add_argument("--output", required=True)
    gen.add_argument("--files-per-format", type=int, default=0)
    return p


def run(args: argparse.Namespace) -> dict[str, Any]:
    spark = build_session(f"lakeshore-{args.job}")
    if args.job == "bronze-to-silver":
        out = pipeline.bronze_to_silver_from_manifest(
            spark, args.manifest, args.silver_bucket, args.mode, args.bronze_root, args.silver_root, args.passthrough)
        args.year, args.month = args.year or out["batch_year"], args.month or out["batch_month"]
        return out
    if args.job == "silver-to-gold":
        return pipeline.silver_to_gold(spark, args.silver_uri, args.gold_root, args.mode, args.layout,
                                       args.year, args.month, args.replace_all)
    if args.job == "query-smoke":
        from pathlib import Path
        return pipeline.query_smoke(spark, args.silver_uri, args.gold_root, Path(args.sql_dir), args.sample_limit,
                                    args.year, args.month)
    if args.job == "query-benchmark":
        frames = pipeline.register_tables(spark, args.silver_uri, args.gold_root, args.year, args.month)
        params = query_parameters(frames["silver_trips"], frames["daily_trip_metrics"])
        records = benchmark_queries(spark, load_sql_queries(args.sql_dir), params,
                                    args.iterations, args.warmup, args.run_id)
        summary = run_summary(records_frame(spark, records, RUN_RECORD_SCHEMA)).collect()
        if args.records_dir:
            write_json(records_frame(spark, records, RUN_RECORD_SCHEMA), args.records_dir, 1, "append")
        return {"job_name": "query_benchmark", "records": records, "summary": [r.asDict() for r in summary]}
    if args.job == "layout-benchmark":
        out = benchmark_layouts(spark, args.silver_uri, load_sql_queries(args.sql_dir), args.scratch,
                                args.comparison, args.coalesce, args.iterations, args.warmup, args.keep_layout)
        if args.records_dir:
            write_json(records_frame(spark, out["records"], RUN_RECORD_SCHEMA), args.records_dir, 1, "append")
        return {"job_name": "layout_benchmark", **out}
    if args.job == "generate":
        stamp = dt.datetime.now(dt.timezone.utc).replace(microsecond=0).isoformat()
        return {"job_name": "generate", **write_generated_batch(
            spark, args.rows, args.days, args.seed, args.output, stamp, args.files_per_format)}
    raise ValueError(f"unknown job {args.job}")


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    try:
        # a manifest names its batch; the other jobs need it before they begin
        if args.metrics_dir and args.job != "bronze-to-silver" and not (args.year and args.month):
            raise ValueError("--metrics-dir needs --year and --month")
        out = run(args)
        if args.metrics_dir:
            spark = build_session(f"lakeshore-{args.job}")
            name = args.job.replace("-", "_")
            pipeline.write_metrics(spark, pipeline.metrics_path(args.metrics_dir, name, args.year, args.month), out)
        print(json.dumps({k: v for k, v in out.items() if k not in ("records", "queries")}, default=str))
        return 0
    except Exception as exc:  # report and fail the submit
        print(f"{args.job} failed: {exc}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
