"""Pipeline jobs (B1-B3, B6), sinks (K1, K7, K8) and plan properties (S3, pushdown).

Writes use a 60-day window of the sf0.001 raw sources so the date-partitioned tables
stay small; results are compared with the in-memory (unwritten) plans.
"""

import os

import pytest

from pyspark.sql import functions as F

from lakeshore.operators import gold, silver
from lakeshore.plans import pipeline
from lakeshore.sinks.catalog import register_gold_tables
from lakeshore.sinks.parquet import write_parquet, write_partitioned
from lakeshore.sources.trips import raw_sources
from tests.conftest import SF001

WINDOW = ("1995-01-01", "1995-03-02")


TRIP_SCHEMA = ("tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count int, trip_distance double, "
               "PULocationID int, DOLocationID int, payment_type int, fare_amount double, tip_amount double, total_amount double")


def _window(df):
    lo, hi = WINDOW
    return df.where(F.col("tpep_pickup_datetime").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))


def _bronze(spark, root):
    uris = []
    for i, df in enumerate(raw_sources(spark, SF001)):
        uri = os.path.join(root, "bronze", f"yellow_tripdata_part{i}.parquet")
        write_parquet(_window(df), uri)
        uris.append(uri)
    return uris


def _same_rows(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bronze_to_silver_accounts_every_row(spark, scratch):
    uris = _bronze(spark, scratch)
    silver_uri = os.path.join(scratch, "silver")
    m = pipeline.bronze_to_silver(spark, uris, silver_uri)
    assert m["input_rows"] == sum(spark.read.parquet(u).count() for u in uris)
    assert m["input_rows"] == sum(m["invalid_rows_by_reason"].values()) + m["duplicate_rows"] + m["output_rows"]
    assert m["rejected_rows"] == m["input_rows"] - m["output_rows"]
    assert m["duplicate_rows"] > 0  # lines 4-5 are in both sources
    written = spark.read.parquet(silver_uri)
    assert written.count() == m["output_rows"]
    expected = silver.silver_trips([spark.read.parquet(u) for u in uris])
    assert _same_rows(written, expected)
    # dedup is idempotent: silver has one row per trip key
    assert written.groupBy(*silver.DEDUP_KEYS).count().where("count > 1").count() == 0


def test_dynamic_overwrite_keeps_stale_dates_and_append_duplicates(spark, scratch):
    uri = os.path.join(scratch, "t")
    base = silver.silver_trips([_window(df) for df in raw_sources(spark, SF001)])
    write_partitioned(base, uri, "overwrite")
    dates = sorted(r[0] for r in spark.read.parquet(uri).select("pickup_date").distinct().collect())
    first = dates[0]
    one_day = base.where(F.col("pickup_date") == first).limit(1)
    write_partitioned(one_day, uri, "overwrite")
    after = spark.read.parquet(uri)
    # only the rewritten date changed; every other date survived the rerun
    assert after.where(F.col("pickup_date") == first).count() == 1
    assert after.where(F.col("pickup_date") != first).count() == base.where(F.col("pickup_date") != first).count()
    write_partitioned(one_day, uri, "append")
    assert spark.read.parquet(uri).where(F.col("pickup_date") == first).count() == 2


def test_date_predicate_prunes_partitions(spark, scratch):
    uri = os.path.join(scratch, "silver")
    write_partitioned(silver.silver_trips([_window(df) for df in raw_sources(spark, SF001)]), uri)
    df = spark.read.parquet(uri).where(F.col("pickup_date") == F.lit("1995-01-05").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    assert "1995-01-05" in plan


def test_gold_layouts_agree_and_clustered_pushes_date_filters(spark, scratch):
    uris = _bronze(spark, scratch)
    silver_uri = os.path.join(scratch, "silver")
    pipeline.bronze_to_silver(spark, uris, silver_uri)
    m_c = pipeline.silver_to_gold(spark, silver_uri, os.path.join(scratch, "gc"), layout="clustered")
    m_p = pipeline.silver_to_gold(spark, silver_uri, os.path.join(scratch, "gp"), layout="partitioned")
    s = spark.read.parquet(silver_uri)
    for name, build in gold.GOLD_TABLES.items():
        c = spark.read.parquet(os.path.join(scratch, "gc", name))
        p = spark.read.parquet(os.path.join(scratch, "gp", name))
        assert _same_rows(c, p)
        assert _same_rows(c, build(s))
    assert m_c["daily_rows"] == m_p["daily_rows"] == s.select("pickup_date").distinct().count()
    # clustered: files are date-ordered, the date predicate reaches the Parquet scan
    q = spark.read.parquet(os.path.join(scratch, "gc", "location_metrics")).where(
        F.col("pickup_date").between(F.lit("1995-01-10").cast("date"), F.lit("1995-01-20").cast("date"))
    )
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pickup_date), GreaterThanOrEqual(pickup_date" in plan
    with_file = spark.read.parquet(os.path.join(scratch, "gc", "daily_trip_metrics")).select(
        "pickup_date", F.col("_metadata.file_name").alias("f")
    )
    ranges = with_file.groupBy("f").agg(F.min("pickup_date").alias("lo"), F.max("pickup_date").alias("hi"))
    spans = sorted((r.lo, r.hi) for r in ranges.collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # disjoint date ranges per file


def test_external_gold_tables_need_partition_sync(spark, scratch):
    uris = _bronze(spark, scratch)
    silver_uri = os.path.join(scratch, "silver")
    pipeline.bronze_to_silver(spark, uris, silver_uri)
    gold_root = os.path.join(scratch, "gold")
    pipeline.silver_to_gold(spark, silver_uri, gold_root, layout="partitioned")
    schema = "lake_" + os.path.basename(scratch).replace("-", "_")
    from lakeshore.sinks.catalog import create_external_table, GOLD_TABLE_COLUMNS
    create_external_table(spark, schema, "daily_trip_metrics", GOLD_TABLE_COLUMNS["daily_trip_metrics"],
                          os.path.join(gold_root, "daily_trip_metrics"))
    assert spark.table(f"{schema}.daily_trip_metrics").count() == 0
    tables = register_gold_tables(spark, pipeline.gold_uris(gold_root), schema)
    daily = spark.read.parquet(os.path.join(gold_root, "daily_trip_metrics"))
    assert tables["daily_trip_metrics"].count() == daily.count() > 0
    assert tables["payment_metrics"].schema["payment_type"].dataType.simpleString() == "int"


def test_external_tables_read_the_clustered_layout(spark, scratch):
    uris = _bronze(spark, scratch)
    silver_uri, gold_root = os.path.join(scratch, "silver"), os.path.join(scratch, "gold")
    pipeline.bronze_to_silver(spark, uris, silver_uri)
    m = pipeline.silver_to_gold(spark, silver_uri, gold_root, layout="clustered")
    tables = register_gold_tables(spark, pipeline.gold_uris(gold_root), "lake_" + os.path.basename(scratch).replace("-", "_"))
    assert {name: t.count() for name, t in tables.items()} == {
        "daily_trip_metrics": m["daily_rows"], "location_metrics": m["location_rows"], "payment_metrics": m["payment_rows"]}


def _two_days(spark, scratch, day):
    trips = [(f"{day} 10:00:0{i}", f"{day} 11:00:00", i, 1.5, 1, 2, 1, 5.0, 1.0, 7.0) for i in range(3)]
    uri = os.path.join(scratch, f"silver-{day}")
    silver.silver_trips([spark.createDataFrame(trips, TRIP_SCHEMA)]).write.partitionBy("pickup_date").parquet(uri)
    return uri


def test_a_write_registers_the_dates_that_it_observed(spark, scratch):
    schema, gold_root = "lake_" + os.path.basename(scratch).replace("-", "_"), os.path.join(scratch, "gold")
    for n, day in enumerate(("2025-01-01", "2025-02-01"), 1):
        out = pipeline.silver_to_gold(spark, _two_days(spark, scratch, day), gold_root)
        assert out["dates"] == [day]
        tables = register_gold_tables(spark, pipeline.gold_uris(gold_root), schema, out["dates"])
        assert {name: t.select("pickup_date").distinct().count() for name, t in tables.items()} == dict.fromkeys(tables, n)


def test_a_changed_layout_or_place_is_an_error(spark, scratch):
    schema = "lake_" + os.path.basename(scratch).replace("-", "_")
    uri = _two_days(spark, scratch, "2025-01-01")
    roots = {layout: os.path.join(scratch, layout) for layout in ("partitioned", "clustered")}
    for layout, root in roots.items():
        pipeline.silver_to_gold(spark, uri, root, layout=layout)
    register_gold_tables(spark, pipeline.gold_uris(roots["partitioned"]), schema)
    with pytest.raises(ValueError, match="is partitioned by"):
        register_gold_tables(spark, pipeline.gold_uris(roots["clustered"]), schema)
    pipeline.silver_to_gold(spark, uri, os.path.join(scratch, "moved"))
    with pytest.raises(ValueError, match="lies in"):
        register_gold_tables(spark, pipeline.gold_uris(os.path.join(scratch, "moved")), schema)


def test_date_parameters_open_no_file(spark, scratch):
    from lakeshore.plans.runner import query_parameters, stored_parameters

    uri, gold_root = os.path.join(scratch, "silver"), os.path.join(scratch, "gold")
    silver.silver_trips([_window(df) for df in raw_sources(spark, SF001)]).write.partitionBy("pickup_date").parquet(uri)
    os.makedirs(os.path.join(uri, "pickup_date=2099-01-01"))  # a folder without files
    pipeline.silver_to_gold(spark, uri, gold_root)
    daily = pipeline.gold_uris(gold_root)["daily_trip_metrics"]
    want = query_parameters(spark.read.parquet(uri), spark.read.parquet(daily))
    spark.sparkContext.setJobGroup("date-parameters", "listing only")
    assert stored_parameters(spark, uri, daily) == want
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("date-parameters") == []
    spark.sparkContext.setJobGroup("", "")
    pipeline.silver_to_gold(spark, uri, os.path.join(scratch, "clustered"), layout="clustered")
    assert stored_parameters(spark, uri, pipeline.gold_uris(os.path.join(scratch, "clustered"))["daily_trip_metrics"]) == want


@pytest.mark.parametrize("layout", ["partitioned", "clustered"])
def test_gold_of_a_second_batch_keeps_the_first(spark, scratch, layout):
    gold_root = os.path.join(scratch, "gold")
    rows = {"2025-01-01": 3, "2025-02-01": 2}
    for day, n in rows.items():
        trips = [(f"{day} 10:00:0{i}", f"{day} 11:00:00", i, 1.5, 1, 2, 1, 5.0, 1.0, 7.0, "kept") for i in range(n)]
        raw = spark.createDataFrame(trips, TRIP_SCHEMA + ", airport_fee string")
        silver.silver_trips([raw]).write.partitionBy("pickup_date").parquet(os.path.join(scratch, day))
        if layout == "clustered" and day == "2025-02-01":
            with pytest.raises(ValueError, match="would lose 1 value"):
                pipeline.silver_to_gold(spark, os.path.join(scratch, day), gold_root, layout=layout)
            rows.pop("2025-02-01")
            break
        pipeline.silver_to_gold(spark, os.path.join(scratch, day), gold_root, layout=layout)
    daily = spark.read.parquet(os.path.join(gold_root, "daily_trip_metrics"))
    assert {str(r["pickup_date"]): r["trip_count"] for r in daily.collect()} == rows


def test_source_columns_reach_silver(spark, scratch):
    raw = spark.createDataFrame([("2025-01-01 10:00:00", "2025-01-01 10:10:00", "1.0", "2.5", 1.0, 2, "1", 3.0, 1.0, 4.0, "fee", 7),
                                 ("2025-01-01 11:00:00", "2025-01-01 11:10:00", "x", "2.5", 3e9, 2, None, 3.0, 1.0, 4.0, None, 8)],
                                TRIP_SCHEMA.replace("passenger_count int", "passenger_count string").replace("trip_distance double", "trip_distance string")
                                .replace("PULocationID int", "PULocationID double").replace("payment_type int", "payment_type string")
                                + ", `odd name` string, extra int")
    uri = os.path.join(scratch, "src.parquet")
    raw.write.parquet(uri)
    pipeline.bronze_to_silver(spark, [uri], os.path.join(scratch, "all"))
    got = {r["extra"]: r for r in spark.read.parquet(os.path.join(scratch, "all")).collect()}
    assert (got[7]["passenger_count"], got[7]["odd name"], got[7]["trip_distance"], got[7]["payment_type"]) == (1, "fee", 2.5, 1)
    assert (got[8]["passenger_count"], got[8]["pu_location_id"]) == (None, None)
    pipeline.bronze_to_silver(spark, [uri], os.path.join(scratch, "some"), passthrough=["extra"])
    assert set(spark.read.parquet(os.path.join(scratch, "some")).columns) == {*silver.SILVER_COLUMNS, "extra"}


def test_sums_drop_no_digits_and_never_fail(spark, tmp_path):
    """Gold and the query files against plain double sums, where decimals are lossy."""
    import math

    from lakeshore.plans import SQL_DIR
    from lakeshore.plans.runner import lazy_parameters, load_sql_queries, run_sql
    from lakeshore.sources.tables import register_views

    days = {"2025-01-01": [0.00001, 0.00001], "2025-01-02": [1e15, 0.5], "2025-01-03": [float("nan"), 4.0], "2025-01-04": [1e300, 1.0],
            "2025-01-05": [1.00005, 1.00005], "2025-01-06": [1 / 3, 2 / 3]}
    trips = [(f"{d} 10:00:0{i}", f"{d} 11:00:00", 1, v, k, 2, k, v, v, v) for k, (d, vs) in enumerate(days.items()) for i, v in enumerate(vs)]
    s = silver.silver_trips([spark.createDataFrame(trips, TRIP_SCHEMA)])

    def same(a, b):
        return math.isclose(a, b, rel_tol=1e-15) or (math.isnan(a) and math.isnan(b))

    for table in (gold.daily_trip_metrics(s), gold.split_gold(gold.gold_measures(s))["daily_trip_metrics"]):
        for r in table.collect():
            vs = days[str(r["pickup_date"])]
            assert same(r["total_tip"], sum(vs)) and same(r["total_revenue"], sum(vs)) and same(r["avg_trip_distance"], sum(vs) / 2)
    register_views(spark, {"silver_trips": s, **{n: build(s) for n, build in gold.GOLD_TABLES.items()}})
    params = lazy_parameters(s)
    out = {p.stem[:2]: run_sql(spark, p, params).collect() for p in load_sql_queries(SQL_DIR)}
    total = {k: sum(vs) for k, vs in enumerate(days.values())}
    assert all(same(r["total_revenue"], total[r["pu_location_id"]]) for r in out["02"])
    assert all(same(r["avg_tip_per_trip"], total[r["payment_type"]] / 2) for r in out["03"])
    assert math.isnan(out["04"][0]["avg_trip_distance"])
    assert same(out["05"][0]["total_revenue"], 2e-5)
    assert all(same(r["avg_trip_distance"], total[r["pu_location_id"]] / 2) for r in out["06"])


def test_run_pipeline_writes_metrics_and_runs_every_query(spark, scratch):
    uris = _bronze(spark, scratch)
    out = pipeline.run_pipeline(spark, uris, os.path.join(scratch, "lake"), metrics_dir=os.path.join(scratch, "m"),
                                year="1995", month="01")
    smoke = out["query_smoke"]
    assert smoke["query_count"] == 6
    rows = {q["query_name"]: q["rows_returned"] for q in smoke["queries"]}
    assert rows["04_hourly_distance_fare"] <= 24 and rows["05_selective_pickup_date"] == 1
    assert all(len(q["sample_rows"]) == min(5, q["rows_returned"]) for q in smoke["queries"])
    m = pipeline.read_metrics(spark, pipeline.metrics_path(os.path.join(scratch, "m"), "bronze_to_silver", "1995", "01"))
    row = m.first()
    assert row["output_rows"] == out["bronze_to_silver"]["output_rows"]


def test_query_benchmark_records_feed_the_run_summary(spark, scratch):
    from lakeshore.operators import stats
    from lakeshore.plans import SQL_DIR
    from lakeshore.plans.runner import benchmark_queries, load_sql_queries, query_parameters
    from lakeshore.sources.records import RUN_RECORD_SCHEMA, records_frame
    import pytest

    uris = _bronze(spark, scratch)
    lake = os.path.join(scratch, "lake")
    pipeline.run_pipeline(spark, uris, lake)
    frames = pipeline.register_tables(spark, os.path.join(lake, "silver", "trips"), os.path.join(lake, "gold"))
    params = query_parameters(frames["silver_trips"], frames["daily_trip_metrics"])
    files = load_sql_queries(SQL_DIR)
    with pytest.raises(ValueError):
        benchmark_queries(spark, files, params, iterations=0)
    recs = benchmark_queries(spark, files, params, iterations=2, warmup=1)
    assert len(recs) == 3 * len(files)
    assert all(r["status"] == "success" for r in recs)
    summary = {r["query_name"]: r for r in stats.run_summary(records_frame(spark, recs, RUN_RECORD_SCHEMA)).collect()}
    assert set(summary) == {p.stem for p in files}
    assert all(r["runs"] == 2 and r["rows_returned"] != "inconsistent" for r in summary.values())
    assert all(r["min_seconds"] <= r["median_seconds"] <= r["p95_seconds"] <= r["max_seconds"] for r in summary.values())


def test_range_write_keeps_writer_count_and_rows(spark, scratch):
    base = silver.silver_trips([_window(df) for df in raw_sources(spark, SF001)])
    uri = os.path.join(scratch, "ranged")
    write_partitioned(base, uri, layout="range", range_cols=("pickup_datetime",), tasks=4)
    back = spark.read.parquet(uri)
    assert _same_rows(back, base)
    writers = back.select(F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).alias("w")).distinct()
    assert writers.count() == 4


def test_grouping_sets_gold_equals_separate_aggregates(spark):
    from tests.conftest import SF01
    s = silver.silver_trips(raw_sources(spark, SF01))
    split = gold.split_gold(gold.gold_measures(s))
    for name, build in gold.GOLD_TABLES.items():
        assert split[name].columns == build(s).columns
        assert _same_rows(split[name], build(s)), name
    assert split["payment_metrics"].where(F.col("payment_type").isNull()).count() > 0


def test_bronze_to_silver_from_manifest(spark, scratch):
    import json
    import pytest
    uris = _bronze(spark, scratch)
    root = os.path.join(scratch, "bronze")
    files = [{"role": "source", "format": "parquet", "file_name": os.path.basename(u),
              "bronze_key": os.path.relpath(u, root), "row_count": spark.read.parquet(u).count()} for u in uris]
    manifest = {"manifest_version": "v1", "dataset": "nyc_taxi", "taxi_type": "yellow", "year": "1995",
                "month": "01", "bronze_bucket": "bronze", "files": files}
    mpath = os.path.join(scratch, "manifest.json")
    with open(mpath, "w") as fh:
        json.dump(manifest, fh, indent=2)
    out_root = os.path.join(scratch, "silver_root")
    m = pipeline.bronze_to_silver_from_manifest(spark, mpath, "silver", bronze_root=root, silver_root=out_root)
    assert m["input_rows"] == sum(f["row_count"] for f in files)
    assert m["silver_uri"].endswith(os.path.join("year=1995", "month=01"))
    written = spark.read.parquet(m["silver_uri"])
    assert written.count() == m["output_rows"]
    assert "year" not in written.columns and "month" not in written.columns  # T10
    manifest["dataset"] = "other"
    bad = os.path.join(scratch, "bad.json")
    with open(bad, "w") as fh:
        json.dump(manifest, fh)
    with pytest.raises(ValueError, match="Unsupported dataset"):
        pipeline.bronze_to_silver_from_manifest(spark, bad, "silver", bronze_root=root, silver_root=out_root)


def test_batch_paths():
    assert pipeline.metrics_path("/out", "job", "2025", "01") == "/out/job/year=2025/month=01/metrics.json"
    uris = pipeline.gold_uris("s3a://datalake-gold", "2025", "01")
    assert uris["daily_trip_metrics"] == "s3a://datalake-gold/daily_trip_metrics/year=2025/month=01"
    assert uris["location_metrics"] == "s3a://datalake-gold/location_metrics/year=2025/month=01"
    assert uris["payment_metrics"] == "s3a://datalake-gold/payment_metrics/year=2025/month=01"


def test_sources_with_one_schema_share_a_scan(spark, scratch):
    a, b = raw_sources(spark, SF001)
    root = os.path.join(scratch, "bronze")
    uris = []
    for name, df in (("a1", a.where("PULocationID % 2 = 0")), ("b", b), ("a2", a.where("PULocationID % 2 = 1"))):
        uri = os.path.join(root, f"{name}.parquet")
        write_parquet(_window(df), uri)
        uris.append(uri)
    groups = pipeline.group_sources_by_schema(spark, uris)
    assert groups == [[uris[0], uris[2]], [uris[1]]]
    m = pipeline.bronze_to_silver(spark, uris, os.path.join(scratch, "silver"))
    assert m["source_schema_count"] == 2 and m["source_file_count"] == 3
    assert m["input_rows"] == sum(spark.read.parquet(u).count() for u in uris)
    expected = silver.silver_trips([spark.read.parquet(u) for u in uris])
    assert _same_rows(spark.read.parquet(os.path.join(scratch, "silver")), expected)


def test_non_finite_amounts_propagate_like_a_double_sum(spark):
    rows = [("2025-01-01 10:00:00", "2025-01-01 10:10:00", 1, 1.0, 1, 2, 1, 10.0, 1.0, 12.0),
            ("2025-01-01 11:00:00", "2025-01-01 11:10:00", 1, 2.0, 1, 2, 1, float("nan"), 1.0, 12.0),
            ("2025-01-02 11:00:00", "2025-01-02 11:10:00", 1, 2.0, 1, 2, 1, float("inf"), 1.5, 13.0)]
    raw = spark.createDataFrame(rows, TRIP_SCHEMA)
    s = silver.silver_trips([raw])
    assert s.count() == 3  # NaN >= 0 and Inf >= 0 pass the filter (T5)
    by_day = {r["pickup_date"].isoformat(): r for r in gold.daily_trip_metrics(s).collect()}
    split = {r["pickup_date"].isoformat(): r for r in gold.split_gold(gold.gold_measures(s))["daily_trip_metrics"].collect()}
    import math
    for table in (by_day, split):
        assert math.isnan(table["2025-01-01"]["fare_revenue"])
        assert table["2025-01-02"]["fare_revenue"] == float("inf")
        assert table["2025-01-01"]["total_revenue"] == 24.0 and table["2025-01-01"]["total_tip"] == 2.0


def test_job_cli_runs_the_chain(spark, scratch, capsys):
    import json
    from lakeshore import jobs
    uris = _bronze(spark, scratch)
    root = os.path.join(scratch, "bronze")
    files = [{"bronze_key": os.path.relpath(u, root)} for u in uris]
    mpath = os.path.join(scratch, "m.json")
    with open(mpath, "w") as fh:
        json.dump({"dataset": "nyc_taxi", "taxi_type": "yellow", "year": "1995", "month": "01",
                   "bronze_bucket": "bronze", "files": files}, fh)
    lake, mdir = os.path.join(scratch, "lake"), os.path.join(scratch, "metrics")
    assert jobs.main(["--metrics-dir", mdir, "bronze-to-silver", "--manifest", mpath, "--silver-bucket", "silver",
                      "--bronze-root", root, "--silver-root", lake]) == 0
    silver_uri = os.path.join(lake, "nyc-taxi", "year=1995", "month=01")
    batch = ["--year", "1995", "--month", "01"]
    assert jobs.main([*batch, "silver-to-gold", "--silver-uri", silver_uri, "--gold-root", os.path.join(lake, "gold")]) == 0
    assert os.path.isdir(os.path.join(lake, "gold", "daily_trip_metrics", "year=1995", "month=01"))
    assert jobs.main([*batch, "query-benchmark", "--silver-uri", silver_uri, "--gold-root", os.path.join(lake, "gold"),
                      "--iterations", "1", "--warmup", "0"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert len(json.loads(out[-1])["summary"]) == 6
    m = pipeline.read_metrics(spark, pipeline.metrics_path(mdir, "bronze_to_silver", "1995", "01")).first()
    assert m["output_rows"] > 0
    assert jobs.main(["silver-to-gold", "--silver-uri", os.path.join(scratch, "missing"),
                      "--gold-root", os.path.join(lake, "g2")]) == 1
