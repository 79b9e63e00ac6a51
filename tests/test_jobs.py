"""Generator (G1-G3, A13), metric time series in batch and Structured Streaming (M1-M3,
W4) and the layout benchmark (B5, K2-K5, K10, S4)."""

import os

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import fingerprint, generate, silver
from lakeshore.plans import SQL_DIR, pipeline
from lakeshore.plans.layouts import benchmark_layouts
from lakeshore.plans.runner import load_sql_queries
from lakeshore.sinks.parquet import write_parquet
from lakeshore.sources.metric_samples import counter_samples
from lakeshore.sources.trips import raw_sources
from lakeshore.streaming import metrics
from tests.conftest import SF001


def _fp(df):
    return fingerprint.table_fingerprint(df).first().asDict()


def test_generator_is_deterministic_per_seed_and_partitioning(spark):
    a = generate.generate_from_index(spark.range(0, 5000, 1, 1).withColumnRenamed("id", "idx"), 7, 42)
    b = generate.generate_from_index(spark.range(0, 5000, 1, 7).withColumnRenamed("id", "idx"), 7, 42)
    c = generate.generate_records(spark, 5000, 7, 43)
    assert _fp(a) == _fp(b)
    assert _fp(a) != _fp(c)
    with pytest.raises(ValueError):
        generate.generate_records(spark, 0, 7, 42)
    with pytest.raises(ValueError):
        generate.generate_records(spark, 10, 0, 42)


def test_quality_counts_follow_the_index_rule(spark):
    n = 3000
    counts = {r["quality_case"]: r["records"] for r in generate.quality_counts(generate.generate_records(spark, n, 3, 1)).collect()}
    expected = {}
    for i in range(n):
        case = "valid"
        if i > 0:
            for mod, name in generate.QUALITY_RULES:
                if i % mod == 0:
                    case = name
                    break
        expected[case] = expected.get(case, 0) + 1
    assert counts == expected


def test_duplicate_candidates_are_removed_by_dedup(spark):
    recs = generate.generate_records(spark, 2000, 3, 7)
    raw = generate.to_raw_trips(recs)
    out = silver.silver_trips([raw.drop("record_id")])
    valid_or_dup = recs.where(F.col("quality_case").isin("valid", "duplicate_candidate", "null_passenger_count"))
    dups = recs.where(F.col("quality_case") == "duplicate_candidate").count()
    assert dups > 0
    # every duplicate candidate collapses onto the trip it copies
    assert out.count() <= valid_or_dup.count() - dups


def test_stream_summaries_match_batch_on_closed_windows(spark, scratch):
    samples = counter_samples(spark.read.parquet(os.path.join(SF001, "events.parquet")))
    samples = samples.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("value", F.col("value").cast("double"))
    src = os.path.join(scratch, "samples")
    # two arrival batches in time order
    mid = samples.agg(F.percentile_approx(F.col("ts").cast("long"), 0.5)).first()[0]
    samples.where(F.col("ts").cast("long") <= mid).write.parquet(os.path.join(src, "b1"))
    q = None
    try:
        stream = metrics.stream_summaries(spark, os.path.join(src, "*"), "1 hour", watermark="10 minutes", schema=samples.schema)
        samples.where(F.col("ts").cast("long") > mid).write.parquet(os.path.join(src, "b2"))
        q = (stream.writeStream.format("memory").queryName("rates_test").outputMode("append")
             .option("checkpointLocation", os.path.join(scratch, "ckpt"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        got = spark.table("rates_test")
        batch = metrics.window_summaries(samples, "1 hour")
        max_ts = samples.agg(F.max("ts")).first()[0]
        closed = batch.where(F.col("window_start") + F.expr("INTERVAL 70 MINUTES") <= F.lit(max_ts))
        cols = ["window_start", "metric", "series_label", "samples", "first_value", "last_value",
                F.round("inner_increase", 6)]
        assert got.count() > 0
        assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
        assert closed.select(cols).exceptAll(got.select(cols)).count() == 0
    finally:
        if q is not None:
            q.stop()


def _samples(spark, rows):
    return spark.createDataFrame(rows, "ts string, value double").select(
        F.col("ts").cast("timestamp").alias("ts"), F.lit("c").alias("metric"), F.lit("a").alias("series_label"), "value")


def test_rate_handles_counter_reset(spark):
    df = _samples(spark, [("2025-01-01 00:00:00", 10.0), ("2025-01-01 00:01:00", 15.0),
                          ("2025-01-01 00:02:00", 3.0), ("2025-01-01 00:03:00", 9.0)])
    assert metrics.window_increases(df, "5 minutes").first()["increase"] == 5.0 + 3.0 + 6.0
    assert metrics.stream_window_summaries(df, "5 minutes").first()["inner_increase"] == 14.0


def test_increases_across_window_edges_are_kept(spark):
    rows = [(f"2025-01-01 {m // 60:02d}:{m % 60:02d}:00", 50.0 * (m // 5)) for m in range(0, 600, 5)]
    df = _samples(spark, rows)
    inc = metrics.window_increases(df, "5 minutes")
    assert inc.agg(F.sum("increase")).first()[0] == rows[-1][1] - rows[0][1]
    assert [r["increase"] for r in inc.orderBy("window_start").limit(3).collect()] == [0.0, 50.0, 50.0]
    # a reset between two windows counts the new value
    assert metrics.window_increases(_samples(spark, [("2025-01-01 00:04:00", 9.0), ("2025-01-01 00:06:00", 2.0)]), "5 minutes").agg(
        F.sum("increase")).first()[0] == 2.0
    total = metrics.rate_by(df, "5 minutes", None).agg(F.sum("rate")).first()[0]
    assert abs(total * 300 - rows[-1][1]) < 1e-6


def test_label_patterns_match_whole_labels(spark):
    up = spark.createDataFrame([("spark-worker", "1", 0.0), ("old-spark-worker-2", "1", 0.0), ("airflow", "1", 1.0)],
                               "job string, instance string, value double").withColumn("ts", F.current_timestamp())
    got = metrics.down_targets(up, "spark-master|spark-worker").first()
    assert (got["targets"], got["down_targets"]) == (1, 1)
    assert metrics.latest_values(up, ("job", "instance"), "air.*").count() == 1
    assert metrics.latest_values(up, ("job", "instance"), "air").count() == 0


@pytest.mark.parametrize("comparison,coalesce", [("partition", 0), ("compaction", 2), ("format", 0)])
def test_layout_benchmark_results_are_consistent(spark, scratch, comparison, coalesce):
    uris = []
    for i, df in enumerate(raw_sources(spark, SF001)):
        lo, hi = F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1995-03-02").cast("timestamp_ntz")
        uri = os.path.join(scratch, "bronze", f"p{i}.parquet")
        write_parquet(df.where(F.col("tpep_pickup_datetime").between(lo, hi)), uri)
        uris.append(uri)
    silver_uri = os.path.join(scratch, "silver")
    pipeline.bronze_to_silver(spark, uris, silver_uri)
    silver_files = [p for p in load_sql_queries(SQL_DIR) if p.name[:2] in ("04", "05", "06")]
    out = benchmark_layouts(spark, silver_uri, silver_files, os.path.join(scratch, "layouts"),
                            comparison=comparison, coalesce=coalesce, iterations=1, warmup=0)
    assert len(out["summary"]) == 2 * len(silver_files)
    assert all(r["result_consistent"] for r in out["summary"])
    assert {r["layout"] for r in out["summary"]} == {name for name, _, _ in out["layouts"]}


def test_generated_batch_manifest(spark, scratch):
    import hashlib
    from lakeshore.plans.generated_batch import write_generated_batch
    root = os.path.join(scratch, "gen")
    m = write_generated_batch(spark, 500, 3, 42, root, "2025-01-01T00:00:00+00:00", files_per_format=2)
    assert sum(m["quality_counts"].values()) == 500
    assert {f["format"] for f in m["files"]} == {"jsonl", "csv"} and len(m["files"]) == 4
    for f in m["files"]:
        path = os.path.join(root, f"records_{f['format']}", f["file_name"])
        data = open(path, "rb").read()
        assert len(data) == f["size_bytes"] and hashlib.sha256(data).hexdigest() == f["checksum_sha256"]
    back = spark.read.json(os.path.join(root, "records_jsonl"))
    assert back.count() == 500
    csv = spark.read.option("header", True).csv(os.path.join(root, "records_csv"))
    assert csv.count() == 500
    assert spark.read.json(os.path.join(root, "manifest")).first()["rows"] == 500
    with pytest.raises(ValueError):
        write_generated_batch(spark, 0, 3, 42, root, "x")


def test_rate_stream_restarts_from_its_checkpoint(spark, scratch):
    samples = counter_samples(spark.read.parquet(os.path.join(SF001, "events.parquet")))
    samples = samples.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("value", F.col("value").cast("double"))
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    mid = samples.agg(F.percentile_approx(F.col("ts").cast("long"), 0.5)).first()[0]
    samples.where(F.col("ts").cast("long") <= mid).write.parquet(os.path.join(src, "b1"))
    q = metrics.start_rate_stream(spark, os.path.join(src, "*"), sink, ckpt, window="1 hour",
                                  schema=samples.schema, available_now=True)
    q.awaitTermination(300)
    first = spark.read.parquet(sink).count()
    # new data arrives; a new query on the same checkpoint continues where the first stopped
    samples.where(F.col("ts").cast("long") > mid).write.parquet(os.path.join(src, "b2"))
    q = metrics.start_rate_stream(spark, os.path.join(src, "*"), sink, ckpt, window="1 hour",
                                  schema=samples.schema, available_now=True)
    q.awaitTermination(300)
    out = spark.read.parquet(sink)
    keys = ["window_start", "metric", "series_label"]
    assert out.count() > first > 0
    assert out.groupBy(*keys).count().where("count > 1").count() == 0  # no window written twice
    whole = ["samples", "first_value", "last_value", F.round("inner_increase", 6)]
    batch = metrics.window_summaries(samples, "1 hour").select(*keys, *whole)
    assert out.select(*keys, *whole).exceptAll(batch).count() == 0
    # the steps between windows are added where the summaries are read
    assert metrics.increases(out).count() == out.count()
