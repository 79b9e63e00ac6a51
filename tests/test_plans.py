"""Plan properties that make the jobs safe when one key holds a third of all rows:
aggregation is partial on the map side before every shuffle, nothing collects a whole
group, and scans read only the needed columns."""

from pyspark.sql import functions as F

from lakeshore.operators import gold, media, silver, stats
from lakeshore.plans.registry import all_queries
from lakeshore.sources.media import api_payloads
from lakeshore.sources.tables import read_table
from lakeshore.sources.trips import raw_sources
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_partial_before_the_key_shuffle(spark):
    df = silver.silver_trips(raw_sources(spark, SF001))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by(" in plan
    assert "hashpartitioning(pickup_datetime" in plan


def test_gold_measures_are_hash_aggregates_without_expand(spark):
    s = silver.silver_trips(raw_sources(spark, SF001))
    tables = gold.split_gold(gold.gold_measures(s))
    for name, df in tables.items():
        plan = _plan(df)
        assert "Expand" not in plan and "SortAggregate" not in plan, name
        assert "partial_try_sum(" in plan or "partial_sum(" in plan
    # the daily table comes from the payment grain: no aggregate of silver rows by date alone
    assert "keys=[pickup_date" in _plan(tables["daily_trip_metrics"]) and "payment_type" in _plan(tables["daily_trip_metrics"])
    written = s.select("*")
    location = _plan(gold.gold_measures(written)["location"])
    assert "fare_amount" not in location.split("ReadSchema")[-1]


def test_first_occurrences_use_a_partial_min_by(spark):
    hits = media.flatten_api_payload(api_payloads(read_table(spark, SF001, "events")), keep=("pos", "query", "query_idx"))
    plan = media.first_occurrences(hits)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by(" in plan
    assert "Window" not in plan


def test_exact_percentiles_have_no_per_group_buffer(spark):
    ev = read_table(spark, SF001, "events")
    plan = _plan(stats.percentile_table(ev, "event_type", "value"))
    assert "percentile(" not in plan
    assert "partial_count(" in plan


def test_silver_write_rebalances_on_the_date(spark):
    df = silver.silver_trips(raw_sources(spark, SF001)).hint("rebalance", "pickup_date")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [pickup_date" in plan


def test_scans_read_only_needed_columns(spark):
    q = silver.silver_trips(raw_sources(spark, SF001)).groupBy(F.hour("pickup_datetime")).count()
    plan = _plan(q)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int" in plan
    assert "l_returnflag" not in plan and "o_totalprice" not in plan


def test_sources_and_parameters_share_the_shuffle_of_lineitem(spark):
    """Both sources, and the query that finds the date, read one shuffle of each table."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for key, value in zip(saved, ("false", "-1")):
        spark.conf.set(key, value)
    try:
        for name in ("q05_selective_pickup_date", "q02_top_pickup_locations", "query_row_counts", "silver_type_drift"):
            plan = all_queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
            shuffles = {line.split("plan_id=")[1] for line in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in line and "Reused" not in line}
            assert len(shuffles) == 1, name
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_sources_hold_their_lines(spark, scratch):
    lines = [(1, 7, 3, n, 5.0, 100.0, 0.1, 0.02) for n in (1, 3, 4, 5, 6, 7, None)] + [(None, 7, 3, 4, 5.0, 100.0, 0.1, 0.02), (1, None, 3, 5, 5.0, 100.0, 0.1, 0.02)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(lines, columns).withColumn("l_shipdate", F.lit("1995-03-02").cast("timestamp_ntz")).write.parquet(f"{scratch}/lineitem.parquet")
    orders = spark.createDataFrame([(1, "1-URGENT")], "o_orderkey long, o_orderpriority string")
    orders.withColumn("o_orderdate", F.lit("1995-03-01").cast("timestamp_ntz")).write.parquet(f"{scratch}/orders.parquet")
    a, b = raw_sources(spark, scratch)
    assert sorted(r[0] for r in a.select("passenger_count").collect()) == [1, 3, 4, 5, 5]
    assert sorted(r[0] for r in b.select("passenger_count").collect()) == [4, 5, 5, 6, 7]
    assert silver.silver_trips(raw_sources(spark, scratch)).count() == 6  # the line without a part has no times
