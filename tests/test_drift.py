"""Schema drift between sources and deduplication of columns of any type."""

import itertools
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.operators import silver
from lakeshore.operators.drift import merged, resolved, union_resolved, wider
from lakeshore.plans import pipeline
from lakeshore.sources.trips import drifted_sources
from tests.conftest import SF001

TRIP = ("tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count int, trip_distance double, PULocationID int, "
        "DOLocationID int, payment_type int, fare_amount double, tip_amount double, total_amount double")


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize("a,b,both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "float", "double"), ("bigint", "double", "double"),
    ("int", "string", "string"), ("double", "string", "string"), ("boolean", "string", "string"), ("boolean", "int", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp_ntz", "timestamp", "timestamp"), ("date", "int", "string"), ("void", "date", "date"),
    ("decimal(5,2)", "int", "decimal(12,2)"), ("decimal(30,2)", "decimal(30,20)", "string"), ("decimal(5,2)", "double", "double"), ("binary", "string", "binary"),
    ("array<int>", "array<string>", "array<string>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("map<int,int>", "map<double,int>", "map<string,int>"), ("struct<a:int>", "struct<A:string,b:int>", "struct<a:string,b:int>"), ("array<int>", "int", "string"),
])
def test_lattice(spark, a, b, both):
    assert wider(kind(a), kind(b)) == kind(both)
    assert str(wider(kind(b), kind(a))).lower() == str(kind(both)).lower()


def test_lattice_does_not_depend_on_the_order(spark):
    kinds = [kind(k) for k in ("void", "tinyint", "int", "bigint", "float", "double", "decimal(9,3)", "string", "date", "timestamp_ntz", "boolean")]
    for three in itertools.product(kinds, repeat=3):
        found = {wider(wider(a, b), c).simpleString() for a, b, c in itertools.permutations(three)}
        assert len(found) == 1, three


def test_values_are_carried(spark):
    a = spark.sql("SELECT 1 AS id, 7 AS n, 'x' AS Flag, named_struct('a', 1) AS s, array(1, NULL) AS l, map('k', 1) AS m, array(1) AS odd")
    b = spark.sql("SELECT 2L AS ID, 2.5D AS n, 3 AS flag, named_struct('A', 'one', 'c', true) AS s, array('z') AS l, map('k', 2L) AS m, 5 AS odd, 1 AS `a.b`")
    c = spark.sql("SELECT 3 AS id")
    rows = {r["id"]: r.asDict(True) for r in union_resolved([a, b, c]).collect()}
    assert rows[1] == {"id": 1, "n": 7.0, "Flag": "x", "s": {"a": "1", "c": None}, "l": ["1", None], "m": {"k": 1}, "odd": "[1]", "a.b": None}
    assert rows[2] == {"id": 2, "n": 2.5, "Flag": "3", "s": {"a": "one", "c": True}, "l": ["z"], "m": {"k": 2}, "odd": "5", "a.b": 1}
    assert set(rows[3].values()) == {3, None}
    schema = merged([a.schema, b.schema, c.schema]).simpleString()
    assert [df.schema.simpleString() for df in resolved([a, b, c])] == [schema] * 3


def trip(extra, schema, n=2, session=None, **change):
    rows = []
    for i in range(n):
        row = dict(pickup=f"2025-01-0{i + 1} 10:00:00", dropoff=f"2025-01-0{i + 1} 11:00:00", n=1, d=1.5, pu=1, do=2, pay=1, fare=3.0, tip=1.0, total=4.0) | change
        rows.append((*row.values(), *extra))
    return session.createDataFrame(rows, f"{TRIP}, {schema}")


def test_silver_of_clashing_sources(spark, scratch):
    """Text against a number, a raw name that differs in case from a silver one, a map."""
    a = trip((5, "no date", {"k": 1}), "airport_fee int, Pickup_Date string, props map<string,int>", session=spark)
    b = trip(("free", {"k": 2}), "Airport_fee string, props map<string,bigint>", session=spark, pu=9)
    for name, df in (("a", a), ("b", b)):
        df.write.parquet(os.path.join(scratch, name))
    uri = os.path.join(scratch, "silver")
    out = pipeline.bronze_to_silver(spark, [os.path.join(scratch, n) for n in "ab"], uri)
    got = spark.read.parquet(uri)
    assert out["output_rows"] == 4 and out["duplicate_rows"] == 0
    assert {(r.pu_location_id, r.airport_fee, r.props["k"]) for r in got.collect()} == {(1, "5", 1), (9, "free", 2)}
    assert {str(r.pickup_date) for r in got.collect()} == {"2025-01-01", "2025-01-02"}


def test_survivor_does_not_depend_on_the_order(spark):
    rows = [trip((fee, flag, {"b": fee, "a": 1}, [flag]), "fee int, flag string, props map<string,int>, tags array<string>", 1, spark, pay=pay)
            for fee, flag, pay in itertools.product((1, None, 3), ("x", None), (1, 2))]
    frames = [silver.clean(df) for df in rows]
    found = set()
    for order in (frames, frames[::-1], frames[5:] + frames[:5]):
        (row,) = silver.deduplicate(silver.union_sources(order).repartition(7)).collect()
        found.add(str(row))
        assert any(str(row) == str(r) for f in frames for r in f.select(*row.asDict()).collect())
    assert len(found) == 1


def test_equal_maps_are_one_value(spark):
    a = trip(({"x": 1, "y": 2},), "props map<string,int>", 1, spark)
    b = trip(({"y": 2, "x": 1},), "props map<string,int>", 1, spark)
    (row,) = silver.silver_trips([a, b]).collect()
    assert row.props == {"x": 1, "y": 2}


def test_hot_key_of_differing_rows(spark):
    n = 20_000
    raw = spark.range(n).selectExpr(
        "'2025-01-01 10:00:00' AS tpep_pickup_datetime", "'2025-01-01 11:00:00' AS tpep_dropoff_datetime", "1 AS passenger_count", "1.0D AS trip_distance",
        "IF(id % 3 = 0, 1, CAST(id AS INT)) AS PULocationID", "2 AS DOLocationID", "CAST(id % 5 AS INT) AS payment_type", "3.0D AS fare_amount", "1.0D AS tip_amount",
        "4.0D AS total_amount", "CAST(id AS STRING) AS note")
    out = silver.silver_trips([raw])
    assert out.count() == raw.select("PULocationID").distinct().count()
    hot = out.where("pu_location_id = 1").collect()
    assert len(hot) == 1 and int(hot[0].payment_type) == int(hot[0].note) % 5  # one whole row


def test_fixed_width_columns_need_no_sort(spark):
    a, b = drifted_sources(spark, SF001)
    plain = silver.silver_trips([a, b], passthrough=["fee"])
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by(" in plan and "SortAggregate" not in plan
    everything = silver.silver_trips([a, b])
    assert "SortAggregate" in everything._jdf.queryExecution().executedPlan().toString()  # text and nested values
    pruned = everything.groupBy("pickup_date").agg(F.sum("fee"), F.sum("total_amount"))
    assert "SortAggregate" not in pruned._jdf.queryExecution().executedPlan().toString()
