"""The driver contract of ``__spark_entry__``: entry, queries and oracle SQL."""

from pyspark.sql import DataFrame

import __spark_entry__ as entry_module
from lakeshore.plans.registry import all_queries
from tests.conftest import SF001


def test_every_oracle_has_a_query_and_every_query_builds(spark):
    queries = entry_module.queries()
    oracles = entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) >= 53 and len(oracles) >= 51
    for name, fn in all_queries().items():  # those of subpackages have tests of their own
        df = fn(spark, SF001)
        assert isinstance(df, DataFrame), name
        cols = df.columns
        assert len(cols) == len(set(cols)) and cols, name


def test_entry_runs_the_flagship_query(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert df.columns[:2] == ["pickup_date", "trip_count"]
    assert len(rows) > 0
