"""Registry of every query exposed to the driver (``__spark_entry__``)."""

from __future__ import annotations

from lakeshore.plans import (
    bench_oracle,
    bench_queries,
    inventory_oracle,
    inventory_queries,
    media_oracle,
    media_queries,
    misc_queries,
    oracle_sql,
    trip_queries,
)


def all_queries() -> dict:
    out = {}
    out.update(trip_queries.QUERIES)
    out.update(bench_queries.QUERIES)
    out.update(media_queries.QUERIES)
    out.update(inventory_queries.QUERIES)
    out.update(misc_queries.QUERIES)
    return out


def all_oracle_sql() -> dict[str, str]:
    out = {}
    out.update(oracle_sql.TRIP_ORACLE)
    out.update(bench_oracle.BENCH_ORACLE)
    out.update(media_oracle.MEDIA_ORACLE)
    out.update(inventory_oracle.INVENTORY_ORACLE)
    out.update(misc_queries.ORACLE)
    return out
