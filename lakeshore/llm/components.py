"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import drop_folder, saved, work_folder


def _towards_minimum(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b).  Large star: every larger neighbour of a node is joined to the
    smallest of the node and its neighbours; small star: the node and its smaller ones."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("least").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of ``edges`` (a, b),
    but for the smallest nodes themselves.

    Edges stay distributed and are written once a round; a round that leaves them as they
    were ends the loop.  The number of rounds grows with the logarithm of the nodes.
    """
    spark = edges.sparkSession
    folder = work_folder(spark, "components")
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = saved(ordered, f"{folder}/0")
    mark = _fingerprint(current)
    step = 0
    while mark[0]:
        step += 1
        after = saved(_towards_minimum(_towards_minimum(current, True), False), f"{folder}/{step}")
        new = _fingerprint(after)
        current = after
        drop_folder(spark, f"{folder}/{step - 1}")
        if new == mark:
            break
        mark = new
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
