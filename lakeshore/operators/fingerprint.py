"""Order-insensitive result fingerprints.

* ``normalized_json``: the row normaliser -- floats/decimals rounded to 6 places, dates
  and timestamps as ISO text, also inside arrays, structs and maps, keys in sorted order
  -- rendered as compact JSON per row.
* ``result_fingerprint``: SHA-256 over the sorted normalised rows, each followed by a
  newline, plus the row count: the reference's text, so its digest is sequential by
  definition.  The rows are sorted in parallel and streamed through the digest, never held.
* ``tree_fingerprint``: for tables of any size: a Merkle tree.  Rows are digested in parallel,
  equal ones become one leaf with its count, and leaves are digested by their leading bits,
  level by level, up to one root.
* ``table_fingerprint``: row count plus the sum of a 60-bit SHA-256 part of each row (as
  DECIMAL(38,0), so it cannot overflow); a plain partial+final aggregate, cheaper and
  weaker than the tree.

All are insensitive to order and partitioning.  The last two digest a row's fields with their
lengths and a mark for NULL (``plain_text``), so no two different rows have the same text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINGERPRINT_DECIMALS = 6


def _iso(c: Column) -> Column:
    micros = F.date_format(c, "SSSSSS")
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""))


def _normal(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.round(c.cast("double"), FINGERPRINT_DECIMALS)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return _iso(c)
    if isinstance(kind, T.DateType):
        return c.cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _normal(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: _normal(v, kind.valueType))
    if isinstance(kind, T.StructType):
        parts = [_normal(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*parts))
    return c


def _normalized(df: DataFrame) -> list[Column]:
    return [_normal(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)]


def normalized_json(df: DataFrame) -> Column:
    """One compact JSON text per row with sorted keys and rounded numbers."""
    return F.to_json(F.struct(*_normalized(df)), {"ignoreNullFields": "false"})


def result_fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows_returned, result_sha256)."""
    lines = df.select(normalized_json(df).alias("j")).orderBy("j").coalesce(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, rows = hashlib.sha256(), 0
        for batch in batches:
            for line in batch.column(0).to_pylist():
                digest.update(f"{line}\n".encode())
            rows += batch.num_rows
        yield pa.RecordBatch.from_pydict({"n": [rows], "digest": [digest.hexdigest() if rows else None]})

    # an empty result has no task; the aggregate gives its row all the same
    empty = F.sha2(F.lit(""), 256)
    return lines.mapInArrow(run, "n long, digest string").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_returned"), F.coalesce(F.max("digest"), empty).alias("result_sha256"))


def plain_text(df: DataFrame) -> Column:
    """One text per row that any engine can write: its columns by name, each as ``length:text``
    or ``~`` for NULL, numbers with fractions to 6 places."""
    parts = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            text = F.coalesce(c.try_cast(f"decimal(38,{FINGERPRINT_DECIMALS})").cast("string"), c.cast("string"))
        elif isinstance(f.dataType, T.BinaryType):
            text = F.hex(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.when(c.isNotNull(), F.to_json(F.struct(_normal(c, f.dataType).alias("v")), {"ignoreNullFields": "false"}))
        else:
            text = _normal(c, f.dataType).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.concat(F.lit(""), *parts)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """A18 at scale: (row_count, hash_sum) with an order-insensitive additive hash."""
    h = F.conv(F.substring(F.sha2(plain_text(df), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("h"), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"))


#: Hex digits of a row's digest that name its node at each level of the tree, root last.  A
#: node has 4,096 children at most, and a lowest one some 60,000 leaves in a table of 10^12
#: distinct rows.
TREE_LEVELS = (6, 3, 0)


def tree_fingerprint(df: DataFrame) -> DataFrame:
    """A18 at scale: one row (row_count, root_sha256) of the Merkle tree of the rows.

    A leaf is ``digest:count`` of a distinct row; a node is the SHA-256 of its children in
    order, joined by newlines, and a child node is written ``prefix:digest``.
    """
    leaves = df.select(F.sha2(plain_text(df), 256).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    level = leaves.withColumn("item", F.concat_ws(":", "key", "rows"))
    for digits in TREE_LEVELS:
        keys = [F.substring("key", 1, digits).alias("key")] if digits else []
        children = F.array_join(F.sort_array(F.collect_list("item")), "\n")
        nodes = level.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.sha2(children, 256).alias("digest"))
        level = nodes.withColumn("item", F.concat_ws(":", "key", "digest")) if digits else nodes
    return level.select(F.coalesce("rows", F.lit(0)).alias("row_count"), F.col("digest").alias("root_sha256"))
