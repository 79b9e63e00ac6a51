"""Shared helpers of the subpackage: tables in the cluster's shared folder, Arrow columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeshore.session import ensure_checkpoint_dir


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it again: later jobs start from the files, so a lost
    executor costs no more than the step at hand.  An empty frame keeps its schema."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables through Spark's own file systems."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def parallelism(spark: SparkSession) -> int:
    """The shuffle partitions in force; what is dealt out by hand follows this setting, so
    it grows with whatever the cluster is tuned for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (rows + 1) of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def in_turn_order(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of a key in one partition and in ``order`` (nulls first): the shuffle's sort
    spills, so a task that reads them as a stream holds no key whole."""
    return rows.repartition(parallelism(rows.sparkSession), key).sortWithinPartitions(key, *order)


class Rows:
    """Rows of a mapInArrow step, cut into batches by their number and their text."""

    def __init__(self, schema: pa.Schema, most_rows: int = 8192, most_bytes: int = 8 << 20) -> None:
        self.schema, self.most_rows, self.most_bytes = schema, most_rows, most_bytes
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, *row, size: int = 0) -> None:
        self.rows.append(row)
        self.bytes += size

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """What is full, or with ``last`` all that is left."""
        if len(self.rows) >= self.most_rows or self.bytes >= self.most_bytes or last and self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
            self.rows, self.bytes = [], 0
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
