"""Manifests, file inventories and idempotent-ingest planning as DataFrame jobs
(S5, S6, S7, J1, J2, A19, U3).

A manifest is nested JSON (scalars + ``files: array<struct>``); it is read with an
explicit schema and either kept nested (``transform`` over ``files`` for the batch
descriptor) or exploded to one row per file.  Comparisons with the stored objects are
joins, not Python loops, so a million-file bronze bucket is planned the same way as a
one-file batch.
"""

from __future__ import annotations

import base64
import ctypes
import functools
import hashlib
import itertools
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.functions.text import object_uri

# Tasks get this module's functions whole: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFEST_FILE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("local_path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("taxi_type", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("checksum_algorithm", T.StringType()),
    T.StructField("checksum_sha256", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("bronze_key", T.StringType()),
    T.StructField("bronze_uri", T.StringType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("manifest_version", T.StringType()),
    T.StructField("generated_at", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("taxi_type", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("bronze_bucket", T.StringType()),
    T.StructField("bronze_prefix", T.StringType()),
    T.StructField("file_count", T.LongType()),
    T.StructField("total_size_bytes", T.LongType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("months", T.ArrayType(T.StringType())),
    T.StructField("files", T.ArrayType(MANIFEST_FILE)),
    T.StructField("notes", T.ArrayType(T.StringType())),
])

# Fixed value: the dataset a trip batch must declare.
TRIP_DATASET = "nyc_taxi"
SILVER_DATASET_PREFIX = "nyc-taxi"


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per manifest JSON document (pretty-printed files need ``multiLine``)."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)


def batch_descriptors(manifests: DataFrame, silver_bucket: str) -> DataFrame:
    """The batch descriptor of each manifest, with a validity reason.

    ``source_uris`` keeps file order; ``source_uri`` is the first file; the silver
    location is derived from the manifest-level year/month (the *batch*, T9).
    """
    uris = F.transform("files", lambda f: object_uri(F.col("bronze_bucket"), f["bronze_key"]))
    prefix = F.concat(F.lit(SILVER_DATASET_PREFIX + "/year="), F.col("year"), F.lit("/month="), F.col("month"))
    problem = (
        F.when(F.coalesce(F.col("dataset"), F.lit("")) != TRIP_DATASET,
               F.concat(F.lit("Unsupported dataset: "), F.coalesce(F.col("dataset"), F.lit("None"))))
        .when(F.coalesce(F.size("files"), F.lit(0)) <= 0,
              F.lit("manifest must describe at least one source file"))
        .when(F.exists(uris, lambda u: u.isNull()), F.lit("every file needs a bucket and a key"))
        .when(F.length(F.lit(silver_bucket)) == 0, F.lit("a silver bucket is needed"))
    )
    return manifests.select(
        "dataset", "taxi_type", "year", "month", "bronze_bucket",
        F.lit(silver_bucket).alias("silver_bucket"),
        F.get(F.col("files"), 0)["bronze_key"].alias("source_key"),
        F.get(uris, 0).alias("source_uri"),
        uris.alias("source_uris"),
        prefix.alias("silver_prefix"),
        object_uri(F.lit(silver_bucket), prefix).alias("silver_uri"),
        problem.alias("problem"),
    )


def require_batch(descriptors: DataFrame) -> list[dict]:
    """Driver-side check of a handful of batch descriptors (one per manifest)."""
    rows = [r.asDict() for r in descriptors.collect()]
    bad = [r["problem"] for r in rows if r["problem"]]
    if bad:
        raise ValueError("; ".join(bad))
    return rows


def manifest_files(manifests: DataFrame) -> DataFrame:
    """One row per described file, with its position in the manifest."""
    exploded = manifests.select("dataset", "bronze_bucket", F.posexplode("files").alias("file_idx", "f"))
    return exploded.select("dataset", "bronze_bucket", "file_idx", "f.*")


def manifest_rollup(files: DataFrame, group_cols=()) -> DataFrame:
    """File count, total bytes / rows, month list and batch id ``first_last_Nfiles``.

    Months stand in the manifest's order (``file_no``).  The list is one entry per file of
    a batch (control-plane sized), never per data row.
    """
    listed = F.sort_array(F.collect_list(F.struct("file_no", F.concat_ws("-", "year", "month").alias("month"))))
    months = F.transform(listed, lambda x: x["month"])
    agg = files.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size_bytes").alias("total_size_bytes"),
        F.sum("row_count").alias("total_rows"),
        months.alias("_months"),
    )
    return agg.select(
        *group_cols, "file_count", "total_size_bytes", "total_rows",
        F.array_join("_months", ",").alias("months"),
        F.concat(F.get("_months", 0), F.lit("_"), F.element_at("_months", -1), F.lit("_"),
                 F.col("file_count").cast("string"), F.lit("files")).alias("batch_id"),
    )


def ingest_plan(expected: DataFrame, actual: DataFrame, force: bool = False, key: str = "bronze_key") -> DataFrame:
    """Per expected file, ``upload`` (absent), ``exists`` (same checksum and size) or
    ``conflict`` (different; ``overwrite`` when forced).

    A left equi-join on the object key; the planner shuffles both sides on the key (or
    broadcasts a side whose runtime size is under the threshold).
    """
    a = actual.select(
        F.col(key).alias("_k"),
        F.col("checksum_sha256").alias("actual_checksum"),
        F.col("size_bytes").alias("actual_size"),
    )
    joined = expected.join(a, expected[key] == a["_k"], "left")
    same = F.col("checksum_sha256").eqNullSafe(F.col("actual_checksum")) & F.col("size_bytes").eqNullSafe(
        F.col("actual_size")
    )
    action = (
        F.when(F.col("_k").isNull(), F.lit("upload"))
        .when(same, F.lit("exists"))
        .otherwise(F.lit("overwrite" if force else "conflict"))
    )
    return joined.select(key, "file_name", "size_bytes", "checksum_sha256", "actual_checksum", action.alias("action"))


def _refuse(found: DataFrame, key: str, problem: str) -> None:
    """Raise if ``found`` has rows, naming every key in order.  The message is the whole
    list; for a list too long to read, write the plan as a table instead."""
    keys = [str(r[0]) for r in found.select(key).orderBy(key).collect()]
    if keys:
        raise ValueError(f"{problem}: {', '.join(keys)}")


def require_no_conflicts(plan: DataFrame, key: str = "bronze_key") -> None:
    """An unforced plan with conflicts is an error naming the conflicting keys."""
    _refuse(plan.where(F.col("action") == "conflict"), key, "Objects that differ from the manifest")


def manifest_differences(left: DataFrame, right: DataFrame, ignore=("generated_at",)) -> DataFrame:
    """Rows present on one side only (bag difference both ways), ignoring ``ignore``.

    Empty result == the manifests are equal.
    """
    cols = [c for c in left.columns if c not in ignore]
    lft, rgt = left.select(*cols), right.select(*cols)
    return lft.exceptAll(rgt).withColumn("side", F.lit("left")).unionByName(
        rgt.exceptAll(lft).withColumn("side", F.lit("right"))
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once, with their counts (partial aggregation first)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, key: str) -> None:
    """Error listing the duplicated values of ``key`` in sorted order."""
    _refuse(duplicate_keys(df, key), key, "Duplicate values")


#: Packed files below this size are read as one binary row each; Spark's rows end at 2 GiB.
MAX_ROW_BYTES = 2**31 - 1
#: What one task reads of a file, about; smaller files are read as one binary row each.
TASK_BYTES = 128 << 20
#: A split's pieces are joined to blocks of about this size before they are shuffled.
_BLOCK_BYTES = 1 << 20
#: The byte that larger files are cut at, and the mark that the reader drops at their start.
_CUT, _MARK = b"\n", b"\xef\xbb\xbf"
#: Names that Spark's readers would unpack.
_PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|xz)$"


def file_inventory(spark: SparkSession, root: str, glob: str = "*", row_bytes: int = MAX_ROW_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Path, name, size and SHA-256 per file below ``root``.

    A file of ``task_bytes`` or more (or ``row_bytes``, if less) is read by many tasks, which
    hand its digest on from one to the next (:func:`_streamed_digests`).  The driver sees the
    names and digests of such files, not their bytes.  Names that Spark's readers would unpack
    cannot be read in part: below ``row_bytes`` they are a row each, and the bytes of larger
    ones are streamed in small pieces through the driver's file system client.
    """
    whole = min(row_bytes, task_bytes) if _sha256_calls() else row_bytes
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)

    def digested(files: DataFrame) -> DataFrame:
        return files.select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("checksum_sha256"))

    rows = digested(found.where(F.col("length") < whole))
    large = found.where(F.col("length") >= whole).select("path", F.col("_metadata.file_path").alias("uri"), "length", F.col("path").rlike(_PACKED).alias("packed")).collect()
    one_row = [_literal(r["path"]) for r in large if r["packed"] and r["length"] < row_bytes]
    if one_row:
        rows = rows.unionByName(digested(spark.read.format("binaryFile").load(one_row)))
    digests = [(r["path"], r["length"], _driver_digest(spark, r["path"])) for r in large if r["packed"] and r["length"] >= row_bytes]
    plain = [r for r in large if not r["packed"]]
    if plain:
        streamed = _streamed_digests(spark, [(r["path"], r["uri"], r["length"]) for r in plain], task_bytes)
        digests += [(r["path"], r["length"], streamed[r["uri"]]) for r in plain]
    if digests:
        rows = rows.unionByName(spark.createDataFrame(digests, rows.schema))
    return rows.select("file_path", F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file_name"), "size_bytes", "checksum_sha256")


def _literal(path: str) -> str:
    """``path`` for a reader that takes patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _sha256_calls() -> ctypes.CDLL | None:
    """The OpenSSL that ``hashlib`` is linked with, if a digest's state can be taken from it."""
    try:
        import _hashlib

        calls = ctypes.CDLL(_hashlib.__file__)
        calls.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        first = _Sha256(calls)
        first.update(b"ab")
        second = _Sha256(calls, first.state())
        second.update(b"c")
        return calls if second.hexdigest() == hashlib.sha256(b"abc").hexdigest() else None
    except (ImportError, AttributeError, OSError):
        return None


class _Sha256:
    """A SHA-256 digest that another process can go on with from its ``state``; those of
    ``hashlib`` cannot leave theirs."""

    def __init__(self, calls: ctypes.CDLL, state: bytes | None = None):
        self._calls = calls
        self._held = ctypes.create_string_buffer(state or b"", 256)  # OpenSSL's SHA256_CTX has 112 bytes
        if state is None:
            calls.SHA256_Init(self._held)

    def update(self, data: bytes) -> None:
        self._calls.SHA256_Update(self._held, data, len(data))

    def state(self) -> bytes:
        return self._held.raw

    def copy(self) -> _Sha256:
        return _Sha256(self._calls, self.state())

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self._calls.SHA256_Final(out, self.copy()._held)
        return out.raw.hex()


def _streamed_digests(spark: SparkSession, files: list[tuple[str, str, int]], task_bytes: int) -> dict[str, str]:
    """SHA-256 by uri of large files, given by path, uri and size.

    The text source splits the files among tasks and cuts them at newline bytes (any bytes
    pass as they are).  One shuffle sorts the pieces into steps of about ``task_bytes``, a
    partition each.  SHA-256 has no parallel form, so the steps of a file are digested by one
    task after the other, each from the state that the last one left; the files go side by
    side.  A file with 2 GiB between two newlines is beyond a row, and an error.  Where
    OpenSSL cannot be reached from Python (:func:`_sha256_calls`), a file is one step.
    """
    steps = {uri: -(-size // task_bytes) if _sha256_calls() else 1 for _, uri, size in files}
    firsts = dict(zip(steps, itertools.accumulate(steps.values(), initial=0)))
    pieces = spark.read.option("lineSep", _CUT.decode()).text([_literal(path) for path, _, _ in files]).select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, part, at, begin, held, lines = None, None, 0, 0, 0, []

        def joined() -> Iterator[pa.RecordBatch]:
            uri, start = split
            data = (_CUT if begin else b"") + _CUT.join(lines)
            for low in range(0, len(data), _BLOCK_BYTES):
                columns = [part], [uri], [start], [begin + low], [data[low:low + _BLOCK_BYTES]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "uri", "start", "begin", "block"])

        for batch in batches:
            for uri, start, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (uri, start) != split:
                    if lines:
                        yield from joined()
                    split, part, at, lines = (uri, start), None, start, []
                # a split's first piece begins a little after its start, so no piece is put into
                # a later step than one that follows it
                here = firsts[uri] + min(at // task_bytes, steps[uri] - 1)
                if here != part or held + len(value) > _BLOCK_BYTES:
                    if lines:
                        yield from joined()
                    part, begin, held, lines = here, at, 0, []
                lines.append(value)
                held += len(value) + 1
                at += len(value) + 1
        if lines:
            yield from joined()

    types = pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary()
    blocks = pieces.mapInArrow(join, "part int, uri string, start long, begin long, block binary")
    # text, because Spark pickles binary values of an RDD's rows slowly
    parted = blocks.repartitionById(sum(steps.values()), "part").sortWithinPartitions("uri", "start", "begin").select("uri", F.base64("block")).rdd

    def digest(uris: list[str], head: bytes) -> dict[str, tuple[int, bytes | None, dict[int, str]]]:
        left = dict.fromkeys(uris, _left(0, _begun(head)))
        for step in range(max((steps[uri] for uri in uris), default=0)):
            before = {uri: left[uri] for uri in uris if steps[uri] > step}
            left.update(spark.sparkContext.runJob(parted, functools.partial(_feed, before, head), [firsts[uri] + step for uri in before]))
        return left

    sizes = {uri: size for _, uri, size in files}
    left = digest(list(sizes), b"")
    # the size tells whether the reader dropped a mark; such files, which are rare, go again
    marked = [uri for uri, (fed, _, _) in left.items() if sizes[uri] - fed >= len(_MARK)]
    left.update({uri: (fed + len(_MARK), state, ends) for uri, (fed, state, ends) in digest(marked, _MARK).items()})
    # and whether a newline closes the file, which cuts off no piece
    return {uri: ends[sizes[uri] - fed] for uri, (fed, _, ends) in left.items()}


def _begun(head: bytes) -> _Sha256 | hashlib._Hash:
    digest = _Sha256(_sha256_calls()) if _sha256_calls() else hashlib.sha256()
    digest.update(head)
    return digest


def _left(fed: int, digest: _Sha256 | hashlib._Hash) -> tuple[int, bytes | None, dict[int, str]]:
    """What a step hands on: the bytes fed, the state, and the digests of all bytes so far
    and of these and a newline, by the bytes added."""
    closed = digest.copy()
    closed.update(_CUT)
    return fed, digest.state() if isinstance(digest, _Sha256) else None, {0: digest.hexdigest(), len(_CUT): closed.hexdigest()}


def _feed(before: dict, head: bytes, rows: Iterator) -> Iterator[tuple]:
    """Feeds one step of a file to its digest, which begins with ``head``."""
    uri = None
    for here, block in rows:
        if uri is None:
            uri, (fed, state, _) = here, before[here]
            digest = _Sha256(_sha256_calls(), state) if state else _begun(head)
        data = base64.b64decode(block)
        fed += len(data)
        digest.update(data)
    if uri is not None:
        yield uri, _left(fed, digest)


def _driver_digest(spark: SparkSession, uri: str) -> str:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def parquet_row_counts(df: DataFrame) -> DataFrame:
    """Rows per Parquet file of a table, by path (files of different folders may share
    a name), from the hidden ``_metadata`` column."""
    files = df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"))
    return files.groupBy("file_path", "file_name").agg(F.count(F.lit(1)).alias("row_count"))
