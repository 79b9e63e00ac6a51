"""Scalar text functions as built-in column expressions.

Every function maps columns to a column; invalid input yields NULL plus a boolean flag
column instead of a Python exception, so one bad row never fails a distributed job.
Strict "raise on invalid" variants (the reference's behaviour) are ``require_*``
helpers that check a bounded, already-aggregated list on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# File naming of monthly trip files.
TRIP_FILE_PATTERN = r"^(yellow|green|fhv|fhvhv)_tripdata_(\d{4})-(\d{2})\.parquet$"
TAXI_TYPES = ("yellow", "green", "fhv", "fhvhv")
MONTH_PATTERN = r"^\d{4}-(0[1-9]|1[0-2])$"
BRONZE_DATASET_PREFIX = "nyc-taxi"

# Size units (lower-case suffix -> bytes).
SIZE_UNITS = {
    "b": 1,
    "kib": 1024,
    "kb": 1000,
    "mib": 1024 * 1024,
    "mb": 1000 * 1000,
    "gib": 1024 * 1024 * 1024,
    "gb": 1000 * 1000 * 1000,
}
SIZE_PATTERN = r"^([0-9]+)([^0-9]*)$"

# Query-text categories, first match wins.
CATEGORY_RULES = (
    ("taxi", ("taxi",)),
    ("traffic", ("traffic",)),
    ("transport", ("transport",)),
    ("street", ("road", "street")),
)
CATEGORY_DEFAULT = "other"
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")
IMAGE_MIME_EXTENSIONS = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp"}
ACCEPTED_IMAGE_MIME = ("image/jpeg", "image/png", "image/webp")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- F3 -------------------------------------------------------------------------------
def parse_trip_file_name(name: str | Column) -> Column:
    """struct(valid, taxi_type, year, month); fields NULL when the name does not match."""
    n = _c(name)
    ok = n.rlike(TRIP_FILE_PATTERN)
    return F.struct(
        F.coalesce(ok, F.lit(False)).alias("valid"),
        F.when(ok, F.regexp_extract(n, TRIP_FILE_PATTERN, 1)).alias("taxi_type"),
        F.when(ok, F.regexp_extract(n, TRIP_FILE_PATTERN, 2)).alias("year"),
        F.when(ok, F.regexp_extract(n, TRIP_FILE_PATTERN, 3)).alias("month"),
    )


# --- F4 -------------------------------------------------------------------------------
def trip_file_name(taxi_type: str | Column, month: str | Column) -> Column:
    return F.concat(_c(taxi_type), F.lit("_tripdata_"), _c(month), F.lit(".parquet"))


def bronze_prefix(year: str | Column, month: str | Column) -> Column:
    return F.concat(F.lit(BRONZE_DATASET_PREFIX + "/year="), _c(year), F.lit("/month="), _c(month))


def bronze_key(year: str | Column, month: str | Column, file_name: str | Column) -> Column:
    return F.concat(bronze_prefix(year, month), F.lit("/"), _c(file_name))


def object_uri(bucket: str | Column, key: str | Column, scheme: str = "s3a") -> Column:
    """``scheme://bucket/key`` with slashes trimmed from the key; NULL if a part is empty."""
    k = F.regexp_replace(_c(key), r"^/+|/+$", "")
    b = _c(bucket)
    ok = (F.length(b) > 0) & (F.length(k) > 0)
    return F.when(ok, F.concat(F.lit(f"{scheme}://"), b, F.lit("/"), k))


def download_url(base_url: str, file_name: str | Column) -> Column:
    return F.concat(F.lit(base_url.rstrip("/") + "/"), _c(file_name))


# --- F5 -------------------------------------------------------------------------------
def month_sequence(start: str | Column, end: str | Column) -> Column:
    """Array of 'yyyy-MM' texts from the month of ``start`` to the month of ``end``."""
    first = F.trunc(_c(start).cast("date"), "month")
    last = F.trunc(_c(end).cast("date"), "month")
    return F.transform(
        F.sequence(first, last, F.expr("INTERVAL 1 MONTH")), lambda d: F.date_format(d, "yyyy-MM")
    )


def is_valid_month(text: str | Column) -> Column:
    return F.coalesce(_c(text).rlike(MONTH_PATTERN), F.lit(False))


def require_valid_months(df: DataFrame, col: str = "month") -> None:
    """Raise listing the invalid month texts (an aggregate of at most the distinct bad texts)."""
    bad = df.where(~is_valid_month(col)).select(col).distinct().orderBy(col).collect()
    if bad:
        raise ValueError("Invalid months: " + ", ".join(r[0] for r in bad))


# --- F6 -------------------------------------------------------------------------------
def parse_size(text: str | Column) -> Column:
    """'4KiB' -> 4096, '1MB' -> 1000000, '10' -> 10; NULL if malformed, unknown or <= 0."""
    t = F.lower(F.trim(_c(text)))
    digits = F.regexp_extract(t, SIZE_PATTERN, 1)
    suffix = F.regexp_extract(t, SIZE_PATTERN, 2)
    unit = F.when(suffix == "", F.lit("b")).otherwise(suffix)
    units = F.create_map(*[x for k, v in SIZE_UNITS.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    size = F.try_multiply(digits.try_cast("bigint"), units[unit])
    return F.when(t.rlike(SIZE_PATTERN) & (size > 0), size)


# --- F7 -------------------------------------------------------------------------------
def sha256_hex(col: str | Column) -> Column:
    return F.sha2(_c(col), 256)


# --- F9 -------------------------------------------------------------------------------
def category_from_query(text: str | Column) -> Column:
    q = F.lower(F.coalesce(_c(text), F.lit("")))
    expr = F.lit(CATEGORY_DEFAULT)
    for category, words in reversed(CATEGORY_RULES):
        hit = None
        for w in words:
            cond = F.instr(q, w) > 0
            hit = cond if hit is None else (hit | cond)
        expr = F.when(hit, F.lit(category)).otherwise(expr)
    return expr


# --- F10 ------------------------------------------------------------------------------
def _suffix(path: Column) -> Column:
    # Suffix of the last path component, lower-cased ('' when there is none).
    last = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(last, r"[^.](\.[^.]*)$", 1))


def _accepted(ext: Column) -> Column:
    ok = ext.isin(*IMAGE_EXTENSIONS)
    return F.when(ok, F.when(ext == ".jpeg", F.lit(".jpg")).otherwise(ext))


def image_extension(title: str | Column, url: str | Column, mime: str | Column) -> Column:
    """title suffix, else URL path suffix, else MIME type, else '.jpg'."""
    mime_map = F.create_map(*[x for k, v in IMAGE_MIME_EXTENSIONS.items() for x in (F.lit(k), F.lit(v))])
    url_path = F.coalesce(F.parse_url(_c(url), F.lit("PATH")), F.lit(""))
    return F.coalesce(
        _accepted(_suffix(F.coalesce(_c(title), F.lit("")))),
        _accepted(_suffix(url_path)),
        mime_map[F.lower(F.coalesce(_c(mime), F.lit("")))],
        F.lit(".jpg"),
    )


# --- F11 / F12 ------------------------------------------------------------------------
def file_page_url(base: str, title: str | Column) -> Column:
    return F.concat(F.lit(base), F.translate(_c(title), " ", "_"))


def first_non_empty(*cols: str | Column) -> Column:
    """first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols], F.lit(""))

