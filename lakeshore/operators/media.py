"""Image-metadata jobs: markup stripping (F8), nested JSON flattening (F13), category,
extension, page URL and author fallback (F9-F12), first-seen candidates (W2, O5) and
sequential image ids (W3).

The upstream API payload is ``{"query": {"pages": {id: {title, imageinfo: [...]}}}}``;
it is parsed with ``from_json`` against an explicit Map/Array/Struct schema and
flattened with ``explode(map_values(...))`` -- no Python dict walking.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.functions.text import (
    ACCEPTED_IMAGE_MIME,
    category_from_query,
    file_page_url,
    first_non_empty,
    image_extension,
)

TAG_PATTERN = r"<[^>]+>"
FILE_PAGE_BASE = "https://commons.wikimedia.org/wiki/"

# A metadata value is an object with a ``value``, or the value itself: a variant knows which,
# whatever a text begins with.
EXTMETA = T.MapType(T.StringType(), T.VariantType())
IMAGEINFO = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("thumburl", T.StringType()),
    T.StructField("mime", T.StringType()),
    T.StructField("width", T.LongType()),
    T.StructField("height", T.LongType()),
    T.StructField("extmetadata", EXTMETA),
])
PAGE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("imageinfo", T.ArrayType(IMAGEINFO)),
])
API_PAYLOAD = T.StructType([
    T.StructField("query", T.StructType([T.StructField("pages", T.MapType(T.StringType(), PAGE))])),
])


# Candidate order: search query, payload, page within the payload.
CANDIDATE_ORDER = ("query_idx", "pos", "page_pos")


@F.pandas_udf(T.StringType())
def strip_markup(s: pd.Series) -> pd.Series:
    """F8: NULL -> '', tags dropped, every HTML5 character reference decoded once, runs of
    white space one space, trimmed.  There are some two thousand named references, which no
    built-in function knows, hence the Arrow-batched ``html.unescape``."""
    tags = s.fillna("").str.replace(TAG_PATTERN, "", regex=True)
    return tags.map(lambda t: " ".join(html.unescape(t).split()))


def metadata_value(extmetadata: Column, key: str) -> Column:
    """The text of one metadata entry, whichever of its two forms it has: numbers in their
    plain text without closing zeros, truth values as ``True`` and ``False``, lists and other
    objects as JSON."""
    raw = extmetadata[key]
    value = F.when(F.schema_of_variant(raw).startswith("OBJECT"), F.try_variant_get(raw, "$.value", "variant")).otherwise(raw)
    text = F.try_variant_get(value, "$", "string")
    return strip_markup(F.when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text)).otherwise(text))


def flatten_api_payload(df: DataFrame, payload_col: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """one row per page with its first imageinfo and its place in the payload
    (``page_pos``); pages without a URL or with a MIME type other than jpeg/png/webp are
    dropped."""
    parsed = df.select(*keep, F.from_json(payload_col, API_PAYLOAD).alias("p"))
    pages = parsed.select(*keep, F.posexplode(F.map_values("p.query.pages")).alias("page_pos", "page"))
    info = F.get(F.col("page.imageinfo"), 0)
    flat = pages.select(
        *keep, "page_pos",
        F.coalesce(F.col("page.title"), F.lit("")).alias("title"),
        F.coalesce(F.nullif(info["url"], F.lit("")), F.nullif(info["thumburl"], F.lit(""))).alias("direct_url"),
        F.coalesce(info["mime"], F.lit("")).alias("mime"),
        info["width"].alias("width"),
        info["height"].alias("height"),
        info["extmetadata"].alias("extmetadata"),
    )
    accepted = F.col("mime").startswith("image/") & F.lower("mime").isin(*ACCEPTED_IMAGE_MIME)
    return flat.where(F.col("direct_url").isNotNull() & accepted)


def first_occurrences(candidates: DataFrame, order_cols=CANDIDATE_ORDER) -> DataFrame:
    """The first occurrence of each title in (query, position, page) order.

    ``min_by(row, order)`` is an aggregate with map-side partials (sort-based, as a struct
    has no hash buffer): a title
    repeated across a third of all search hits reaches the shuffle as one row per map
    task, where a window per title would sort the whole group in one task.
    """
    rest = [c for c in candidates.columns if c != "title"]
    firsts = candidates.groupBy("title").agg(
        F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("_first")
    ).select("title", *[F.col(f"_first.{c}").alias(c) for c in rest])
    return firsts.select(*candidates.columns)


def first_seen(candidates: DataFrame, limit: int, order_cols=CANDIDATE_ORDER) -> DataFrame:
    """W2 + O5: first occurrences, then the first ``limit`` candidates (the limit is the
    feature: a download budget).  ``orderBy(...).limit`` is a distributed top-k
    (``TakeOrderedAndProject``), so only ``limit`` rows meet in one task.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    return first_occurrences(candidates, order_cols).orderBy(*order_cols).limit(limit)


def assign_image_ids(candidates: DataFrame, order_cols=CANDIDATE_ORDER) -> DataFrame:
    """``img_0001``... in candidate order, over an already limited candidate set
    (at most the download budget of rows, so the single ordered window is bounded)."""
    w = Window.orderBy(*order_cols)
    return candidates.withColumn("image_id", F.format_string("img_%04d", F.row_number().over(w)))


def image_metadata_rows(candidates: DataFrame) -> DataFrame:
    """The metadata record per candidate (image_id assigned first)."""
    ext = image_extension("title", "direct_url", "mime")
    meta = F.col("extmetadata")
    return candidates.select(
        "image_id",
        F.concat("image_id", F.lit("_"), "category", ext).alias("file_name"),
        "category",
        file_page_url(FILE_PAGE_BASE, F.col("title")).alias("source_url"),
        "direct_url",
        metadata_value(meta, "LicenseShortName").alias("license"),
        metadata_value(meta, "LicenseUrl").alias("license_url"),
        first_non_empty(metadata_value(meta, "Artist"), metadata_value(meta, "Credit")).alias("author"),
        F.col("mime").alias("content_type"),
        "width",
        "height",
        F.col("title").alias("commons_title"),
    )


def with_category(df: DataFrame, query_col: str = "query") -> DataFrame:
    return df.withColumn("category", category_from_query(query_col))
