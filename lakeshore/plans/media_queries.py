"""Registered markup / JSON / image-metadata queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshore.functions.text import category_from_query
from lakeshore.operators import media
from lakeshore.sources.media import api_payloads
from lakeshore.sources.tables import read_table

# The download budget of the candidate search (the reference's ``--limit``).
IMAGE_LIMIT = 100


def q_strip_markup(spark, sf_dir):
    """F8 on every page's full HTML."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", media.strip_markup("html").alias("text"))


def q_categories(spark, sf_dir):
    """F9 over whole document texts."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", category_from_query("text").alias("category"))


def q_json_props(spark, sf_dir):
    """F13 (flat case): typed field from a JSON text column."""
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


def _flattened(spark, sf_dir):
    payloads = api_payloads(read_table(spark, sf_dir, "events"))
    return media.flatten_api_payload(payloads, keep=("pos", "query", "query_idx"))


def q_image_flatten(spark, sf_dir):
    """every accepted page of every API payload, flattened."""
    return _flattened(spark, sf_dir).select("pos", "page_pos", "title", "direct_url", "mime", "width", "height")


def q_first_seen(spark, sf_dir):
    """W2 over every accepted hit (no budget): one row per distinct title."""
    firsts = media.first_occurrences(_flattened(spark, sf_dir))
    return firsts.select("title", "query_idx", "pos", "page_pos", "direct_url")


def q_image_metadata(spark, sf_dir):
    """F8-F13 + W2 + W3: first-seen candidates within the budget, with metadata records."""
    cands = media.with_category(_flattened(spark, sf_dir))
    chosen = media.assign_image_ids(media.first_seen(cands, IMAGE_LIMIT))
    return media.image_metadata_rows(chosen)


QUERIES = {
    "strip_markup": q_strip_markup,
    "categories": q_categories,
    "json_props": q_json_props,
    "image_flatten": q_image_flatten,
    "first_seen": q_first_seen,
    "image_metadata": q_image_metadata,
}
