"""Image API payloads derived from the driver's ``events`` table (fixture for F8-F13, W2, W3).

Each event becomes one search hit: the event type picks the search query, the user id
and event id pick title, URLs, MIME type and metadata, so titles repeat across queries
(exercising first-seen) and some hits lack a URL or carry an unsupported MIME type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the fixture: event type -> search query, in query order.
SEARCH_QUERIES = (
    ("view", "taxi rank"),
    ("click", "traffic light"),
    ("signup", "public transport"),
    ("error", "street market"),
    ("purchase", "city skyline"),
)
TITLE_SUFFIXES = (".jpg", ".JPEG", ".png", "", ".webp")
URL_SUFFIXES = (".jpg", ".png", ".gif")
MIME_TYPES = ("image/jpeg", "image/png", "image/webp", "image/gif", "image/jpeg", "IMAGE/PNG")


def _pick(options, idx):
    return F.element_at(F.array(*[F.lit(o) for o in options]), (idx % len(options) + 1).cast("int"))


def search_hits(events: DataFrame) -> DataFrame:
    """Flat per-event hit attributes (query, query_idx, pos and the page fields)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    qmap = F.create_map(*[x for t, q in SEARCH_QUERIES for x in (F.lit(t), F.lit(q))])
    imap = F.create_map(*[x for i, (t, _) in enumerate(SEARCH_QUERIES) for x in (F.lit(t), F.lit(i))])
    url = F.concat(F.lit("https://upload.example.org/img/"), eid.cast("string"), _pick(URL_SUFFIXES, eid))
    return events.select(
        eid.alias("pos"),
        qmap[F.col("event_type")].alias("query"),
        imap[F.col("event_type")].alias("query_idx"),
        F.concat(F.lit("File:"), F.initcap("event_type"), F.lit(" "), (uid % 40).cast("string"),
                 _pick(TITLE_SUFFIXES, eid)).alias("title"),
        F.when((eid % 7 == 0) | (eid % 11 == 0), F.lit(None).cast("string")).otherwise(url).alias("url"),
        F.when(eid % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(url, F.lit("?width=1200"))).alias("thumburl"),
        _pick(MIME_TYPES, eid).alias("mime"),
        (uid * 8 + 640).alias("width"),
        (uid * 6 + 480).alias("height"),
        F.when(eid % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<a href="/wiki/User:U'), uid.cast("string"), F.lit('">User&nbsp;'),
                     uid.cast("string"), F.lit("</a> caf&eacute; &#8217;&mdash;&#x41;"))).alias("artist"),
        F.concat(F.when(eid % 10 == 0, "{{PD-old}} ").otherwise(""), F.lit("Own work &amp;amp; <i>archive</i> "),
                 (eid % 3).cast("string")).alias("credit"),
        F.concat(F.lit("File:Second "), (uid % 25).cast("string"), F.lit(".png")).alias("second_title"),
        F.lit("CC BY-SA 4.0").alias("license"),
        F.lit("https://creativecommons.org/licenses/by-sa/4.0").alias("license_url"),
    )


def _text(col: str):
    """A column as a JSON string literal."""
    return F.regexp_extract(F.to_json(F.struct(F.col(col).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def api_payloads(events: DataFrame) -> DataFrame:
    """One API response JSON text per hit: query.pages map -> imageinfo array -> extmetadata map.

    A payload has two pages, whose keys do not follow their order.  Metadata values are
    objects, but every fifth credit and all license names of the second page are plain text,
    every tenth credit begins with a brace, and every ninth license name is a number.
    """
    h = search_hits(events)

    def entry(col: str):
        return F.to_json(F.struct(F.col(col).alias("value")))

    def page(title: str, info, metadata):
        body = F.to_json(info)
        return F.concat(F.lit('{"title":'), _text(title), F.lit(',"imageinfo":['), F.substring(body, F.lit(1), F.length(body) - 1),
                        F.lit(',"extmetadata":{'), metadata, F.lit("}}]}"))

    license_name = F.when(F.col("pos") % 9 == 0, F.lit('{"value":2.5,"source":"number"}')).otherwise(entry("license"))
    credit = F.when(F.col("pos") % 5 == 0, _text("credit")).otherwise(entry("credit"))
    first = page("title", F.struct("url", "thumburl", "mime", "width", "height"), F.concat(
        F.lit('"Artist":'), entry("artist"), F.lit(',"Credit":'), credit, F.lit(',"LicenseShortName":'), license_name,
        F.lit(',"LicenseUrl":'), entry("license_url")))
    second_info = F.struct(F.concat(F.lit("https://upload.example.org/second/"), F.col("pos").cast("string"), F.lit(".png")).alias("url"),
                           F.lit("image/png").alias("mime"), F.lit(10).alias("width"), F.lit(20).alias("height"))
    second = page("second_title", second_info, F.concat(
        F.lit('"Artist":'), _text("artist"), F.lit(',"LicenseShortName":'), _text("license")))
    key = F.col("pos").cast("string")
    payload = F.concat(F.lit('{"query":{"pages":{"9'), key, F.lit('":'), first, F.lit(',"1'), key, F.lit('":'), second, F.lit("}}}"))
    return h.select("pos", "query", "query_idx", payload.alias("payload"))
