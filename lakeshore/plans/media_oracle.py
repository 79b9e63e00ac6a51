"""DuckDB SQL for the markup / JSON / image-metadata queries.

The image oracles derive the flattened hits directly from ``events`` (no JSON round
trip), so they check the Spark payload build + ``from_json`` + ``explode`` path.
"""

from __future__ import annotations

_STRIP = """trim(regexp_replace(
  regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(coalesce({c}, ''), '<[^>]+>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''),
      '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
    '&amp([^;]|$)', '&\\1', 'g'),
  '[\\s\\x{{a0}}]+', ' ', 'g'))"""


def strip(c: str) -> str:
    return _STRIP.format(c=c)


HITS = """
hits AS (
  SELECT event_id AS pos,
    CASE event_type WHEN 'view' THEN 'taxi rank' WHEN 'click' THEN 'traffic light'
      WHEN 'signup' THEN 'public transport' WHEN 'error' THEN 'street market'
      WHEN 'purchase' THEN 'city skyline' END AS query,
    CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2
      WHEN 'error' THEN 3 WHEN 'purchase' THEN 4 END AS query_idx,
    'File:' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || ' ' || CAST(user_id % 40 AS VARCHAR)
      || ['.jpg', '.JPEG', '.png', '', '.webp'][CAST(event_id % 5 + 1 AS INTEGER)] AS title,
    'https://upload.example.org/img/' || CAST(event_id AS VARCHAR) || ['.jpg', '.png', '.gif'][CAST(event_id % 3 + 1 AS INTEGER)] AS u,
    CASE WHEN event_id % 11 = 0 THEN NULL
         WHEN event_id % 7 = 0 THEN 'https://upload.example.org/img/' || CAST(event_id AS VARCHAR)
              || ['.jpg', '.png', '.gif'][CAST(event_id % 3 + 1 AS INTEGER)] || '?width=1200'
         ELSE 'https://upload.example.org/img/' || CAST(event_id AS VARCHAR)
              || ['.jpg', '.png', '.gif'][CAST(event_id % 3 + 1 AS INTEGER)] END AS direct_url,
    ['image/jpeg', 'image/png', 'image/webp', 'image/gif', 'image/jpeg', 'IMAGE/PNG'][CAST(event_id % 6 + 1 AS INTEGER)] AS mime,
    user_id * 8 + 640 AS width,
    user_id * 6 + 480 AS height,
    CASE WHEN event_id % 4 = 0 THEN '' ELSE 'User ' || CAST(user_id AS VARCHAR) || ' café ’—A' END AS artist,
    CASE WHEN event_id % 10 = 0 THEN '{{PD-old}} ' ELSE '' END || 'Own work &amp; archive ' || CAST(event_id % 3 AS VARCHAR) AS credit,
    user_id
  FROM events
),
accepted AS (
  SELECT pos, 0 AS page_pos, query, query_idx, title, direct_url, mime, width, height,
    CASE WHEN pos % 9 = 0 THEN '2.5' ELSE 'CC BY-SA 4.0' END AS license, 'https://creativecommons.org/licenses/by-sa/4.0' AS license_url,
    CASE WHEN artist = '' THEN credit ELSE artist END AS author
  FROM hits
  WHERE direct_url IS NOT NULL AND starts_with(mime, 'image/')
    AND lower(mime) IN ('image/jpeg', 'image/png', 'image/webp')
  UNION ALL
  SELECT pos, 1, query, query_idx, 'File:Second ' || CAST(user_id % 25 AS VARCHAR) || '.png',
    'https://upload.example.org/second/' || CAST(pos AS VARCHAR) || '.png', 'image/png', 10, 20,
    'CC BY-SA 4.0', '', artist
  FROM hits
)
"""

_CATEGORY = """CASE WHEN contains(lower({c}), 'taxi') THEN 'taxi'
  WHEN contains(lower({c}), 'traffic') THEN 'traffic'
  WHEN contains(lower({c}), 'transport') THEN 'transport'
  WHEN contains(lower({c}), 'road') OR contains(lower({c}), 'street') THEN 'street'
  ELSE 'other' END"""


def _ext():
    def acc(e):
        return f"CASE WHEN {e} IN ('.jpg', '.jpeg', '.png', '.webp') THEN CASE WHEN {e} = '.jpeg' THEN '.jpg' ELSE {e} END END"
    title_ext = "lower(regexp_extract(regexp_extract(title, '([^/]*)$', 1), '[^.](\\.[^.]*)$', 1))"
    url_path = "regexp_extract(direct_url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
    url_ext = f"lower(regexp_extract(regexp_extract({url_path}, '([^/]*)$', 1), '[^.](\\.[^.]*)$', 1))"
    mime_ext = ("CASE lower(mime) WHEN 'image/jpeg' THEN '.jpg' WHEN 'image/png' THEN '.png' "
                "WHEN 'image/webp' THEN '.webp' END")
    return f"coalesce({acc(title_ext)}, {acc(url_ext)}, {mime_ext}, '.jpg')"


MEDIA_ORACLE = {
    "strip_markup": f"SELECT page_id, {strip('html')} AS text FROM pages",
    "categories": f"SELECT doc_id, {_CATEGORY.format(c='text')} AS category FROM documents",
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "image_flatten": f"WITH {HITS.strip()} SELECT pos, CAST(page_pos AS INTEGER) AS page_pos, title, direct_url, mime, width, height FROM accepted",
    "first_seen": f"""WITH {HITS.strip()}
SELECT title, query_idx, pos, CAST(page_pos AS INTEGER) AS page_pos, direct_url
FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY query_idx, pos, page_pos) AS rn FROM accepted)
WHERE rn = 1""",
    "image_metadata": f"""WITH {HITS.strip()},
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY query_idx, pos, page_pos) AS rn FROM accepted)
  WHERE rn = 1 ORDER BY query_idx, pos, page_pos LIMIT 100
),
ided AS (SELECT *, printf('img_%04d', row_number() OVER (ORDER BY query_idx, pos, page_pos)) AS image_id,
                {_CATEGORY.format(c='query')} AS category FROM firsts)
SELECT image_id, image_id || '_' || category || {_ext()} AS file_name, category,
  'https://commons.wikimedia.org/wiki/' || replace(title, ' ', '_') AS source_url, direct_url,
  license, license_url, author,
  mime AS content_type, width, height, title AS commons_title
FROM ided""",
}
