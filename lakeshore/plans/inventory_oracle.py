"""DuckDB SQL for the manifest / inventory / ingest-plan / text-function queries."""

from __future__ import annotations

from lakeshore.sources.tables import TABLES

FILES = r"""
per_source AS (
  SELECT source, CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) AS file_no,
         COUNT(*) AS row_count, CAST(SUM(n_chars) AS BIGINT) AS size_bytes, SUM(doc_id) AS id_sum
  FROM documents GROUP BY source
),
dated AS (SELECT *, CAST(DATE '2023-01-01' + to_months(file_no) AS DATE) AS d FROM per_source),
f AS (
  SELECT file_no, 'yellow_tripdata_' || strftime(d, '%Y-%m') || '.parquet' AS file_name,
    strftime(d, '%Y') AS year, strftime(d, '%m') AS month, row_count, size_bytes,
    sha256(source || ':' || CAST(row_count AS VARCHAR) || ':' || CAST(size_bytes AS VARCHAR) || ':'
           || CAST(id_sum AS VARCHAR)) AS checksum_sha256,
    'nyc-taxi/year=' || strftime(d, '%Y') || '/month=' || strftime(d, '%m') || '/yellow_tripdata_'
      || strftime(d, '%Y-%m') || '.parquet' AS bronze_key
  FROM dated
),
actual AS (
  SELECT file_no, file_name, size_bytes, bronze_key,
    CASE WHEN file_no % 7 = 0 THEN sha256(checksum_sha256 || 'x') ELSE checksum_sha256 END AS checksum_sha256
  FROM f WHERE file_no % 3 != 0
)
"""

_W = "WITH " + FILES.strip() + "\n"
_SIZE = r"""
WITH t AS (
  SELECT doc_id, CAST(n_chars AS VARCHAR) || ['', 'b', 'KiB', 'kb', 'MiB', 'MB', 'GiB', 'GB', 'XB'][CAST(doc_id % 9 + 1 AS INTEGER)] AS size_text
  FROM documents
), p AS (
  SELECT doc_id, size_text, lower(trim(size_text)) AS l FROM t
), q AS (
  SELECT doc_id, size_text, regexp_full_match(l, '([0-9]+)([^0-9]*)') AS ok,
    TRY_CAST(regexp_extract(l, '^([0-9]+)([^0-9]*)$', 1) AS BIGINT) AS digits,
    CASE WHEN regexp_extract(l, '^([0-9]+)([^0-9]*)$', 2) = '' THEN 'b' ELSE regexp_extract(l, '^([0-9]+)([^0-9]*)$', 2) END AS unit
  FROM p
), r AS (
  SELECT *, digits * CASE unit WHEN 'b' THEN 1 WHEN 'kib' THEN 1024 WHEN 'kb' THEN 1000
    WHEN 'mib' THEN 1048576 WHEN 'mb' THEN 1000000 WHEN 'gib' THEN 1073741824 WHEN 'gb' THEN 1000000000 END AS size
  FROM q
)
SELECT doc_id, size_text, CASE WHEN ok AND size > 0 THEN size END AS size_bytes FROM r
"""

_NAME_RE = r"^(yellow|green|fhv|fhvhv)_tripdata_(\d{4})-(\d{2})\.parquet$"

INVENTORY_ORACLE = {
    "manifest_files": _W + f"""
SELECT file_no, file_name, year, month, row_count, size_bytes, checksum_sha256, bronze_key,
  's3://bronze/' || bronze_key AS bronze_uri, 's3a://bronze/' || bronze_key AS source_uri,
  'https://downloads.example.org/trip-data/' || file_name AS url,
  regexp_matches(file_name, '{_NAME_RE}') AS name_valid
FROM f""",
    "manifest_rollup": _W + """
SELECT COUNT(*) AS file_count, CAST(SUM(size_bytes) AS BIGINT) AS total_size_bytes,
  CAST(SUM(row_count) AS BIGINT) AS total_rows,
  string_agg(year || '-' || month, ',' ORDER BY year || '-' || month) AS months,
  MIN(year || '-' || month) || '_' || MAX(year || '-' || month) || '_' || CAST(COUNT(*) AS VARCHAR) || 'files' AS batch_id
FROM f""",
    "manifest_batch": _W + """
SELECT 'nyc_taxi' AS dataset, 'yellow' AS taxi_type, 'scale' AS year, 'batch' AS month, 'bronze' AS bronze_bucket,
  'silver' AS silver_bucket, arg_min(bronze_key, file_no) AS source_key,
  's3a://bronze/' || arg_min(bronze_key, file_no) AS source_uri,
  string_agg('s3a://bronze/' || bronze_key, ',' ORDER BY file_no) AS source_uris,
  'nyc-taxi/year=scale/month=batch' AS silver_prefix, 's3a://silver/nyc-taxi/year=scale/month=batch' AS silver_uri,
  CAST(NULL AS VARCHAR) AS problem
FROM f""",
    "ingest_plan": _W + """
SELECT f.bronze_key, f.file_name, f.size_bytes, f.checksum_sha256, a.checksum_sha256 AS actual_checksum,
  CASE WHEN a.bronze_key IS NULL THEN 'upload'
       WHEN f.checksum_sha256 IS NOT DISTINCT FROM a.checksum_sha256 AND f.size_bytes IS NOT DISTINCT FROM a.size_bytes THEN 'exists'
       ELSE 'conflict' END AS action
FROM f LEFT JOIN actual a ON f.bronze_key = a.bronze_key""",
    "manifest_diff": _W + """
SELECT *, 'left' AS side FROM (SELECT file_name, size_bytes, checksum_sha256 FROM f
  EXCEPT ALL SELECT file_name, size_bytes, checksum_sha256 FROM actual)
UNION ALL
SELECT *, 'right' AS side FROM (SELECT file_name, size_bytes, checksum_sha256 FROM actual
  EXCEPT ALL SELECT file_name, size_bytes, checksum_sha256 FROM f)""",
    "duplicate_texts": "SELECT sha256(text) AS text_sha256, COUNT(*) AS copies FROM documents GROUP BY 1 HAVING COUNT(*) > 1",
    "checksums": "SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS bytes FROM documents",
    "size_parse": _SIZE,
    "month_list": """
WITH r AS (SELECT CAST(date_trunc('month', MIN(o_orderdate)) AS TIMESTAMP) AS lo,
                  CAST(date_trunc('month', MAX(o_orderdate)) AS TIMESTAMP) AS hi FROM orders),
m AS (SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)), '%Y-%m') AS month FROM r)
SELECT month, regexp_matches(month, '^\\d{4}-(0[1-9]|1[0-2])$') AS valid,
  'yellow_tripdata_' || month || '.parquet' AS file_name,
  'nyc-taxi/year=' || substr(month, 1, 4) || '/month=' || substr(month, 6, 2) || '/yellow_tripdata_' || month || '.parquet' AS bronze_key
FROM m""",
    "file_name_parse": f"""
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders),
t AS (SELECT * FROM (VALUES ('yellow'), ('green'), ('fhv'), ('fhvhv')) v(t)),
n AS (
  SELECT t || '_tripdata_' || month || '.parquet' AS file_name FROM m, t
  UNION ALL SELECT t || '_tripdata_' || replace(month, '-', '') || '.parquet' FROM m, t
  UNION ALL SELECT t || '_tripdata_' || month || '.csv' FROM m, t
)
SELECT file_name, regexp_matches(file_name, '{_NAME_RE}') AS valid,
  CASE WHEN regexp_matches(file_name, '{_NAME_RE}') THEN regexp_extract(file_name, '{_NAME_RE}', 1) END AS taxi_type,
  CASE WHEN regexp_matches(file_name, '{_NAME_RE}') THEN regexp_extract(file_name, '{_NAME_RE}', 2) END AS year,
  CASE WHEN regexp_matches(file_name, '{_NAME_RE}') THEN regexp_extract(file_name, '{_NAME_RE}', 3) END AS month
FROM n""",
    "file_row_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}.parquet' AS file_name, COUNT(*) AS row_count FROM {t}" for t in TABLES
    ),
}
