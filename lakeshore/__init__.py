"""lakeshore: a batch trip-record lakehouse expressed with the PySpark DataFrame/SQL API.

Layers: raw (bronze) sources -> silver (typed, validated, deduplicated) -> gold
(daily / location / payment aggregates) -> a file-driven SQL query set, plus the
benchmark statistics, file inventory, ingest planning, synthetic data, markup and
metric time-series jobs that surround it.  Every function takes and returns
DataFrames; nothing is collected except one-row metrics and result samples.
"""

__version__ = "0.1.0"
