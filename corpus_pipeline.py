"""Corpus pipeline: quality rules, toxicity, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns
that they are given; the last returns the packed pieces.  Rows without doc_id are dropped by
the first stage; rows that repeat a doc_id are judged by their own text and language there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm import toxicity
from lakeshore.llm.common import saved, work_folder
from lakeshore.llm.ngram_join import near_duplicates
from lakeshore.llm.packing import pack_documents
from lakeshore.llm.quality import base_counts, judge
from lakeshore.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules (operator 6) keep; the references are those of the
    documents given.  Null and empty texts go."""
    rows = docs.select("doc_id", "text", "lang", F.sha2("text", 256).alias("digest"))
    counted = saved(base_counts(rows).drop("text"), work_folder(spark, "quality"))
    kept = judge(counted).where("kept").select(F.col("doc_id").alias("k_id"), F.col("lang").alias("k_lang"), F.col("digest").alias("k_digest"))
    same = (docs["doc_id"] == F.col("k_id")) & docs["lang"].eqNullSafe(F.col("k_lang")) & (F.sha2(docs["text"], 256) == F.col("k_digest"))
    return docs.join(kept, same, "left_semi").select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 (operator 5); the model is trained on the labelled
    ones of the documents given."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("score < 0.5").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class (operator 2) the document of the smallest doc_id; of
    rows that repeat it and its text, one."""
    kept = near_duplicates(docs).where("component_id = doc_id").select("doc_id").distinct()
    digest = "__digest"
    rows = docs.join(kept, "doc_id", "left_semi").withColumn(digest, F.sha2("text", 256))
    return rows.dropDuplicates(["doc_id", digest]).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed best fit (operator 7)."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"{folder}/{number}-{name}")
    return docs


#: Operators 5, 2 and 7 have no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None
