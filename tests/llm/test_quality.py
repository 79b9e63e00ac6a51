import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshore.llm import quality
from lakeshore.llm.quality import base_counts, judge
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, lang string, n_words string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c", "a a a a", "x y z\nx y z\n\nx y z\r\n", "é日 ½ #tag <b>|", "q w e r t y " * 40,
    "\x1c\xa0a b", " ".join(f"w{i % 97} v{i % 89}" for i in range(3000)), "the of and " * 30 + "rest", "No repeats " + " ".join(map(str, range(200))),
]


def test_base_counts_match_brute_force(spark):
    rows = [(i, t, "en", "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None, None), (None, "a b", "xx", None)]
    got = base_counts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for row in got:
        n = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert n == brute(row.text), row.text
        assert row.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert sum(row.char_bins) == len(row.text or "")


def test_both_ways_of_finding_repeats_agree(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, "en", None) for i, t in enumerate(TEXTS)], SCHEMA)
    by_value = base_counts(df).select("doc_id", "n_repeat_words").collect()
    monkeypatch.setattr(quality, "FEW_REPEATED", 0)
    assert sorted(base_counts(df).select("doc_id", "n_repeat_words").collect()) == sorted(by_value)


def test_divergence_rejects_junk_and_keeps_prose(spark):
    words = ["the", "of", "and", "to", "in", "is", "that", "for"]
    prose = [(i, " ".join(f"{words[(i + 7 * k) % 8]} plain{(i * 31 + k * 17) % 1009}" for k in range(150)), "en", None) for i in range(30)]
    junk = [(100, " ".join(f"WORD{k}!! %%%" for k in range(120)), "en", None),
            (101, " ".join(f"for other{k}" for k in range(150)), "en", None)]
    short = [(102, "too short", "en", None)]
    kept = {r.doc_id: r.kept for r in judge(base_counts(spark.createDataFrame(prose + junk + short, SCHEMA))).collect()}
    assert all(kept[i] for i in range(30))
    assert not kept[100] and not kept[101] and not kept[102]


def test_empty_table(spark):
    assert judge(base_counts(spark.createDataFrame([], SCHEMA))).count() == 0


def test_labelled_clean_documents_are_kept(spark):
    out = quality.op6_quality_rules(spark, SF001)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    judged = out.where("NOT base_failed").join(labels, "doc_id")
    shares = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] == 1.0 and shares[0] < 0.8


@pytest.mark.parametrize("forbidden", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(spark, forbidden):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert forbidden not in judge(base_counts(docs))._jdf.queryExecution().executedPlan().toString()
