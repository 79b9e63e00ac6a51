import numpy as np
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from lakeshore.llm import tokens
from tests.conftest import SF001

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "a", "Hello world, it's 12,345.\n\n\nNew  line\n", "naïve café 日本語 🎉🎉", " lead\ttab", "a\x1cb\x85c\xa0 d", "x" * 3000, "<|endoftext|>\n"]


def reference():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_ids_and_spans_equal_the_tokenizer_library():
    ours, theirs = tokens.Encoder(PATH), reference()
    for text in TEXTS:
        want = theirs.encode(text, add_special_tokens=False)
        ids = ours.encode(text)
        assert ids.tolist() == want.ids
        starts, ends = tokens.token_spans(text.encode(), ours.sizes[ids])
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == want.offsets


def test_rank_file_is_the_same_vocabulary():
    assert tokens.load_ranks(PATH) == tokens.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_boundary_crossing_rule():
    starts, ends = np.array([0, 3, 7, 9, 14]), np.array([3, 7, 9, 13, 16])
    sections = np.array([0, 4, 9]), np.array([4, 8, 12])
    owner, crossing = tokens.attribute(starts, ends, *sections)
    assert owner.tolist() == [0, 1, 1, 2, -1]
    assert crossing.tolist() == [False, True, True, True, False]
    first, _ = tokens.attribute(starts, ends, *sections, rule="first")
    assert first.tolist() == [0, 0, 1, 2, -1]
    tie, _ = tokens.attribute(np.array([2]), np.array([6]), np.array([0, 4]), np.array([4, 8]))
    assert tie.tolist() == [0]


def test_lines_hold_all_tokens(spark):
    rows = [(i, t, "clash") for i, t in enumerate([None, *TEXTS])] + [(2, TEXTS[1], None), (None, "a\nb", None)]
    out = tokens.section_tokens(spark.createDataFrame(rows, "doc_id long, text string, start string"), PATH)
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    theirs = reference()
    for i, text, _ in rows:
        repeats = sum(r[0] == i for r in rows)
        assert got[i] == repeats * len(theirs.encode(text or "", add_special_tokens=False).ids)
    empty = tokens.section_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert empty.count() == 0


def test_query_against_brute_force(spark):
    theirs = reference()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect()  # the fixture, not the query
    got = {}
    for r in tokens.op1_token_counts(spark, SF001).collect():
        got.setdefault(r.doc_id, {})[r.section] = (r.start, r.end, r.n_tokens)
    for doc in docs:
        starts, ends = tokens.line_spans(doc.text)
        counts = [0] * len(starts)
        for a, b in theirs.encode(doc.text, add_special_tokens=False).offsets:
            shares = [min(b, e) - max(a, s) for s, e in zip(starts, ends, strict=True)]
            counts[shares.index(max(shares))] += 1
        assert got[doc.doc_id] == {i: (s, e, n) for i, (s, e, n) in enumerate(zip(starts, ends, counts, strict=True))}
