import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from lakeshore.llm.packing import best_configuration, best_fit, cut, op7_best_fit_packing, pack_documents, solve
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, piece string"


def demand_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1)


def check(groups, demand, capacity):
    seen = np.zeros(capacity + 1, int)
    for pattern, count in groups:
        assert count > 0 and 0 < sum(pattern) <= capacity
        for s in pattern:
            seen[s] += count
    assert (seen == demand).all()


def test_cut():
    assert cut(1, 4) == [(0, 1)]
    assert cut(4, 4) == [(0, 4)]
    assert cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert cut(8, 4) == [(0, 4), (4, 4)]


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        values = np.where(rng.random(13) < 0.5, rng.random(13), 0.0)
        values[0] = 0
        best = np.zeros(13)
        for c in range(1, 13):
            best[c] = max(best[c - s] + values[s] for s in range(1, c + 1))
        chosen = best_configuration(values, 12)
        assert sum(chosen) <= 12 and sum(values[s] for s in chosen) == pytest.approx(best[12])


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_the_demand_in_few_sequences(seed):
    rng = random.Random(seed)
    capacity = 100
    lengths = [min(capacity, 1 + int(rng.expovariate(1 / 30))) for _ in range(5000)]
    demand = demand_of(lengths, capacity)
    groups = solve(demand, capacity)
    check(groups, demand, capacity)
    assert sum(n for _, n in groups) <= 1.02 * -(-sum(lengths) // capacity) + 3
    check(best_fit(demand, capacity), demand, capacity)


def test_plan_of_pairs_is_optimal():
    demand = np.zeros(11, int)
    demand[[7, 3, 6, 4]] = [50, 50, 30, 30]
    assert sum(n for _, n in solve(demand, 10)) == 80
    assert solve(np.zeros(11, int), 10) == []


def verify(rows, docs):
    reference = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    want = []
    for i, text, *_ in docs:
        ids = np.array(reference.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want += [(i, k, a, n, zlib.crc32(ids[a: a + n].tobytes())) for k, (a, n) in enumerate(cut(len(ids), 1024))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(want, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences)


def test_all_rows_are_packed(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["alpha", "βeta", "x1"]) for _ in range(rng.choice([0, 1, 30, 400, 3000]))), "clash") for i in range(60)]
    docs += [(100, None, None), (100, None, None), (None, "no id", None), (None, "no id", None), (101, "long" * 20000, None)]
    rows = pack_documents(spark.createDataFrame(docs, SCHEMA)).collect()
    verify(rows, docs)
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = op7_best_fit_packing(spark, SF001).collect()
    assert verify(rows, docs) <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 2


def test_added_tokens_as_in_the_library(spark):
    """Against the library's plain call, nothing set on it."""
    reference = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>\n\n y<|endoftext|><|endoftext|> z", "no <|endoftext| >"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    got = {r[0]: (r[3], r[4]) for r in pack_documents(docs).collect()}
    for i, text in enumerate(texts):
        ids = np.array(reference.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), text
