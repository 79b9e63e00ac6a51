import random
from itertools import combinations

import numpy as np
import pytest

from lakeshore.llm import ngram_join
from lakeshore.llm.components import components
from lakeshore.llm.ngram_join import near_duplicates
from tests.conftest import SF001


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i: i + 5]) for i in range(len(words) - 4))


def brute(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    lead = {i: i for i in docs}

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i, j in combinations(sorted(docs), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            lead[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in docs}


def hard_documents():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(80)]
    docs = {0: None, 1: "", 2: "  \n", 3: "Three little words", 4: "three  LITTLE\twords", 5: "three little wordS!", 6: "one two three four five",
            7: "ONE two three four five"}
    for i in range(60):  # near copies of one text, chained away from it
        if i % 4 == 0 and i:
            base[rng.randrange(80)] = word()
        copy = list(base)
        copy[rng.randrange(80)] = word()
        docs[100 + i] = " ".join(copy)
    for i in range(60):  # a passage shared by many different texts, in some nearly all of it
        docs[300 + i] = " ".join(passage[i % 7:] + [word() for _ in range(rng.choice([3, 8, 15, 40]))])
    for i in range(40):
        docs[500 + i] = " ".join(word() for _ in range(rng.randrange(5, 40)))
    for i in range(10):
        docs[600 + i] = docs[100 + i]
    return docs


@pytest.mark.parametrize("tile_rows", [3, 1024])
def test_classes_equal_brute_force(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile_rows)
    docs = hard_documents()
    rows = [(i, t, "clash") for i, t in docs.items()] + [(100, docs[100], "again"), (None, docs[101], "no id")]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, n string"))
    got = out.collect()
    assert len(got) == len(rows)
    want = brute(docs)
    for row in got:
        if row.doc_id is not None:
            assert (row.n_shingles, row.component_id) == want[row.doc_id], row.doc_id


def near_threshold(n=400, words=60):
    """Texts of one group whose pairs lie on both sides of the similarity, of several sizes."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(words)]
    docs = {}
    for i in range(n):
        text = base[: rng.choice([words, words, words - 8, words - 14])]
        for _ in range(rng.randrange(1, 3)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        docs[i] = " ".join(text)
    return docs


@pytest.mark.parametrize("tile_rows", [50, 1024])
def test_group_around_the_threshold(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile_rows)
    docs = near_threshold()
    want = brute(docs)
    assert 1 < len({c for _, c in want.values()}) < len(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got == want


def test_tile_product_equals_sets():
    rng = np.random.default_rng(4)
    sets = [set(rng.integers(0, 90, rng.integers(20, 60)).tolist()) for _ in range(70)]
    owner = np.repeat(np.arange(70), [len(s) for s in sets])
    grams = np.array([g for s in sets for g in sorted(s)], np.int64)
    n = np.array([len(s) for s in sets])
    counts = ngram_join.overlap_counts(owner, grams, 70)
    assert all(counts[i, j] == len(sets[i] & sets[j]) for i, j in combinations(range(70), 2))
    side = rng.integers(0, 2, 70)
    for sides in (side, np.full(70, 2)):
        forest = ngram_join.tile_links(np.arange(70) * 10, n, sides, owner, grams)
        links = {(i, j) for i, j in combinations(range(70), 2) if 7 * counts[i, j] >= 3 * (n[i] + n[j]) and (sides[i] == 2 or sides[i] != sides[j])}
        assert {(min(a, b) // 10, max(a, b) // 10) for a, b in forest} <= links
        assert len(forest) == len({j for pair in links for j in pair}) - len(groups(links))


def groups(links):
    lead = {}

    def find(i):
        while lead.setdefault(i, i) != i:
            i = lead[i]
        return i

    for i, j in links:
        lead[find(i)] = find(j)
    return {find(i) for i in list(lead)}


def test_empty_and_unrelated_tables(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    alone = near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, None)], schema)).collect()
    assert sorted(map(tuple, alone)) == [(1, 2, 1), (2, 0, 2)]


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.op2_ngram_jaccard_join(spark, SF001).collect()}
    assert got == brute(docs)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + k: 100 for k in range(1, 30)} | {201: 200, 202: 200}
