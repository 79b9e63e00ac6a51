import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshore.llm import hard_negatives
from lakeshore.llm.hard_negatives import Best, bounded_pairs, mine, op11_hard_negatives, scaled, usable
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, tile int"


def brute(rows, every, k=5, low=80, high=100):
    """All scores in Python's integers."""
    usable_rows = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label, *_ in rows
                   if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    usable_rows = {r for r in usable_rows if sum(x * x for x in r[2]) < 1 << 62}
    out = []
    for i, label, v in usable_rows:
        if i % every:
            continue
        near = {(-sum(p * q for p, q in zip(v, w, strict=True)), j, k == label) for j, k, w in usable_rows if len(w) == len(v)}
        positives = sorted({(s, j) for s, j, same in near if same and j != i})[:k]
        for ps, p in positives:
            negatives = sorted({(s, j) for s, j, same in near if not same and low * -ps <= 100 * -s <= high * -ps})
            out += [(i, p, rank, n, -ps, -s) for rank, (s, n) in enumerate(negatives[:k], 1)]
    return sorted(out)


def vectors(n=900, dims=24):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, dims)) + 1
    rows = []
    for i in range(n):
        v = (centres[i % 6] + rng.standard_normal(dims)).round(3) / 8
        rows.append([i, v.tolist(), int(rng.integers(0, 4)) if i % 3 else 0, "x", 0])  # a hot label
    rows[11][1], rows[12][1], rows[13][1], rows[14][2] = None, [math.nan] * dims, [None] * dims, None
    rows[15][1], rows[16][1] = [], [1.0] * 7  # other lengths
    rows[17][0] = None
    for i in (40, 50, 60):  # equal vectors of one label and of others
        rows[i][1] = rows[20][1]
    rows[70][1] = [2.0**40] * dims  # beyond the doubles' whole numbers, and beyond 64 bits
    rows[75][1] = [2.0**19] * dims
    for i, size, label in ((80, 1, 0), (81, 0.95, 0), (82, 0.9, 1), (83, 0.94, 1)):
        rows[i][1:3] = [size * 2.0**20 + 0.1] * dims, label
    return rows


def found(rows, **options):
    got = mine(rows, F.col("vec_id") % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("anchor_bytes,tile_rows", [(1 << 24, 1 << 20), (2000, 200)])
def test_equal_to_brute_force(spark, monkeypatch, anchor_bytes, tile_rows):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", anchor_bytes)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile_rows)
    rows = vectors()
    got = found(usable(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows, 10)
    assert {r[0] for r in got} and any(r[4] > 1 << 53 for r in got)


def test_repeated_rows_and_ids(spark):
    rows = vectors(200)
    rows += rows[20:30] * 40  # a third of all rows
    rows += [[30, rows[3][1], 1, None, None], [30, rows[3][1], 2, None, None], [31, rows[4][1], 3, None, None]]
    assert found(usable(spark.createDataFrame(rows, SCHEMA))) == [r for r in brute(rows, 10)]


def test_other_limits(spark):
    rows = vectors(300)
    got = found(usable(spark.createDataFrame(rows, SCHEMA)), positives=2, negatives=7, low=50, high=90)
    assert got == sorted(r for r in limited(rows))


def limited(rows):
    scores = {}
    for r in brute(rows, 10, k=10_000, low=50, high=90):
        scores.setdefault((r[0], -r[4], r[1]), []).append(r)
    best = {}
    for anchor, score, positive in positives(rows):
        best.setdefault(anchor, []).append((score, positive))
    for anchor, found_ in best.items():
        for score, positive in sorted(found_)[:2]:
            yield from scores.get((anchor, score, positive), [])[:7]


def positives(rows):
    fit = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label, *_ in rows if i is not None and label is not None and v is not None
           and all(x is not None and math.isfinite(x) for x in v)]
    fit = [r for r in fit if sum(x * x for x in r[2]) < 1 << 62]
    for i, label, v in fit:
        for j, k, w in fit:
            if i % 10 == 0 and i != j and label == k and len(v) == len(w):
                yield i, -sum(p * q for p, q in zip(v, w, strict=True)), j


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(2)
    flat = (rng.standard_normal(200 * 64) + rng.integers(0, 3, 200 * 64)).ravel()
    all_ = scaled(np.arange(200), np.zeros(200, int), flat, np.arange(0, 200 * 64 + 1, 64))[64]
    truth = all_.values @ all_.values.T
    for mean, rest in all_.levels:
        middle, spread = mean @ mean.T, rest @ rest.T
        assert (truth <= middle + spread + 1e-3).all() and (truth >= middle - spread - 1e-3).all()
    least = np.quantile(truth, 0.99, axis=1)
    most = np.quantile(truth, 0.995, axis=1)
    x, y = bounded_pairs(all_, all_, np.ones((200, 200), bool), least, most)
    pairs = set(zip(x.tolist(), y.tolist(), strict=True))
    assert len(pairs) < 40_000  # some are ruled out
    assert {(i, j) for i, j in zip(*np.nonzero((truth >= least[:, None]) & (truth <= most[:, None])), strict=True)} <= pairs


def test_best_keeps_ties_by_the_smaller_id():
    best = Best(2, 2)
    best.add(np.array([0, 0, 0, 1]), np.array([5, 5, 5, -1]), np.array([9, 3, 9, 1]))
    best.add(np.array([0, 1]), np.array([5, -1]), np.array([1, 0]))
    assert list(zip(best.slot, best.score, best.row, strict=True)) == [(0, 5, 1), (0, 5, 3), (1, -1, 0), (1, -1, 1)]


def test_empty_table_and_no_anchor(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert found(usable(none)) == []
    assert found(usable(spark.createDataFrame([[1, [1.0], 1, "", 0], [3, [1.0], 2, "", 0]], SCHEMA))) == []


def test_query_equals_brute_force(spark):
    rows = [[r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label] for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op11_hard_negatives(spark, SF01).collect()) == brute(rows, 100)
