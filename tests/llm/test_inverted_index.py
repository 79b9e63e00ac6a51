import math

import numpy as np

from lakeshore.llm.inverted_index import fit, near_duplicates
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<double>, label int, n_links string"


def brute(rows, least=0.93):
    usable = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = (np.array(v, float) / np.linalg.norm(v), label)
    links = {i: {j for j, (w, k) in usable.items() if j != i and k == label and float(u @ w) >= least} for i, (u, label) in usable.items()}
    lead = {}
    for i in sorted(links):
        if i in lead:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in lead:
                lead[j] = i
                todo += links[j]
    return {r[0]: (len(links.get(r[0], ())), lead.get(r[0], r[0])) for r in rows}


def vectors(n=600, dims=16):
    rng = np.random.default_rng(3)
    rows = [[i, (rng.standard_normal(dims)).tolist(), int(rng.integers(0, 3)), "x"] for i in range(n)]
    for i in range(100, 200):  # near copies, many of one vector
        source = rows[i % 7]
        rows[i] = [i, (np.array(source[1]) + 0.05 * rng.standard_normal(dims)).tolist(), source[2], None]
    for i in range(200, 230):
        rows[i] = [i, rows[0][1], rows[0][2], None]
    rows[300][1] = None
    rows[301][1] = [0.0] * dims
    rows[302][1] = [math.nan] * dims
    rows[303][1] = [None] * dims
    rows[304][1] = []
    rows[305][2] = None
    rows[306][1] = (1e-200 * np.array(rows[0][1])).tolist()
    rows[306][2] = rows[0][2]
    return rows


def test_links_are_exact_and_recall_is_high(spark):
    rows = vectors()
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute([[i, (np.array(v) * 1e200).tolist() if i == 306 else v, k, x] for i, v, k, x in rows])
    assert len(got) == len(rows)
    assert all(got[i].n_links <= n for i, (n, _) in want.items())  # none below the threshold
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(n for n, _ in want.values())
    for i in (300, 301, 302, 303, 304, 305):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    from lakeshore.llm import inverted_index

    df = spark.createDataFrame(vectors(), SCHEMA)
    whole = sorted(map(tuple, near_duplicates(df).collect()))
    monkeypatch.setattr(inverted_index, "BLOCK_ROWS", 7)
    assert sorted(map(tuple, near_duplicates(df).collect())) == whole


def test_empty_and_unusable_tables(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    out = near_duplicates(spark.createDataFrame([(1, None, 1, None), (None, [1.0], 1, None)], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in out) == [(0, 0), (1, 0)]


def test_lengths_and_repeated_ids(spark):
    """Vectors link with those of their length only; rows that share an id are vectors of their own."""
    rng = np.random.default_rng(9)
    rows, links = [], {}
    for dims in (1, 5, 16, 16, 16, 40):
        base = rng.standard_normal(dims)
        start = len(rows)
        for k in range(4):
            v = base if k < 2 else base + 0.02 * rng.standard_normal(dims)
            rows.append([len(rows), v.tolist(), dims % 2, None])
        links.update({i: start for i in range(start, len(rows))})
    rows += [[900, [1.0, 0.0, 0.0], 7, None], [900, [0.99, 0.01, 0.0], 7, None], [900, [0.0, 1.0, 0.0], 7, None], [3000, [0.98, 0.02, 0.0], 7, None],
             [901, [1.0, 0.0, 0.0], 7, None], [902, [1.0, 0.0, 0.0], 8, None]]
    got = [tuple(r) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(r[:3] for r in got if r[0] < 900) == [(i, 3, links[i]) for i in sorted(links)]
    assert sorted(r for r in got if r[0] >= 900) == [(900, 0, 900, True), (900, 3, 900, True), (900, 3, 900, True), (901, 3, 900, False),
                                                     (902, 0, 902, True), (3000, 3, 900, False)]


def test_recall_of_the_query(spark):
    from lakeshore.llm.inverted_index import op3_embedding_near_dedup

    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    want = brute(rows)
    got = {r.vec_id: r.n_links for r in op3_embedding_near_dedup(spark, SF01).collect()}
    assert all(got[i] <= n for i, (n, _) in want.items())
    assert sum(got.values()) >= 0.9 * sum(n for n, _ in want.values())


def test_cells_come_in_multi_sequence_order():
    rng = np.random.default_rng(1)
    sample = rng.standard_normal((400, 8))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    index = fit(sample, 40_000, 1)
    rows, cells = index.cells(sample[:20])
    left, right = index.distances(sample[:20])
    for i in range(20):
        total = (left[i][:, None] + right[i][None]).ravel()
        mine = cells[rows == i]
        assert mine[0] == index.home(sample[i: i + 1])[0] == total.argmin()
        assert np.all(np.diff(total[mine]) >= -1e-12)
        assert set(mine) == set(np.flatnonzero(total <= total.min() + index.margin + 1e-12))
