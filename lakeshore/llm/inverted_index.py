"""Embedding near duplicates by an inverted multi-index.

Vectors are scaled to length one and cut into halves; each half has a codebook of its own,
and the pairs of codes form a grid of cells.  A vector is stored in its nearest cell and
searches the cells in the order of their distance (the sum over halves, the multi-sequence
order) as far as a margin that is set on simulated neighbours for a target recall.  Pairs
found are verified exactly.  Equal vectors are one stored vector with a multiplicity.

The codebooks have the commonest length of the sample; vectors of another length are put in
cells by their first components, or with zeros added, which brings no two of them further
apart, and are compared whole with those of their own length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import parallelism, saved, work_folder
from lakeshore.llm.components import components
from lakeshore.sources.tables import read_table

LEAST_COSINE = 0.93
#: Rows that the codebooks and the margin are fitted on, in the order of a hash of vec_id.
SAMPLE_ROWS = 8192
#: Stored vectors of a label aimed at per cell, and the most codes of a half.
CELL_ROWS = 48
MOST_CODES = 512
#: Share of simulated neighbours, at the least cosine, whose cell must be within the margin.
TARGET_RECALL = 0.9
#: Vectors of a cell, and searches into it, that one task compares at once.
BLOCK_ROWS = 1024


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, and the margin of the search."""

    books: tuple[np.ndarray, np.ndarray]
    margin: float

    def distances(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Squared distances of each half to its codes."""
        cut = vectors.shape[1] // 2
        return [(h * h).sum(1)[:, None] - 2 * h @ b.T + (b * b).sum(1)[None]
                for h, b in zip((vectors[:, :cut], vectors[:, cut:]), self.books, strict=True)]

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest cell of every vector."""
        left, right = self.distances(vectors)
        return left.argmin(1) * len(self.books[1]) + right.argmin(1)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell within the margin, nearest cells first.

        The multi-sequence order walks the two sorted lists of codes by the sum of their
        distances; a code whose own distance passes the margin ends its list.
        """
        left, right = self.distances(vectors)
        left -= left.min(1, keepdims=True)
        right -= right.min(1, keepdims=True)
        rows, cells = [], []
        orders = [np.argsort(x, axis=1, kind="stable") for x in (left, right)]
        for i in range(len(vectors)):
            a, b = (o[i][: np.searchsorted(x[i][o[i]], self.margin, "right")] for o, x in zip(orders, (left, right), strict=True))
            total = left[i][a][:, None] + right[i][b][None]
            x, y = np.nonzero(total <= self.margin)
            order = np.argsort(total[x, y], kind="stable")
            rows.append(np.full(len(x), i))
            cells.append(a[x[order]] * len(self.books[1]) + b[y[order]])
        return (np.concatenate(rows), np.concatenate(cells)) if rows else (np.zeros(0, int), np.zeros(0, int))


def k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from distinct random points; an empty code keeps its place."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = ((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1)[None]).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def fit(sample: np.ndarray, rows: int, labels: int, least: float = LEAST_COSINE, recall: float = TARGET_RECALL) -> Index:
    """Codebooks for ``rows`` stored vectors of ``labels`` labels, and the margin at which
    the share ``recall`` of simulated neighbours is found.

    A simulated neighbour lies at the least cosine from a sample vector, in a random
    direction; it is found if the margin of the one reaches the home cell of the other."""
    rng = np.random.default_rng(7)
    codes = int(np.clip(np.sqrt(rows / max(1, labels) / CELL_ROWS), 2, min(MOST_CODES, max(2, len(sample) // 16))))
    cut = sample.shape[1] // 2
    index = Index((k_means(sample[:, :cut], codes, rng), k_means(sample[:, cut:], codes, rng)), 0.0)
    noise = rng.standard_normal(sample.shape)
    noise -= (noise * sample).sum(1, keepdims=True) * sample
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    near = least * sample + np.sqrt(1 - least * least) * noise

    def gap(queries: np.ndarray, cells: np.ndarray) -> np.ndarray:
        left, right = index.distances(queries)
        a, b = np.divmod(cells, len(index.books[1]))
        at = np.arange(len(queries))
        return left[at, a] - left.min(1) + right[at, b] - right.min(1)

    gaps = np.minimum(gap(near, index.home(sample)), gap(sample, index.home(near)))
    return Index(index.books, float(np.quantile(gaps, recall)) + 1e-9)


def _matrix(column: pa.Array, length: int = 0) -> np.ndarray:
    """Vectors as rows of ``length`` components (0: the commonest length, the least of equals)."""
    rows = [np.frombuffer(x, np.float64) for x in column.to_pylist()]
    if not length:
        sizes, counts = np.unique([len(x) for x in rows], return_counts=True)
        length = int(sizes[counts.argmax()])
    out = np.zeros((len(rows), length))
    for i, x in enumerate(rows):
        out[i, : len(x)] = x[:length]
    return out


def unit_vectors(table: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, unit``: the label with the vector's length before it, and the scaled
    vector (bytes of doubles), null unless it can link: it has finite components and is not
    null, empty or zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for values in batch.column("vector"):
                unit = None
                if values.is_valid and not values.values.null_count and len(values.values):
                    x = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                        x = x / top
                        unit = (x / np.linalg.norm(x)).tobytes()
                units.append(unit)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(units, pa.binary())],
                                             names=["vec_id", "label", "unit"])

    source = table.select(table[key].cast("long").alias("vec_id"), table[label].cast("string").alias("label"),
                          table[vector].alias("vector"))
    units = source.mapInArrow(run, "vec_id long, label string, unit binary")
    return units.withColumn("label", F.concat(F.length("unit") / 8, F.lit(":"), "label"))


def _searches(stored: DataFrame, index: Index) -> DataFrame:
    """``node, label, unit, copies, home, cells``: each stored vector's cell and search."""
    length = sum(b.shape[1] for b in index.books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("unit"), length)
            rows, cells = index.cells(vectors)
            lists = np.split(cells, np.flatnonzero(np.diff(rows)) + 1) if len(rows) else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "label", "unit", "copies")), pa.array(index.home(vectors) if len(vectors) else [], pa.int64()),
                 pa.array([c.tolist() for c in lists], pa.list_(pa.int64()))],
                names=["node", "label", "unit", "copies", "home", "cells"])

    return stored.mapInArrow(run, "node long, label string, unit binary, copies long, home long, cells array<bigint>")


def _compare(blocks: DataFrame, least: float) -> DataFrame:
    """``kind, a, b``: kind 0 an edge of a spanning forest of a block's links, kind 1 the
    number b of vectors that a is linked with there."""
    def links(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        kept = [r for r in rows if r["stored"]]
        asking = [r for r in rows if not r["stored"]]
        none = np.zeros(0, np.int64)
        if not kept or not asking:
            return none, none, none, none
        x, y = (np.frombuffer(b"".join(r["unit"] for r in part), np.float64).reshape(len(part), -1) for part in (asking, kept))
        i, j = np.nonzero(x @ y.T >= least - 1e-9)
        q, s = (np.array([r["node"] for r in part], np.int64) for part in (asking, kept))
        exact = (x[i] * y[j]).sum(1) >= least
        i, j = i[exact], j[exact]
        other = q[i] != s[j]
        i, j = i[other], j[other]
        # a pair that either finds from its side counts once: where both do, on the smaller's search
        home = np.array([r["home"] for r in asking], np.int64)
        back = [frozenset(r["cells"]) for r in kept]
        once = np.fromiter((q[a] < s[b] or home[a] not in back[b] for a, b in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
        i, j = i[once], j[once]
        return q[i], s[j], np.array([r["copies"] for r in asking], np.int64)[i], np.array([r["copies"] for r in kept], np.int64)[j]

    def out(found: list[tuple]) -> pa.RecordBatch:
        a, b, copies_a, copies_b = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([copies_b, copies_a]), len(ids)).astype(np.int64)
        lead = np.arange(len(ids))  # smallest reachable id, by repeated minima over the edges
        ea, eb = at[: len(a)], at[len(a):]
        while len(a):
            new = lead.copy()
            np.minimum.at(new, ea, lead[eb])
            np.minimum.at(new, eb, lead[ea])
            new = new[new]
            if (new == lead).all():
                break
            lead = new
        tree = lead != np.arange(len(ids))
        kind = np.concatenate([np.zeros(tree.sum(), np.int32), np.ones(len(ids), np.int32)])
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(np.concatenate([ids[tree], ids])), pa.array(np.concatenate([ids[lead[tree]], counts]))],
            names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, found, size = None, [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != key:
                    found.append(links(rows))
                    size += len(found[-1][0])
                    key, rows = row["block"], []
                    if size > 1_000_000:
                        yield out(found)
                        found, size = [], 0
                rows.append(row)
        found.append(links(rows))
        yield out(found)

    return blocks.mapInArrow(run, "kind int, a long, b long")


def near_duplicates(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    least: float = LEAST_COSINE, recall: float = TARGET_RECALL) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row of ``table``.

    Vectors of equal label and length link from cosine ``least`` on.  Null, empty, zero and
    non-finite vectors and null labels link with nothing; a row without key has no
    component.  Rows that repeat are copies, linked with each other.  Rows that share a key
    with different vectors or labels are vectors of their own: each counts as one link of
    those it is linked with, and has its own class.
    """
    spark = table.sparkSession
    folder = work_folder(spark, "inverted-index")
    units = saved(unit_vectors(table, key, vector, label), f"{folder}/units")
    usable = units.where("unit IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    stored = saved(usable.groupBy("label", "unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
                   .withColumn("node", F.monotonically_increasing_id()), f"{folder}/stored")
    rows, labels = stored.agg(F.count("*"), F.count_distinct("label")).first()
    if not rows:
        return units.select(F.col("vec_id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.lit(True).alias("kept"))
    some = stored.orderBy(F.xxhash64("id"), "id", "label", "unit").limit(SAMPLE_ROWS).select("unit").toArrow()  # bounded
    index = fit(_matrix(some.column("unit").combine_chunks()), rows, labels, least, recall)
    searches = saved(_searches(stored, index), f"{folder}/searches")

    # blocks of a cell: its vectors and the searches into it, in tiles of bounded size
    own = searches.select("label", F.col("home").alias("cell"), "node", "unit", "copies", "home", "cells")
    asked = searches.select("label", F.explode("cells").alias("cell"), "node", "unit", "copies", "home")
    sizes = (own.groupBy("label", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("stored_tiles"))
             .join(asked.groupBy("label", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("asked_tiles")), ["label", "cell"]))
    spread = F.pmod(F.xxhash64("node"), F.lit(2**31)).cast("long")

    def tiles(rows: DataFrame, mine: str, theirs: str, first: bool) -> DataFrame:
        tiled = rows.join(sizes, ["label", "cell"]).withColumn("mine", spread % F.col(mine)).withColumn(
            "theirs", F.explode(F.sequence(F.lit(0).cast("long"), F.col(theirs) - 1)))
        tile = ("mine", "theirs") if first else ("theirs", "mine")
        return tiled.select(F.concat_ws("|", "label", "cell", *tile).alias("block"), F.lit(first).alias("stored"),
                            "node", "unit", "copies", "home", F.col("cells") if first else F.lit(None).cast("array<bigint>").alias("cells"))

    blocks = tiles(own, "stored_tiles", "asked_tiles", True).unionByName(tiles(asked, "asked_tiles", "stored_tiles", False))
    dealt = blocks.repartition(parallelism(spark), "block").sortWithinPartitions("block")
    found = saved(_compare(dealt, least), f"{folder}/links")
    counts = found.where("kind = 1").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked"))
    others = components(found.where("kind = 0").select("a", "b"))
    classes = others.unionByName(others.select(F.col("component").alias("node"), "component").distinct())
    least_ids = classes.join(stored, "node").groupBy("component").agg(F.min("id").alias("least_id"))
    named = (stored.join(counts, "node", "left").join(classes, "node", "left").join(least_ids, "component", "left")
             .select("label", "unit", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                     F.coalesce("least_id", "id").alias("component_id")))
    joined = units.withColumn("usable", F.when(F.col("vec_id").isNotNull(), F.col("unit"))).join(
        named.withColumnRenamed("unit", "usable"), ["label", "usable"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(F.col("vec_id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op3_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
