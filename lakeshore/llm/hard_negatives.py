"""Hard negatives: per anchor and positive, the best rows of other labels below the positive.

Segment summary filtering: of each vector's segments only the mean and the deviation (the
length of what the mean leaves) are compared at first.  The product of two segments is
L * mean * mean' give or take deviation * deviation', so the sums over the segments bound
the score from both sides.  Bounds start with one segment, the vector itself; pairs that
they cannot decide are refined to shorter segments, level by level, and what is left is
scored exactly.

Anchors are a stated query set that meets all rows in blocks.  Anchors are dealt over
``blocks`` and rows over ``pieces``; a row goes to every block once, an anchor to every
piece.  A tile (block, piece) holds its anchors, at most ``ANCHOR_BYTES`` of vectors, and
streams its rows past them, keeping the best few per anchor.  Tiles are dealt by number
and not by label, so a hot label is spread like the rest.  Two passes are needed, as the
positives' scores are the negatives' limits; each ends in a merge of the tiles' best few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import parallelism
from lakeshore.sources.tables import read_table

#: Components are floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is LOW to HIGH per cent of its positive's.
LOW, HIGH = 80, 100
#: Vectors of the anchors that a task holds; they are dealt over more blocks beyond.
ANCHOR_BYTES = 16 << 20
#: Rows of a tile at most, and where the cluster could take more tiles at least, as an average.
TILE_ROWS, LEAST_TILE_ROWS = 1 << 20, 1 << 10
#: Anchors and rows that are compared at once.
ANCHORS, ROWS = 512, 1024
#: Levels of summaries: segments of a vector at each.
LEVELS = (1, 8, 32)
#: Pairs left by a level, as a share of the block, below which they are refined one by one.
SPARSE = 0.1
#: A row's squared length may not pass this, so that no score leaves 64 bits.
MOST_SQUARE = float(1 << 62)
NO_SCORE = np.iinfo(np.int64).min


@dataclass
class Vectors:
    """Scaled vectors of one length, and their summaries."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray  # float64 of whole numbers, or objects where those would not be exact

    def __post_init__(self) -> None:
        self.exact = self.values.dtype != object
        floats = self.values.astype(float)
        dims = floats.shape[1]
        self.levels = []
        for segments in LEVELS:
            if segments > max(1, dims):
                break
            cuts = np.linspace(0, dims, segments + 1).astype(int)
            sizes = np.maximum(np.diff(cuts), 1)
            means = np.add.reduceat(floats, cuts[:-1], axis=1) / sizes if dims else np.zeros((len(floats), 1))
            rest = floats - np.repeat(means, np.diff(cuts), axis=1) if dims else floats
            deviations = np.sqrt(np.add.reduceat(rest * rest, cuts[:-1], axis=1)) if dims else np.zeros((len(floats), 1))
            self.levels.append((means * np.sqrt(sizes), deviations))

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, rows: slice) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.labels, out.values, out.exact = self.ids[rows], self.labels[rows], self.values[rows], self.exact
        out.levels = [(m[rows], d[rows]) for m, d in self.levels]
        return out


def scaled(ids: np.ndarray, labels: np.ndarray, flat: np.ndarray, offsets: np.ndarray, scale: int = SCALE) -> dict[int, Vectors]:
    """Vectors by their length.  Where all products and their sums stay below 2^53 they are
    whole numbers in doubles, and exact; else they are kept as integers."""
    sizes, out = np.diff(offsets), {}
    for dims in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dims)
        values = np.floor(scale * flat[offsets[at][:, None] + np.arange(dims)].astype(float))
        squares = (values * values).sum(1)
        fits = squares < MOST_SQUARE
        values, at = values[fits], at[fits]
        if len(at) and squares[fits].max() >= 1 << 52:
            values = np.array([[int(x) for x in row] for row in values], dtype=object).reshape(len(at), dims)
        out[dims] = Vectors(ids[at], labels[at], values)
    return out


def bounded_pairs(a: Vectors, r: Vectors, wanted: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the ``wanted`` pairs that the summaries leave: those that may score
    from ``least`` to ``most`` of their anchor.  Each level looks at what the one before left,
    all at once while that is much, else pair by pair."""
    pairs = None
    for (mean_a, rest_a), (mean_r, rest_r) in zip(a.levels, r.levels, strict=True):
        if pairs is None:
            middle, spread = mean_a @ mean_r.T, rest_a @ rest_r.T
            slack = spread * 1e-9 + np.abs(middle) * 1e-9 + 1e-6
            wanted &= (middle + spread + slack >= least[:, None]) & (middle - spread - slack <= most[:, None])
            if np.count_nonzero(wanted) < SPARSE * wanted.size:
                pairs = np.nonzero(wanted)
            continue
        x, y = pairs
        middle = np.einsum("ij,ij->i", mean_a[x], mean_r[y])
        spread = np.einsum("ij,ij->i", rest_a[x], rest_r[y])
        slack = spread * 1e-9 + np.abs(middle) * 1e-9 + 1e-6
        kept = (middle + spread + slack >= least[x]) & (middle - spread - slack <= most[x])
        pairs = x[kept], y[kept]
    return np.nonzero(wanted) if pairs is None else pairs


def exact_scores(a: Vectors, r: Vectors, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer products of the pairs (x of a, y of r)."""
    if not (a.exact and r.exact):
        mine, other = a.values.astype(object), r.values.astype(object)
        whole = [sum(int(p) * int(q) for p, q in zip(mine[i], other[j], strict=True)) for i, j in zip(x, y, strict=True)]
        return np.array(whole, np.int64)
    if len(x) > SPARSE * len(a) * len(r):
        return (a.values @ r.values.T)[x, y].astype(np.int64)
    return np.einsum("ij,ij->i", a.values[x], r.values[y]).astype(np.int64)


class Best:
    """The best ``k`` distinct (score, row id) of each slot: higher scores, then smaller ids."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.slot, self.score, self.row = (np.zeros(0, np.int64) for _ in range(3))
        #: The score that a slot's next entry must reach: its k-th best, if it has k.
        self.floor = np.full(slots, NO_SCORE)

    def add(self, slot: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        good = score >= self.floor[slot]
        slot = np.concatenate([self.slot, slot[good]])
        score = np.concatenate([self.score, score[good]])
        row = np.concatenate([self.row, row[good]])
        order = np.lexsort((row, ~score, slot))  # ~ turns the order round without overflow
        slot, score, row = slot[order], score[order], row[order]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (row[1:] != row[:-1])
        slot, score, row = slot[new], score[new], row[new]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = rank < self.k
        self.slot, self.score, self.row = slot[kept], score[kept], row[kept]
        full = rank[kept] == self.k - 1
        self.floor[self.slot[full]] = self.score[full]


def _chunks(a: Vectors, r: Vectors) -> Iterator[tuple[slice, Vectors, Vectors]]:
    """Sub-blocks of a tile's anchors and a batch's rows; the first rows in short runs, as
    they set the floors."""
    start, step = 0, 64
    while start < len(r):
        rows = r.part(slice(start, start + step))
        for first in range(0, len(a), ANCHORS):
            here = slice(first, min(first + ANCHORS, len(a)))
            yield here, a.part(here), rows
        start, step = start + step, min(step * 4, ROWS)


class PositiveSearch:
    """Of each anchor of a block the best rows of its label, other than itself."""

    def __init__(self, anchors: Vectors, k: int) -> None:
        self.anchors, self.best, self.slots = anchors, Best(len(anchors), k), 1

    def add(self, rows: Vectors) -> None:
        for here, a, r in _chunks(self.anchors, rows):
            wanted = (a.labels[:, None] == r.labels[None]) & (a.ids[:, None] != r.ids[None])
            floor = self.best.floor[here].astype(float)
            x, y = bounded_pairs(a, r, wanted, floor, np.full(len(a), np.inf))
            self.best.add(x + here.start, exact_scores(a, r, x, y), r.ids[y])


class NegativeSearch:
    """Of each anchor and positive the best rows of other labels within the positive's limits.

    ``scores`` has the anchors' positive scores, padded with NO_SCORE."""

    def __init__(self, anchors: Vectors, scores: np.ndarray, k: int, low: int, high: int) -> None:
        self.anchors = anchors
        none = scores == NO_SCORE
        whole = [[(-(-low * int(s) // 100), high * int(s) // 100) for s in row] for row in scores]
        limits = np.array([[(0, -1) if n else w for n, w in zip(a, b, strict=True)] for a, b in zip(none, whole, strict=True)],
                          dtype=np.int64).reshape(*scores.shape, 2)
        self.low, self.high = limits[..., 0], limits[..., 1]
        self.open = self.low <= self.high
        self.slots, self.best = scores.shape[1], Best(scores.size, k)

    def add(self, rows: Vectors) -> None:
        slots = self.slots
        for here, a, r in _chunks(self.anchors, rows):
            low, high, is_open = self.low[here], self.high[here], self.open[here]
            floor = np.maximum(low, self.best.floor.reshape(-1, slots)[here])
            is_open = is_open & (floor <= high)
            least = np.where(is_open, floor, np.iinfo(np.int64).max).min(1).astype(float)
            most = np.where(is_open, high, NO_SCORE).max(1).astype(float)
            wanted = (a.labels[:, None] != r.labels[None]) & is_open.any(1)[:, None]
            x, y = bounded_pairs(a, r, wanted, least, most)
            scores = exact_scores(a, r, x, y)
            for slot in range(slots):
                good = is_open[x, slot] & (scores >= floor[x, slot]) & (scores <= high[x, slot])
                self.best.add((x[good] + here.start) * slots + slot, scores[good], r.ids[y[good]])


def usable(embeddings: DataFrame, label: Column | str = "label") -> DataFrame:
    """vec_id, label and embedding of the rows that take part: none of them null, and all
    components finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), "embedding")
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))


_TILE_COLUMNS = ("anchor", "vec_id", "label", "embedding", "positives")
POSITIVE_TYPE = "array<struct<rank:int,score:bigint,row_id:bigint>>"


def _tiles(rows: DataFrame, anchors: DataFrame, blocks: int, pieces: int) -> DataFrame:
    """Anchors (anchor, vec_id, label, embedding, positives) and rows, dealt to their tiles:
    each is a partition of its own, anchors first."""
    # the partition's number spreads the copies of a row, too
    piece = F.pmod(F.xxhash64("vec_id", F.spark_partition_id()), F.lit(pieces))
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks))

    def numbers(count: int) -> Column:
        return F.sequence(F.lit(0), F.lit(count - 1))

    dealt = rows.select(F.transform(numbers(blocks), lambda x: (x * pieces + piece).cast("int")).alias("tiles"), F.lit(None).cast("string").alias("anchor"),
                        "vec_id", "label", "embedding", F.lit(None).cast(POSITIVE_TYPE).alias("positives"))
    placed = anchors.select(F.transform(numbers(pieces), lambda x: (block * pieces + x).cast("int")).alias("tiles"), *_TILE_COLUMNS)
    both = placed.unionByName(dealt).withColumn("tile", F.explode("tiles")).drop("tiles")
    return both.repartitionById(blocks * pieces, "tile").sortWithinPartitions(F.col("anchor").isNull()).select(*_TILE_COLUMNS)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _vectors(rows: pa.RecordBatch, ids: np.ndarray) -> dict[int, Vectors]:
    return scaled(ids, rows.column("label").to_numpy(), *_lists(rows.column("embedding")))


def _searched(tiles: DataFrame, k: int, negatives: tuple[int, int] | None) -> DataFrame:
    """The best few of each tile: anchor, anchor_id, score, row_id, and with ``negatives`` the
    positive (slot, positive_id, positive_score) that they belong to."""
    schema = pa.schema([("anchor", pa.string()), ("anchor_id", pa.int64()), ("slot", pa.int32()), ("positive_id", pa.int64()),
                        ("positive_score", pa.int64()), ("score", pa.int64()), ("row_id", pa.int64())])

    def begin(held: list[pa.RecordBatch]) -> list[tuple[int, list[str], list, PositiveSearch | NegativeSearch]]:
        """By the vectors' length, the anchors' names and positives, and a search."""
        if not held:
            return []
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        names, numbers, positives = (table.column(c).to_pylist() for c in ("anchor", "vec_id", "positives"))
        out = []
        for dims, vectors in _vectors(table, np.arange(len(names))).items():
            at, vectors.ids = vectors.ids, np.array(numbers, np.int64)[vectors.ids]
            mine = [positives[i] for i in at]
            if negatives is None:
                search = PositiveSearch(vectors, k)
            else:
                scores = np.full((len(at), max(map(len, mine), default=1)), NO_SCORE)
                for row, entries in enumerate(mine):
                    scores[row, : len(entries)] = [e["score"] for e in entries]
                search = NegativeSearch(vectors, scores, k, *negatives)
            out.append((dims, [names[i] for i in at], mine, search))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, searches = [], None
        for batch in batches:
            first = batch.num_rows - batch.column("anchor").null_count  # anchors come before rows
            if first:
                held.append(batch.slice(0, first))
            for start in range(first, batch.num_rows, 4 * ROWS):
                if searches is None:
                    searches, held = begin(held), []
                rows = batch.slice(start, 4 * ROWS)
                vectors = _vectors(rows, rows.column("vec_id").to_numpy())
                for dims, _, _, search in searches:
                    if dims in vectors:
                        search.add(vectors[dims])
        for _, names, positives, search in searches or []:
            best = search.best
            anchor, slot = np.divmod(best.slot, search.slots)
            parts = [positives[i][j] if positives[i] else {} for i, j in zip(anchor, slot, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in anchor], pa.string()), pa.array(search.anchors.ids[anchor]), pa.array(slot.astype(np.int32)),
                 *[pa.array([p.get(c) for p in parts], pa.int64()) for c in ("row_id", "score")], pa.array(best.score), pa.array(best.row)], schema=schema)

    return tiles.mapInArrow(run, "anchor string, anchor_id long, slot int, positive_id long, positive_score long, score long, row_id long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` distinct of the tiles' best few, with their ranks from 1."""
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= k).dropDuplicates(["anchor", "slot", "rank"])


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of ``rows`` (vec_id, label, embedding; see :func:`usable`): anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer products of floor(256 * x); higher ones come first, ties by the smaller
    vec_id.  An anchor's positives are its first ``positives`` other rows of its label; each
    has the first ``negatives`` rows of other labels that score ``low`` to ``high`` per cent
    of it.  Fewer, or none, are returned where there are no more.

    Rows are known by their vec_id: a row with the anchor's own is never its positive, and
    equal scores of equal vec_id count once.  Anchors that share a vec_id, but not label and
    vector, are anchors of their own.  Vectors of different lengths have no score, empty ones
    score 0.  Rows with a squared length of 2^62 and more take no part, as their scores might
    leave 64 bits.
    """
    anchors = (rows.where(is_anchor).withColumn("anchor", F.concat_ws(":", "vec_id", F.xxhash64("label", "embedding")))
               .dropDuplicates(["anchor"]).withColumn("positives", F.lit(None).cast(POSITIVE_TYPE)))
    size = F.greatest(F.lit(1), F.size("embedding")) * 8
    counted = rows.agg(F.count("*"), F.sum(F.when(is_anchor, size))).first()
    blocks = max(1, -(-int(counted[1] or 0) // ANCHOR_BYTES))
    spread = min(-(-parallelism(rows.sparkSession) // blocks), -(-counted[0] // LEAST_TILE_ROWS))
    pieces = max(1, spread, -(-counted[0] // TILE_ROWS))

    best = _merged(_searched(_tiles(rows, anchors, blocks, pieces), positives, None), positives)
    by_anchor = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "row_id"))).alias("positives"))
    ready = anchors.drop("positives").join(by_anchor, "anchor")
    worst = _merged(_searched(_tiles(rows, ready, blocks, pieces), negatives, (low, high)), negatives)
    return worst.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vec_id divisible by 100, some labels wrong on purpose."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(usable(read_table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)
