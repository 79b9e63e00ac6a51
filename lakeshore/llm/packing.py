"""Best-fit packing of token sequences by a configuration linear program.

Pieces of at most ``capacity`` tokens are counted by length.  The linear program has a
variable for each way (configuration) to fill a sequence; multiplicative weights solve it,
with a knapsack by dynamic programming as the pricing step.  The solution is rounded down
and what is left is packed best fit, largest first, still by counts.  The plan's size
depends on the capacity only; Spark deals the pieces out to its places by their rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import parallelism, saved, work_folder
from lakeshore.llm.tokens import encoder
from lakeshore.sources.tables import read_table

CAPACITY = 1024
END_OF_TEXT = 2
#: Multiplicative weights: sharpness, share of a length that one step may cover, most steps.
SHARPNESS = 12.0
STEP = 0.25
MAX_STEPS = 1500

Groups = list[tuple[list[int], int]]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = min(n, (n - 1) % capacity + 1)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_OF_TEXT) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece.

    A null or empty text is the end token alone; repeated rows are repeated pieces.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, added=True)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(enc.encode(text or ""), end).astype("<u4")
                data = memoryview(ids).cast("B")
                for k, (a, n) in enumerate(cut(len(ids), capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(data[4 * a: 4 * (a + n)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_configuration(values: np.ndarray, capacity: int) -> list[int]:
    """The lengths, largest first, whose values sum to the most within the capacity
    (unbounded knapsack); ``values[s]`` is that of length s, 0 where there is none."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        total = values[c:0:-1] + best[:c]  # lengths c, c-1, ..., 1: of equals the largest
        k = int(np.argmax(total))
        best[c], pick[c] = total[k], c - k
        if best[c] <= best[c - 1]:
            best[c], pick[c] = best[c - 1], 0
    out, c = [], capacity
    while c > 0:
        if pick[c]:
            out.append(int(pick[c]))
            c -= pick[c]
        else:
            c -= 1
    return sorted(out, reverse=True)


def solve(demand: np.ndarray, capacity: int) -> Groups:
    """Multiplicative weights on the configuration program: a length's weight falls as its
    covered share grows; each step adds the configuration of the largest weight.  Returns
    configurations with how often they are used, rounded down and within the demand."""
    sizes = np.arange(capacity + 1, dtype=float)
    present = demand > 0
    covered = np.zeros(capacity + 1)
    used: dict[tuple[int, ...], float] = {}
    for _ in range(MAX_STEPS if present.any() else 0):
        weights = np.where(present, sizes * np.exp(-SHARPNESS * (covered - covered[present].min())), 0.0)
        chosen = tuple(best_configuration(weights, capacity))
        kinds, counts = np.unique(chosen, return_counts=True)
        step = STEP * float(np.min(demand[kinds] / counts))
        covered[kinds] += step * counts / demand[kinds]
        used[chosen] = used.get(chosen, 0.0) + step
        if covered[present].min() >= 1:
            break
    left = demand.astype(np.int64).copy()
    groups: Groups = []
    for chosen, amount in sorted(used.items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        kinds, counts = np.unique(chosen, return_counts=True)
        times = int(min(amount, float(np.min(left[kinds] // counts))))
        if times > 0 and sum(chosen) == capacity:
            left[kinds] -= times * counts
            groups.append((list(chosen), times))
    return groups + best_fit(left, capacity)


def best_fit(demand: np.ndarray, capacity: int) -> Groups:
    """Best fit, largest first, on counts: equal sequences are one group."""
    open_: dict[int, list[tuple[list[int], int]]] = {}
    room = np.zeros(capacity + 1, bool)
    for s in range(capacity, 0, -1):
        n = int(demand[s])
        while n > 0:
            fits = np.flatnonzero(room[s:])
            if len(fits):
                r = s + int(fits[0])
                pattern, count = open_[r].pop()
            else:
                r, pattern, count = capacity, [], n
            # a sequence takes all that fit before the next one is begun
            per = r // s
            times, each = (min(count, n // per), per) if n >= per else (1, n)
            if len(fits):
                if count > times:
                    open_[r].append((pattern, count - times))
                room[r] = bool(open_[r])
            open_.setdefault(r - each * s, []).append((pattern + [s] * each, times))
            room[r - each * s] = True
            n -= each * times
    return [g for groups in open_.values() for g in groups]


def places(groups: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of ranks: of each length, the pieces from ``first`` on take one place each in
    the sequences from ``sequence`` on, at ``offset``; in order of length and rank."""
    rows, used, sequence = [], {}, 0
    for pattern, count in groups:
        offset = 0
        for s in pattern:
            rows.append((s, used.get(s, 0), sequence, offset))
            used[s] = used.get(s, 0) + count
            offset += s
        sequence += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return tuple(table.T)


_RANK_BITS = 44


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``table`` (rows with ``length``) with ``sequence_id`` and ``offset``.

    Ranks within a length are dealt in hash buckets, so that one frequent length is not one
    task.  ``table`` is read several times and must be stored.
    """
    spark = table.sparkSession
    keys = [c for c in ("doc_id", "piece") if c in table.columns]
    table = table.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(parallelism(spark))))
    counts = table.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = saved(counts.withColumn("__first", F.coalesce(F.sum("__n").over(before), F.lit(0))),
                   work_folder(spark, "packing-counts"))
    demand = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect():  # a row per length, capacity at most
        demand[row["length"]] = row["n"]
    length, first, sequence, offset = places(solve(demand, capacity))
    starts = (length << _RANK_BITS) | first

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            at = np.searchsorted(starts, (size << _RANK_BITS) | rank, "right") - 1
            kept = [batch.column(c) for c in out_columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence[at] + rank - first[at], pa.int64()), pa.array(offset[at], pa.int64())],
                names=[*out_columns, "sequence_id", "offset"])

    out_columns = [c for c in table.columns if c != "__bucket"]
    within = Window.partitionBy("length", "__bucket").orderBy(*keys)
    ranked = (table.withColumn("__row", F.row_number().over(within))
              .join(counts.select("length", "__bucket", "__first"), ["length", "__bucket"])
              .withColumn("__rank", (F.col("__first") + F.col("__row") - 1).cast("long"))
              .select(*out_columns, "__rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.select(*out_columns).schema)
    return ranked.mapInArrow(assign, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """All documents, cut and packed; see :func:`pieces` and :func:`pack`."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    table = saved(pieces(docs, path), work_folder(spark, "packing-pieces"))
    return pack(table)


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 1024 tokens."""
    return pack_documents(read_table(spark, sf_dir, "documents"))
