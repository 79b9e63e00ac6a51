"""Exact n-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per document and a column per n-gram.  Columns are dealt into blocks
by hash; a block's entries are a sorted run of (column, row) numbers.  The product is
bounded by sizes: at similarity t a document of n distinct n-grams shares at least
ceil(t n) of them with any partner, so

* a document with fewer n-grams that occur elsewhere has no partner and leaves the matrix;
* of the rest, ordered from rare to frequent, the first ones that a partner cannot all miss
  are the only columns that need to be multiplied out, and in each only rows whose sizes
  and places in that order leave room for the overlap that the pair needs.

Rows that share such a column, directly or over others, are a cluster, and only rows of one
cluster can be partners.  A cluster's product is cut into tiles: its rows are dealt into
ranges by size, and a tile multiplies two ranges whose sizes are within reach of each other.
It accumulates the overlap counts of its rows over all their shared columns in memory, drops
the pairs below the bound that their sizes set, and gives a spanning forest of the links that
are left; pairs are never rows of a table.  A cluster that fits a tile is one; a larger one
is spread over as many as it needs.  Equal sets are one row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import drop_folder, parallelism, saved, utf8_column, work_folder
from lakeshore.llm.components import components
from lakeshore.sources.tables import read_table

WORDS = 5
#: Similarity as a fraction, so that comparisons stay in integers.
NUMERATOR, DENOMINATOR = 3, 4
#: Text bytes hashed at once, and matrix entries held before a block is cut.
HASH_BYTES = 1_000_000
BLOCK_ENTRIES = 500_000
#: Matrix entries below which a block is not split for the sake of more tasks.
LEAST_BLOCK_ENTRIES = 50_000
#: Low bits of an n-gram's hash that the matrix keeps; its number has those and as many bits
#: of its block (the hash's high bits) as fit below the rank.
REST_BITS = 48
RANK_SHIFT = 56
#: Rows of a range, and their entries, that a tile takes twice at most (as averages).
TILE_ROWS = 1024
TILE_ENTRIES = 2_000_000
#: Size classes per doubling of the size, and how many a partner can lie apart.
SIZE_CLASSES = 4
REACH = 2
#: Rows of a column up to which its pairs are counted one by one, and beyond as a square.
FEW_ROWS = 32

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A-Z lower-cased, and the words of every text.

    A word's hash is the difference of a running polynomial at its ends, brought back to
    the word's start.
    """
    n = len(data)
    solid = ~_SPACE[data]
    breaks = np.zeros(n + 1, bool)
    breaks[offsets] = True
    after_gap = np.concatenate([[True], ~solid[:-1]]) if n else np.zeros(0, bool)
    starts = np.flatnonzero(solid & (after_gap | breaks[:n]))
    before_gap = np.concatenate([~solid[1:], [True]]) if n else np.zeros(0, bool)
    ends = np.flatnonzero(solid & (before_gap | breaks[1:])) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[data]] * _powers(_ODD, n), dtype=np.uint64)])
    hashes = _mix((sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts]) if n else np.zeros(0, np.uint64)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of every text with a word; a text of fewer words
    has its whole sequence as its one n-gram."""
    data, offsets = utf8_column(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + HASH_BYTES, "right")) - 1)
        part = offsets[row: stop + 1]
        hashes, counts = word_hashes(data[part[0]: part[-1]], part - part[0])
        ends = np.cumsum(counts)
        grams = np.zeros(len(hashes), np.uint64)
        full = max(0, len(hashes) - words + 1)
        for k in range(words):
            grams[:full] = grams[:full] * _ODD + hashes[k: k + full]
        grams = _mix(grams)
        for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
            if n >= words:
                yield row + i, np.unique(grams[end - n: end - words + 1])
            elif n:
                short = np.full(1, n, np.uint64)
                for h in hashes[end - n: end]:
                    short = short * _ODD + h
                yield row + i, _mix(short ^ _BYTE[n])
        row = stop


def document_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n, x, y``: every row's set size and two order-free hashes of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, y = (np.zeros(len(batch), np.int64) for _ in range(3))
            for row, grams in shingle_sets(batch.column(1), words):
                n[row] = len(grams)
                x[row] = np.bitwise_xor.reduce(grams).view(np.int64)
                y[row] = _mix(grams + _ODD).sum(dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n, x, y))], names=["doc_id", "n", "x", "y"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, x long, y long")


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit numbers, one byte place after the other."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _incidence(docs: DataFrame, blocks: int, words: int) -> DataFrame:
    """The matrix: ``block, docs, sizes, counts, grams``; per block and flush one row, with the
    documents' set sizes and their n-grams' low hash bytes."""
    scale = np.uint64(-(-(1 << 64) // blocks)) if blocks > 1 else None

    def rows(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, sets), np.int64, len(sets))
        grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
        block = (grams // scale).astype(np.int64) if blocks > 1 else np.zeros(len(grams), np.int64)
        order = np.argsort(block, kind="stable")
        grams, owner, block = grams[order], owner[order], block[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        names = np.array(ids, np.int64)
        columns: list[list] = [[], [], [], [], []]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = owner[a:b]
            heads = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
            values = (int(block[a]), names[own[heads]].tobytes(), lengths[own[heads]].astype("<u4").tobytes(),
                      np.diff(np.append(heads, b - a)).astype("<u4").tobytes(), _planes(grams[a:b], REST_BITS // 8))
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            names=["block", "docs", "sizes", "counts", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held = [], [], 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, grams in shingle_sets(batch.column(1), words):
                if names[row] is None:
                    continue
                ids.append(names[row])
                sets.append(grams)
                held += len(grams)
                if held >= BLOCK_ENTRIES:
                    yield rows(ids, sets)
                    ids, sets, held = [], [], 0
        if sets:
            yield rows(ids, sets)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "block long, docs binary, sizes binary, counts binary, grams binary")


def _shared_columns(matrix: DataFrame, partitions: int, buckets: int) -> DataFrame:
    """``bucket, docs, sizes, counts, grams``: by buckets of documents, the n-grams that
    another document has too, each with a rank of its frequency and its number."""
    def shared(block: int, held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        grams = np.concatenate([_unplanes(g, REST_BITS // 8) for *_, g in held])
        docs, sizes = (np.concatenate([np.repeat(np.frombuffer(row[i], kind), np.frombuffer(row[2], "<u4")) for row in held])
                       for i, kind in ((0, "<i8"), (1, "<u4")))
        order = np.lexsort((docs, grams))
        grams, docs, sizes = grams[order], docs[order], sizes[order]
        new = np.ones(len(grams), bool)  # a repeated row of one document is no other document
        new[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
        grams, docs, sizes = grams[new], docs[new], sizes[new]
        heads = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        frequency = np.diff(np.append(heads, len(grams)))
        frequency = np.repeat(frequency, frequency)
        many = frequency > 1
        level = np.minimum(255, 8 * np.log2(frequency[many])).astype(np.uint64)
        known = np.uint64((block << REST_BITS) & ((1 << RANK_SHIFT) - 1))
        return docs[many], sizes[many], (level << np.uint64(RANK_SHIFT)) | known | grams[many]

    def out(found: list[tuple]) -> pa.RecordBatch:
        docs, sizes, numbers = (np.concatenate(x) for x in zip(*found, strict=True))
        bucket = (_mix(docs.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((docs, bucket))
        docs, sizes, numbers, bucket = docs[order], sizes[order], numbers[order], bucket[order]
        heads = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(docs)))
        names = np.unique(bucket)
        first, last = np.searchsorted(bucket[heads], names), np.searchsorted(bucket[heads], names, "right")
        ends = np.append(heads, len(docs))
        parts = [(docs[heads[i:j]].astype("<i8").tobytes(), sizes[heads[i:j]].astype("<u4").tobytes(), counts[i:j].astype("<u4").tobytes(),
                  numbers[ends[i]: ends[j]].astype("<u8").tobytes()) for i, j in zip(first.tolist(), last.tolist(), strict=True)]
        columns = zip(*parts, strict=True) if parts else ([],) * 4
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *(pa.array(list(c), pa.binary()) for c in columns)],
                                          names=["bucket", "docs", "sizes", "counts", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for block, held in _groups(batches):
            found.append(shared(block, held))
            size += len(found[-1][0])
            if size >= BLOCK_ENTRIES:
                yield out(found)
                found, size = [], 0
        if found:
            yield out(found)

    dealt = matrix.repartitionById(partitions, F.col("block").cast("int")).sortWithinPartitions("block")
    return dealt.mapInArrow(run, "bucket long, docs binary, sizes binary, counts binary, grams binary")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each value of the first column, which come one after the other."""
    key, held = None, []
    for batch in batches:
        for first, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if first != key and held:
                yield key, held
                held = []
            key = first
            held.append(row)
    if held:
        yield key, held


def _least(n):
    """The fewest n-grams that a set of ``n`` shares with any partner: ceil(t n)."""
    return F.expr(f"({NUMERATOR} * {n} + {DENOMINATOR - 1}) div {DENOMINATOR}")


def _rows(parts: DataFrame, partitions: int) -> DataFrame:
    """``row, n, m, grams``: the matrix rows (one per distinct set) that can have a partner,
    their shared n-grams from rare to frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _groups(batches):
            docs, sizes, counts = (np.concatenate([np.frombuffer(row[i], kind) for row in held]).astype(np.int64)
                                   for i, kind in enumerate(("<i8", "<u4", "<u4")))
            numbers = np.concatenate([np.frombuffer(row[3], "<u8") for row in held])
            owner, at = np.unique(docs, return_inverse=True)
            n, m = np.zeros(len(owner), np.int64), np.bincount(at, counts, len(owner)).astype(np.int64)
            n[at] = sizes
            kept = DENOMINATOR * m >= NUMERATOR * n  # fewer shared n-grams leave no partner
            entry = np.repeat(at, counts)
            numbers, entry = numbers[kept[entry]], entry[kept[entry]]
            order = np.lexsort((numbers, entry))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(m[kept])]), pa.int32()), pa.array(numbers[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(owner[kept]), pa.array(n[kept]), pa.array(m[kept]), lists], names=["row", "n", "m", "grams"])

    dealt = parts.repartitionById(partitions, F.col("bucket").cast("int")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "row long, n long, m long, grams array<bigint>")


def _postings(rows: DataFrame) -> DataFrame:
    """``row, n, gram, most``: the columns in which a row may meet its partners first.

    A pair that shares its first column at place p of a row of n can overlap in n - p
    columns at most, and needs t / (1 + t) of both sizes together; ``most`` is the largest
    partner that this allows.  Places from which not even the smallest partner (t n) is
    within reach are left out.
    """
    place = F.col("n") - F.col("m") + F.col("at")
    most = F.expr(f"({DENOMINATOR} * n - {NUMERATOR + DENOMINATOR} * place) div {NUMERATOR}")
    return (rows.select("row", "n", "m", F.posexplode("grams").alias("at", "gram"))
            .withColumn("place", place).withColumn("most", most)
            .where(DENOMINATOR * F.col("most") >= NUMERATOR * F.col("n")).select("row", "n", "gram", "most"))


#: A row that reaches partners of its own size; of two rows that can be partners one does.
_LEADS = "most >= n"


def _clusters(rows: DataFrame, folder: str) -> DataFrame:
    """``row, cluster`` of the rows that share a column in which partners can meet first."""
    postings = saved(_postings(rows), f"{folder}/postings")
    columns = (postings.groupBy("gram").agg(F.count("*").alias("k"), F.count_if(F.expr(_LEADS)).alias("lead"), F.min("row").alias("first"))
               .where("k > 1 AND lead > 0").select("gram", "first"))
    edges = postings.join(columns, "gram").where("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b")).distinct()
    found = components(edges)
    heads = found.select(F.col("component").alias("row"), F.col("component").alias("cluster")).distinct()
    return found.select(F.col("node").alias("row"), F.col("component").alias("cluster")).unionByName(heads)


def _tiles(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """``cluster, low, high, side, row, n, grams``: every row once for each tile that it is
    part of.  A tile is a pair of ranges (class, place); ``side`` is 0 for the lower one's
    rows, 1 for the higher one's, and 2 where they are the same."""
    placed = rows.join(clusters, "row").withColumn("class", F.floor(SIZE_CLASSES * F.log2("n")).cast("int"))
    need = F.ceil(F.greatest(F.col("rows") / TILE_ROWS, F.col("entries") / TILE_ENTRIES)).cast("int")
    total = [F.count("*").alias("rows"), F.sum("m").alias("entries")]
    each = placed.groupBy("cluster", "class").agg(*total).withColumn("places", need)
    # a cluster's classes are few: four per doubling of the size
    plan = each.groupBy("cluster").agg(F.sum("rows").alias("rows"), F.sum("entries").alias("entries"), F.collect_list(F.struct("class", "places")).alias("classes"))
    plan = plan.select("cluster", need.alias("tiles"), "classes")
    one = F.struct(F.lit(0).alias("class"), F.lit(0).alias("place"))
    known = placed.join(plan, "cluster")
    places = F.filter("classes", lambda c: c["class"] == F.col("class"))[0]["places"]
    known = known.withColumn("own", F.when(F.col("tiles") == 1, one).otherwise(
        F.struct(F.col("class").alias("class"), F.pmod(F.xxhash64("row"), places).cast("int").alias("place"))))
    near = F.filter("classes", lambda c: F.abs(c["class"] - F.col("class")) <= REACH)
    others = F.flatten(F.transform(near, lambda c: F.transform(
        F.sequence(F.lit(0), c["places"] - 1), lambda place: F.struct(c["class"].alias("class"), place.alias("place")))))
    dealt = known.withColumn("other", F.explode(F.when(F.col("tiles") == 1, F.array(one)).otherwise(others)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    tile = ["cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    return dealt.select(*tile, side.alias("side"), "row", "n", "grams")


def overlap_counts(owner: np.ndarray, grams: np.ndarray, rows: int) -> np.ndarray:
    """The product: shared n-grams of each two of ``rows`` rows (upper triangle), accumulated
    column by column; columns of the same rows are added at once."""
    order = np.lexsort((owner, grams))
    owner, grams = owner[order], grams[order]
    heads = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(grams)))
    counts = np.zeros((rows, rows), np.int32)
    for size in np.unique(sizes[sizes > 1]).tolist():
        members = owner[heads[sizes == size][:, None] + np.arange(size)]
        members, times = np.unique(members, axis=0, return_counts=True)
        if size <= FEW_ROWS:
            i, j = np.triu_indices(size, 1)
            np.add.at(counts.reshape(-1), (members[:, i] * rows + members[:, j]).ravel(), np.repeat(times, len(i)).astype(np.int32))
        else:
            for who, weight in zip(members, times, strict=True):
                counts[np.ix_(who, who)] += np.int32(weight)
    return counts


def tile_links(ids: np.ndarray, n: np.ndarray, side: np.ndarray, owner: np.ndarray, grams: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest (a, b) of a tile's links: pairs of different sides (2 is either)
    whose overlap reaches the bound that their sizes set, t / (1 + t) of both together."""
    counts = overlap_counts(owner, grams, len(ids))
    linked = (NUMERATOR + DENOMINATOR) * counts.astype(np.int64) >= NUMERATOR * (n[:, None] + n[None])
    linked &= (counts > 0) & ((side[:, None] != side[None]) | (side[:, None] == 2))
    linked = np.triu(linked, 1)
    linked |= linked.T
    left, forest = linked.any(1), []
    for start in np.flatnonzero(left).tolist():
        todo = [start] if left[start] else []
        left[start] = False
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & left)
            left[new] = False
            forest += [(int(ids[at]), int(ids[i])) for i in new]
            todo += new.tolist()
    return forest


def link_rows(rows: DataFrame, folder: str) -> DataFrame:
    """Links (a, b) between matrix rows that connect all that the similarity connects."""
    tiles = _tiles(rows, _clusters(rows, folder))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("grams")
            offsets, values = lists.offsets.to_numpy().tolist(), lists.values.to_numpy()
            data = [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(data, pa.binary())], names=batch.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _groups(packed(batches)):
            side, ids, n = (np.array([row[i] for row in held], np.int64) for i in range(3))
            grams = [np.frombuffer(row[3], np.int64) for row in held]
            owner = np.repeat(np.arange(len(held)), [len(g) for g in grams])
            forest = np.array(tile_links(ids, n, side, owner, np.concatenate(grams)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(forest[:, 0]), pa.array(forest[:, 1])], schema=schema)

    named = tiles.select(F.concat_ws(" ", "cluster", "low.class", "low.place", "high.class", "high.place").alias("tile"), "side", "row", "n", "grams")
    dealt = named.repartition(parallelism(rows.sparkSession), "tile").sortWithinPartitions("tile")
    links = saved(dealt.mapInArrow(run, "a long, b long"), f"{folder}/links")
    for name in ("postings", "rows"):  # what the links were made from
        drop_folder(rows.sparkSession, f"{folder}/{name}")
    return links


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id, text).

    Null, empty and blank texts have no n-gram and link with nothing, nor do rows without
    doc_id, whose component is null.  Equal rows give equal results; rows that share a
    doc_id must share its text.  Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "ngram-join")
    sets = saved(document_sets(docs, words), f"{folder}/sets")
    classes = saved(sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "x", "y").agg(F.min("doc_id").alias("row")),
                    f"{folder}/classes")
    # blocks follow the entries, so each fits a task and none is a splinter
    entries = int(classes.agg(F.sum("n")).first()[0] or 0)
    partitions = min(parallelism(spark), max(1, -(-entries // LEAST_BLOCK_ENTRIES)))
    blocks = max(partitions, -(-entries // BLOCK_ENTRIES))
    # of equal sets one document goes into the matrix
    firsts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(classes.select(F.col("row").alias("doc_id")), "doc_id", "left_semi")
    matrix = _incidence(firsts, blocks, words)
    rows = saved(_rows(_shared_columns(matrix, partitions, blocks), partitions), f"{folder}/rows")
    found = components(link_rows(rows, folder))
    named = classes.join(found.withColumnRenamed("node", "row"), "row", "left").select(
        "n", "x", "y", F.coalesce("component", "row").alias("component_id"))
    return sets.join(named, ["n", "x", "y"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op2_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
