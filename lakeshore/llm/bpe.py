"""Byte-level BPE encoding and decoding by a two-tier lookup.

A text is split into pre-tokens.  The first tier is a minimal perfect hash over the
vocabulary: a pre-token that is a token is resolved by one probe.  The others are merged
over a linked list of byte spans, the next merge taken from a heap of ranked pairs.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame

from lakeshore.llm.common import ranges
from lakeshore.llm.tokens import _RARE_SPACE, load_ranks
from lakeshore.sources.tables import read_table

_MASK = (1 << 64) - 1
#: Texts are encoded in blocks of about so many characters; distinct words kept per process.
BLOCK_CHARS = 4_000_000
MEMO_WORDS = 400_000


class PerfectHash:
    """Minimal perfect hash by displacement: keys fall into buckets; the largest bucket
    first, each gets the first displacement that sends all its keys to free places.  Every
    place holds one key, against which a probe is compared."""

    def __init__(self, keys: list[bytes]):
        self.size = max(1, len(keys))
        self.buckets = max(1, len(keys) // 2)
        self.displacements = np.zeros(self.buckets, np.int64)
        self.keys: list[bytes | None] = [None] * self.size
        grouped: dict[int, list[tuple[int, bytes]]] = {}
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key)
            grouped.setdefault(h % self.buckets, []).append((h, key))
        singles = []
        for bucket, members in sorted(grouped.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                singles.append((bucket, members[0][1]))
                continue
            d = 1
            while True:
                at = [self._place(h, d) for h, _ in members]
                if len(set(at)) == len(at) and all(self.keys[a] is None for a in at):
                    break
                d += 1
            self.displacements[bucket] = d
            for a, (_, key) in zip(at, members, strict=True):
                self.keys[a] = key
        free = [i for i, key in enumerate(self.keys) if key is None]
        for (bucket, key), place in zip(singles, free, strict=False):  # a lone key is sent to a free place as such
            self.displacements[bucket] = -1 - place
            self.keys[place] = key

    def _place(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) & _MASK
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _MASK
        return (x ^ (x >> 32)) % self.size

    def find(self, key: bytes) -> int:
        """The key's place, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = int(self.displacements[h % self.buckets])
        place = -1 - d if d < 0 else self._place(h, d)
        return place if self.keys[place] == key else -1


def _slices(values: pa.LargeBinaryArray, ends: np.ndarray) -> list[memoryview]:
    """The values between consecutive ends, joined: they stand one after the other."""
    if values.null_count:
        raise KeyError("an id without a token")
    _, offsets, data = values.buffers()
    places = np.frombuffer(offsets, np.int64)[np.concatenate([[0], ends])].tolist()
    joined = memoryview(data if data is not None else b"")
    return [joined[a:b] for a, b in zip(places, places[1:])]


class Codec:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.hash = PerfectHash(list(ranks))
        self.id_at = [ranks.get(key, -1) for key in self.hash.keys]
        self.token = {i: token for token, i in ranks.items()}
        known = range(max(self.token, default=-1) + 1)
        self._tokens = pa.array([self.token.get(i) for i in known], pa.large_binary())
        self._decimals = pa.array([b"%d," % i for i in known], pa.large_binary())
        self._memo: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Merges of one pre-token: the pair of lowest rank, the leftmost of equals, first."""
        ranks = self.ranks
        n = len(piece)
        after = list(range(1, n + 1))  # of each span's start: the next span's start
        before = list(range(-1, n))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i: i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i]:
                continue
            j = after[i]
            if j >= n or after[j] != end:  # one of the two has been merged meanwhile
                continue
            alive[j] = False
            after[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i: after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h: end])) is not None:
                heapq.heappush(heap, (r, h, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i: after[i]]])
            i = after[i]
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        place = self.hash.find(piece)
        return [self.id_at[place]] if place >= 0 else self.merge(piece)

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def decode_block(self, ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        """The bytes of every text of a block, given all ids and where each text's end."""
        return _slices(self._tokens.take(pa.array(ids)), ends)

    def decimal_block(self, ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        """The decimal ids of every text of a block, joined by commas."""
        return [text[:-1] for text in _slices(self._decimals.take(pa.array(ids)), ends)]

    def _word(self, word: str) -> bytes:
        ids = self._memo.get(word)
        if ids is None:
            if len(self._memo) >= MEMO_WORDS:
                self._memo.clear()
            ids = self._memo[word] = np.array(self.encode(word), "<u4").tobytes()
        return ids

    def encode_block(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text.  Where white space stands alone, a blank always begins a
        pre-token, so the words between blanks are looked up once a block; texts with runs
        of white space are split whole."""
        plain = [not ("  " in t or "\n\n" in t or "\n " in t or " \n" in t or t[:1] == " " or t[-1:] == " "
                      or _RARE_SPACE.search(t)) for t in texts]
        words = pc.split_pattern(pa.array([t for t, p in zip(texts, plain, strict=True) if p], pa.large_string()), " ")
        offsets = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = coded.dictionary.to_pylist()
        entries = [self._word(" " + w) for w in distinct]
        heads = {}  # a text's first word has no blank before it
        for at in offsets[:-1]:
            k = index[at]
            if k not in heads:
                heads[k] = len(entries)
                entries.append(self._word(distinct[k]))
            index[at] = heads[k]
        lengths = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(entries), "<u4")
        ids = flat[ranges(starts[index], lengths[index])]
        ends = np.concatenate([[0], np.cumsum(lengths[index])])[offsets]
        done = iter(np.split(ids, ends[1:-1]) if len(offsets) > 1 else [])
        return [next(done) if p else np.array(self.encode(t), "<u4") for t, p in zip(texts, plain, strict=True)]


@lru_cache(maxsize=4)
def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> Codec:
    """One codec per process and vocabulary."""
    return Codec(load_ranks(path), pattern)


def blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together; a longer one stands alone."""
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def encode_column(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` and, unless ``ids`` is false, ``ids``.

    A null text is empty and has no ids; repeated rows give repeated results.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            counts, encoded, decoded, lists = [], [], [], []
            for block in blocks([t or "" for t in batch.column(1).to_pylist()]):
                found = coder.encode_block(block)
                lengths = list(map(len, found))
                together, ends = np.concatenate(found), np.cumsum(lengths)
                counts += lengths
                encoded += [hashlib.sha256(text).hexdigest() for text in coder.decimal_block(together, ends)]
                decoded += [hashlib.sha256(text).hexdigest() for text in coder.decode_block(together, ends)]
                if ids:
                    lists += [numbers.tolist() for numbers in found]
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
            if ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids]
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def op9_byte_level_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoded bytes."""
    docs = read_table(spark, sf_dir, "documents")
    return encode_column(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ids=False)
