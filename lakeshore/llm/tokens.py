"""Token counts by offset-mapped attribution, over any byte-level BPE vocabulary.

A document is encoded once, whole.  Each token's character span is then joined to the
spans of the document's sections, and a token that crosses a boundary goes to one section
by an explicit rule.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from lakeshore.sources.tables import read_table

#: White space besides blank and line feed.
_RARE_SPACE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, of a ``.tiktoken`` file or of a byte-level ``.json`` one
    whose ids follow its merges; added (special) tokens are left out."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"] for t in spec.get("added_tokens", ())}
    byte = _byte_of_symbol()
    return {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def added_tokens(path: str) -> dict[str, int]:
    """The added (special) tokens of a ``.json`` file and their ids; other files have none."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file).get("added_tokens", ())}


class Encoder:
    """Ids and byte lengths of tokens; strings of special tokens are ordinary text, or, with
    ``added``, those of the file's added tokens are these tokens, as in the library's plain call.

    The look-ahead of the pattern only matters where white space stands in runs; other
    texts, which are most, are split by the same pattern without it, which is faster.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, added: bool = False):
        ranks = load_ranks(path)
        special = added_tokens(path) if added else {}
        self._special = set(special)
        self._full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        plain = pattern.replace(r"|\s+(?!\S)", "")
        self._plain = tiktoken.Encoding("plain", pat_str=plain, mergeable_ranks=ranks, special_tokens=special)
        sized = ranks | {content.encode(): i for content, i in special.items()}
        self.sizes = np.zeros(max(sized.values()) + 1, np.int64)
        for token, rank in sized.items():
            self.sizes[rank] = len(token)

    def encode(self, text: str) -> np.ndarray:
        runs = ("  " in text or "\n\n" in text or "\n " in text or " \n" in text or _RARE_SPACE.search(text))
        return (self._full if runs else self._plain).encode_to_numpy(text, allowed_special=self._special, disallowed_special=())


@lru_cache(maxsize=4)
def encoder(path: str, added: bool = False) -> Encoder:
    """One encoder per process, vocabulary and reading of added tokens."""
    return Encoder(path, added=added)


def token_spans(text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of tokens of ``sizes`` bytes.  A token that holds part of a
    character's bytes spans that character."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if text.isascii():
        return starts, ends
    seen = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return seen[starts] - 1, seen[ends - 1]


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of the lines of a text; a line feed belongs to the line it ends."""
    sizes = [len(x) + 1 for x in text.split("\n")]
    sizes[-1] -= 1
    if not sizes[-1] and len(sizes) > 1:
        sizes.pop()
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def attribute(starts, ends, section_starts, section_ends, rule: str = "most"):
    """The section of every token (-1: none), and whether the token reaches past it.

    Spans are half open, in order; sections do not overlap.  ``rule``: a token that touches
    several sections goes to the one that holds most of its characters, the earlier one of
    equals ("most"), or to the first that it touches ("first").
    """
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_starts, ends, "left") - 1
    owner = np.where(first <= last, first, -1)
    crossing = first < last
    if rule == "most":
        for t in np.flatnonzero(crossing):
            k = slice(first[t], last[t] + 1)
            owner[t] = first[t] + np.argmax(np.minimum(section_ends[k], ends[t]) - np.maximum(section_starts[k], starts[t]))
    elif rule != "first":
        raise ValueError(f"unknown rule {rule!r}")
    partly = (owner >= 0) & ((starts < section_starts[owner]) | (ends > section_ends[owner]))
    return owner, crossing | partly


def section_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                   sections=line_spans, rule: str = "most") -> DataFrame:
    """Tokens of every section of every text: ``key, section, start, end, n_tokens,
    n_crossing``; spans are in characters, sections count from 0.

    ``sections`` maps a text to its spans.  A null or empty text has one empty section.
    Repeated rows give repeated results; other columns of ``docs`` are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            sizes, columns = [], [[], [], [], []]
            for value in batch.column(1).to_pylist():
                value = value or ""
                starts, ends = sections(value)
                tokens = enc.sizes[enc.encode(value)]
                owner, crossing = attribute(*token_spans(value.encode(), tokens), starts, ends, rule)
                sizes.append(len(starts))
                counts = np.bincount(owner[owner >= 0], minlength=len(starts))
                crossed = np.bincount(owner[crossing & (owner >= 0)], minlength=len(starts))
                for column, x in zip(columns, (starts, ends, counts, crossed), strict=True):
                    column.append(x)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            numbers = [pa.array(np.concatenate(c) if c else np.zeros(0), pa.int64()) for c in columns]
            section = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(section, pa.int32()), *numbers],
                names=["key", "section", "start", "end", "n_tokens", "n_crossing"])

    out = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        run, f"key {kind}, section int, start long, end long, n_tokens long, n_crossing long")
    return out.withColumnRenamed("key", key)


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return section_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
