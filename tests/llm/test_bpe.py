import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lakeshore.llm.bpe import Codec, PerfectHash, codec, encode_column, op9_byte_level_bpe
from lakeshore.llm.tokens import load_ranks
from tests.conftest import SF001

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", " ", "a", "  a  b ", "don't\n\n  x\t y ", "日本語 テスト  ", "x" * 5000, " lead", "trail ", "é ½ ² Ⅷ ok", "a\n", "🎉🎉<|endoftext|> b", "\x1c a\x85 b"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def test_perfect_hash_is_minimal_and_perfect():
    keys = [f"k{i}".encode() for i in range(5000)]
    table = PerfectHash(keys)
    assert sorted(table.find(k) for k in keys) == list(range(len(keys)))
    assert all(table.find(f"no{i}".encode()) == -1 for i in range(2000))
    assert PerfectHash([]).find(b"x") == -1


def test_ids_equal_the_library_and_decode(reference):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(" \n\taÀb1½'ts.!,é日🎉 \xa0\x1d_") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += [" ".join("".join(rng.choice("abcdeést") for _ in range(rng.randint(1, 14))) for _ in range(50)) for _ in range(30)]
    coder = codec(PATH)
    for text, ids in zip(texts, coder.encode_block(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text) == coder.encode(text), text
        assert coder.decode(ids.tolist()) == text.encode()


def test_heap_merges_equal_repeated_scans():
    rng = random.Random(3)
    ranks = {bytes([b]): i for i, b in enumerate(b"abc")}
    while len(ranks) < 60:
        a, b = rng.choice(list(ranks)), rng.choice(list(ranks))
        ranks.setdefault(a + b, len(ranks))
    coder = Codec(ranks, r".+")
    for _ in range(500):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30)))
        parts = [piece[i: i + 1] for i in range(len(piece))]
        while True:
            best = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks), default=None)
            if best is None:
                break
            i = best[1]
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
        assert coder.merge(piece) == [ranks[p] for p in parts]


def test_rows(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate([None, *TEXTS])] + [(2, TEXTS[1], None), (None, "x y", None)]
    got = encode_column(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH).collect()
    assert len(got) == len(rows)
    texts = dict((r[0], r[1]) for r in rows)
    for r in got:
        assert r.ids == reference.encode_ordinary(texts[r.doc_id] or "") and r.n_tokens == len(r.ids)
    assert encode_column(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query(spark, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in op9_byte_level_bpe(spark, SF001).collect():
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_a_block_is_digested_from_joined_bytes():
    coder = codec(PATH)
    for texts in ([""], ["", ""], ["", *TEXTS, ""]):
        found = coder.encode_block(texts)
        together, ends = np.concatenate(found), np.cumsum([len(ids) for ids in found])
        assert [bytes(b) for b in coder.decode_block(together, ends)] == [t.encode() for t in texts]
        assert [bytes(b) for b in coder.decimal_block(together, ends)] == [",".join(map(str, ids.tolist())).encode() for ids in found]
    small = Codec({b"a": 0, b"b": 2}, ".")
    with pytest.raises(KeyError):
        small.decode_block(np.array([0, 1], "<u4"), np.array([2]))
