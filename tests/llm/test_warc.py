import base64
import glob
import gzip
import hashlib
import os
import random
import zlib

from lakeshore.llm import warc
from lakeshore.llm.warc import MAGIC, op8_warc, read_archives, record, unpack, write_archives
from tests.conftest import SF01

SCHEMA = "page_id long, url string, html string, digest string"


def pages():
    rng = random.Random(2)
    copy = "copied é payload " * 80
    rows = [(i, f"http://h/{i}", "".join(chr(rng.randrange(32, 1200)) for _ in range(rng.randrange(0, 4000))), "clash") for i in range(120)]
    rows += [(200 + i, None, copy, None) for i in range(5)] + [(300, "u\r\nx: y", None, None), (301, "", "", None), (302, "a", "short", None),
                                                             (303, "b", "short", None), (None, "no id", copy, None), (204, None, copy, None)]
    return rows


def expected(rows):
    out = []
    for page_id, _, text, *_ in rows:
        payload = (text or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == payload and r[0] is not None]
        first = max(same, default=None) if len(payload) >= 1000 else page_id
        refers = first if first != page_id else None
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=str)


def test_round_trip_over_small_ranges(spark, scratch):
    rows = pages()
    write_archives(spark.createDataFrame(rows, SCHEMA), f"{scratch}/w")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("500", "7001", "128m"):  # a range may hold no beginning of a record
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            out = read_archives(spark, f"{scratch}/w")
            assert found(out) == expected(rows), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    texts = {r.page_id: r.payload for r in out.collect() if r.record_type == "response"}
    assert all(texts[i] == (t or "").encode() for i, _, t, _ in rows if i in texts)
    # every file is plain concatenated gzip members
    assert sum(gzip.decompress(open(f, "rb").read()).count(b"WARC/1.1\r\n") for f in glob.glob(f"{scratch}/w/part-*")) == len(rows)


def stored(data):
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def test_magic_inside_a_member_is_no_beginning(spark, scratch):
    rng = random.Random(4)
    payloads = [b"".join(rng.choice([MAGIC, MAGIC + b"\0" * 7, b"plain ", os.urandom(9), gzip.compress(b"WARC")]) for _ in range(200)) for _ in range(30)]
    os.makedirs(f"{scratch}/w")
    with open(f"{scratch}/w/part-0.txt", "wb") as out:
        for i, p in enumerate(payloads):
            out.write(stored(record(i, "u", p, None)))
    want = sorted((i, len(p), hashlib.sha1(p).hexdigest(), "response", None) for i, p in enumerate(payloads))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("300", "2048", "50000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert found(read_archives(spark, f"{scratch}/w", payload=False)) == sorted(want, key=str), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_large_members_still_end_in_zero():
    data = os.urandom(1 << 20) * 17
    out = warc.member(data)
    assert out[-1] == 0 and gzip.decompress(out) == data
    parts = out.split(MAGIC)[1:]
    assert unpack([zlib.compress(b"no member")], 0) == (None, 0) and len(parts) >= 2


def test_headers_follow_the_format():
    head = record(7, "http://h/\r\nX: 1", b"p" * 1000, 9).partition(b"\r\n\r\n")[0].decode().split("\r\n")
    assert head[0] == "WARC/1.1" and "WARC-Refers-To: <urn:page:9>" in head and "WARC-Type: revisit" in head
    assert f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(b'p' * 1000).digest()).decode()}" in head
    assert not any(x.startswith("X:") for x in head)


def test_empty_table_and_query(spark, scratch):
    write_archives(spark.createDataFrame([], SCHEMA), f"{scratch}/none")
    assert read_archives(spark, f"{scratch}/none").count() == 0
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()]
    assert found(op8_warc(spark, SF01)) == expected(rows)
