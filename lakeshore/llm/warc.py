"""WARC archives: a writer with revisit records and a splittable reader.

Writer: each record is a gzip member of its own.  Members are rows of a text sink whose
line separator is a zero byte: a member under 16 MiB ends in one (the high byte of its
size), and a larger one is followed by an empty member, which does.  The files are plain
concatenated members, and Spark's committer and file systems write them.

Reader: the text source with the gzip magic as line separator.  Each task scans its byte
range for the magic and owns what starts inside, to its end in the next range.  A candidate
counts as a member if its header, and the WARC version line within, decode; a magic inside
a member joins the parts.  Parts whose beginning lies in an earlier range are put together
by file afterwards.  Files must not be named ``.gz``, or Spark would unpack them whole.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import saved, work_folder
from lakeshore.sources.tables import read_table

MAGIC = b"\x1f\x8b\x08"
LEAST_REVISITED = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()


def _line(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c not in "\r\n" else " " for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record: the payload with its HTTP header, or for a revisit the header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_line(url or '')}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose last byte is zero; see the module's notes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISITED) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) below ``path``.

    A null page is empty.  Of equal payloads of at least ``least`` bytes the rows with the
    largest page_id are responses, the others revisit them; without any page_id all are
    responses.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    copies = (pages.where(F.octet_length("payload") >= least).groupBy("digest")
              .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first")), strict=True)
            members = [member(record(i, url, payload, first if first != i else None))[:-1] for i, url, payload, first in rows]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])

    joined = pages.join(copies, "digest", "left").select("page_id", "url", "payload", "first")
    (joined.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\0").option("compression", "none").text(path))


def parse(data: bytes) -> dict | None:
    """The fields of an unpacked record, or None if it is none."""
    head, found, block = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = block[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")

    def page(name: str) -> int | None:
        value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value.lstrip("-").isdigit() else None

    kind = fields.get("warc-type")
    if kind == "revisit":
        sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size = int(sizes[0]) if sizes else None
        digest = base64.b32decode(fields.get("warc-payload-digest", "").removeprefix("sha1:")).hex()
        payload = None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": page("warc-refers-to"), "payload": payload}


def unpack(parts: list[bytes], at: int) -> tuple[bytes | None, int]:
    """The record that begins with part ``at``, and the part after it; (None, at) if none
    does, (None, -1) if it is not complete."""
    packer, out = zlib.decompressobj(31), []
    for k in range(at, len(parts)):
        try:
            out.append(packer.decompress(MAGIC + parts[k]))
        except zlib.error:
            return None, at
        if sum(map(len, out[:2])) >= 5 and not b"".join(out[:2]).startswith(b"WARC/"):
            return None, at
        if packer.eof:
            data = b"".join(out)
            return (data, k + 1) if data.startswith(b"WARC/") else (None, at)
    return None, -1


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` and, unless
    ``payload`` is false, ``payload`` of every record below ``path``.

    A revisit's size and digest are those that it states, a response's those of the payload
    read.  What is neither a member nor part of one is skipped.
    """
    fields = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payload]
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * payload)

    def rows(records: list[dict], fragments: list[tuple]) -> pa.RecordBatch:
        n, m = len(records), len(fragments)
        columns = [pa.array([r[f] for r in records] + [None] * m, types.get(f, pa.string())) for f in fields]
        place = list(zip(*fragments, strict=True)) or [(), (), (), ()]
        columns += [pa.array([None] * n + list(x), t) for x, t in zip(place, (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[*fields, "file", "start", "place", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ranges come one after the other; the last, perhaps unfinished record is held."""
        held: list[bytes] = []
        range_, place = None, 0
        for batch in batches:
            records, fragments = [], []

            def settle(last: bool) -> None:
                nonlocal held, place
                at = 0
                while at < len(held):
                    data, after = unpack(held, at)
                    if data is not None:
                        fields_ = parse(data)
                        if fields_:
                            records.append(fields_)
                        at = after
                    elif after < 0 and not last:
                        break
                    else:
                        fragments.append((*range_, place, held[at]))
                        place += 1
                        at += 1
                held = held[at:]

            for value, file, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, start) != range_:
                    settle(True)
                    range_, place = (file, start), 0
                    if start == 0:  # what stands before a file's first magic
                        continue
                held.append(value)
                if len(held) >= 64:
                    settle(False)
            settle(False)
            yield rows(records, fragments)
        if held:
            records, fragments = [], []
            settle(True)
            yield rows(records, fragments)

    def join_parts(group: pd.DataFrame) -> pd.DataFrame:
        parts = [bytes(x) for x in group.sort_values(["start", "place"])["part"]]
        out, at = [], 0
        while at < len(parts):
            data, after = unpack(parts, at)
            if data is not None and (found := parse(data)):
                out.append(found)
            at = after if data is not None else at + 1
        return pd.DataFrame([[r[f] for f in fields] for r in out], columns=fields).astype(
            {"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    # the source hands bytes through as they are; the encoding only spells the separator
    chunks = (spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
              .select(F.col("value").cast("binary"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start")))
    found = saved(chunks.mapInArrow(run, f"{schema}, file string, start long, place long, part binary"),
                  work_folder(spark, "warc-records"))
    whole = found.where("part IS NULL").select(*fields)
    return whole.unionByName(found.where("part IS NOT NULL").groupBy("file").applyInPandas(join_parts, schema))


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    path = work_folder(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payload=False).drop("url")
