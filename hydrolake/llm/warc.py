"""WARC archives: write with an index first, then read selected records by coalesced byte ranges.

Each write task streams its rows into archive files in a shared folder and returns one index row per record (file,
offset, length, URL, digest). Reading sorts the selected index rows by file and offset, joins neighbours into one
range request, and parses the records of each range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.llm.common import fresh_path, materialize

INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, record_type string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(said: str | None) -> int | None:
    number = (said or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def make_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> tuple[bytes, str]:
    """One WARC/1.1 record and its payload digest. A revisit has no payload, but its digest and size."""
    digest = digest_of(payload)
    block = HTTP if revisit else HTTP + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse_record(raw: bytes) -> tuple:
    """RECORDS of one record; its payload must have the digest and size that its head says."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    digest, n = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != n or digest_of(payload) != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} differs from its digest")
    return page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), n, digest, fields["WARC-Type"], page_of(fields.get("WARC-Refers-To"))


def repeated_payloads(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(digest, size, first): payloads of at least ``least_bytes`` that more than one page has, and the smallest page_id."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    sizes = pages.select("page_id", F.sha1(payload).alias("_sha"), F.octet_length(payload).alias("_size")).where(F.col("_size") >= least_bytes)
    groups = sizes.groupBy("_sha", "_size").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    return groups.where("_n > 1").select("_sha", "_size", "_first")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = 256 << 20) -> DataFrame:
    """Write a record per page to gzipped-by-record archives in ``folder``; return the INDEX table.

    Of equal payloads of at least ``least_bytes``, the record of the smallest page_id is response and others revisit it
    (rows that repeat that page_id are response too; with null page_ids only, all are). Null html counts as empty;
    page_id must be an integer or null. Archive names
    are unique for each attempt of a task, and the index, written as a table, names those of the attempts that
    count, so lost executors and repeated tasks do no harm. Payloads aren't shuffled unless the table of repeated
    ones is too large for Spark to broadcast.
    """
    again = materialize(repeated_payloads(pages, least_bytes), "repeats")
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"_s": F.sha1("payload"), "_b": F.octet_length("payload")})
    rows = rows.join(again, (F.col("_s") == F.col("_sha")) & (F.col("_b") == F.col("_size")), "left").select("page_id", "url", "payload", F.col("_first").cast("long").alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, first in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    revisit = first is not None and page_id != first
                    raw, digest = make_record(page_id, url, payload, first, revisit)
                    packed = gzip.compress(raw, compresslevel=1, mtime=0)
                    out.write(packed)
                    rows.append((page_id, url, name, at, len(packed), digest, "revisit" if revisit else "response"))
                    at += len(packed)
                cols = list(zip(*rows, strict=True)) if rows else [()] * 7
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["page_id", "url", "file", "offset", "length", "payload_digest", "record_type"])
        finally:
            if out is not None:
                out.close()

    return materialize(rows.mapInArrow(run, INDEX), "warc-index")


def join_ranges(wanted: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) to (start, end, members): neighbours at most ``gap`` bytes apart share a read of ``most`` bytes."""
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for offset, length in wanted:
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= most:
            start, end, own = out[-1]
            own.append((offset, length))
            out[-1] = (start, max(end, offset + length), own)
        else:
            out.append((offset, offset + length, [(offset, length)]))
    return out


def read_records(index: DataFrame, folder: str, gap: int = 64 << 10, most: int = 8 << 20, task_bytes: int = 8 << 20) -> DataFrame:
    """RECORDS of the records in ``index`` (any selection of its rows).

    Index rows are dealt by file and stretch of ``most`` bytes and sorted by offset, so a task reads a few joined ranges
    in order. There is a task for each ``task_bytes`` (gzipped) to read: the index itself is far too small to tell.
    An empty index gives no rows; rows listed twice are read twice.
    """
    to_read = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-to_read // task_bytes))
    dealt = (
        index.select("file", "offset", "length")
        .repartition(tasks, "file", (F.col("offset") / most).cast("long"))
        .sortWithinPartitions("file", "offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                by_file.setdefault(name, []).append((offset, length))
            for name, wanted in by_file.items():
                with store.open_input_file(f"{path}/{name}") as f:
                    for start, end, own in join_ranges(wanted, gap, most):
                        raw = f.read_at(end - start, start)
                        rows = [parse_record(zlib.decompress(raw[o - start : o - start + n], 31)) for o, n in own]
                        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                            names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                        )

    return dealt.mapInArrow(run, RECORDS)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, then read all records back by the index."""
    folder = fresh_path(spark, "warc")
    return read_records(write_archives(pages, folder), folder).drop("url")
