"""WARC archives with an index written first and coalesced byte-range reads.

``write_archives`` turns pages into WARC/1.1 records, one gzip member each, in
archive files under a shared folder, and stores an index table with file,
offset, length, URL and payload digest of every record.  ``read_records`` takes
any selection of index rows, sorts it by place, merges neighbouring ranges into
one read each, and parses the members.  Archives are only ever reached through
the index, so files left by a failed attempt of a task are never read.

Of records with equal payloads of at least ``MIN_REVISIT_BYTES`` the one with
the smallest page id is a response and the others are revisit records that
refer to it.  Only digests that occur more than once are joined to the pages.

Defined results: a null html is an empty payload; shorter payloads are always
responses; a null page id never is the one referred to, unless all ids of equal
payloads are null, in which case all are responses; rows that repeat the
smallest id of their payload are all responses; a null url leaves the header
out and reads back as null; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import materialize
from newslens.session import scratch_path

MIN_REVISIT_BYTES = 100
MAX_ARCHIVE_BYTES = 1 << 30
#: Ranges closer than this are read together, up to the size of one read.
MAX_GAP_BYTES = 1 << 16
MAX_READ_BYTES = 8 << 20
#: Readers are dealt stretches of an archive of this size.
READER_BYTES = 8 << 20

# Fixed values of the WARC/1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = ("page_id long, file string, offset long, length long, url string, "
                "payload_digest string, record_type string")
RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, "
                 "payload_bytes long, payload_digest string, payload binary")


def record(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and leaves the payload out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(urn: str | None):
    value = urn[len("<urn:page:"):-1] if urn else "None"
    return None if value == "None" else int(value)


def parse(data: bytes) -> tuple:
    """The row of ``RECORD_SCHEMA`` for one record; checks length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if version != VERSION or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size
                               or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind,
            _page(fields.get("WARC-Refers-To")), size, digest,
            payload if kind == "response" else None)


def _filesystem(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path)


def with_originals(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Pages with the digest of their payload and the page id they revisit, if any."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    equal = (rows.filter(F.octet_length("payload") >= MIN_REVISIT_BYTES)
             .groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
             .filter("n > 1 and original is not null").select("digest", "original"))
    # Written first, so the planner knows its size before it picks the join.
    equal = materialize(equal, "warc-equal")
    return rows.join(equal, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").eqNullSafe(F.col("original")), F.lit(None))
        .otherwise(F.col("original")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id",
                   url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives below ``folder`` (shared) and return the stored index."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        stream, name, size, rows = None, "", 0, []
        part = TaskContext.get().partitionId()
        try:
            for batch in batches:
                for p in batch.to_pylist():
                    if stream is None or size >= MAX_ARCHIVE_BYTES:
                        if stream is not None:
                            stream.close()
                        name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
                        stream, size = system.open_output_stream(
                            f"{base}/{name}", compression=None), 0
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = squeeze.compress(record(p["page_id"], p["url"], p["payload"],
                                                     p["digest"], p["refers_to"]))
                    member += squeeze.flush()
                    stream.write(member)
                    rows.append((p["page_id"], f"{folder}/{name}", size, len(member), p["url"],
                                 p["digest"], "response" if p["refers_to"] is None
                                 else "revisit"))
                    size += len(member)
        finally:
            if stream is not None:
                stream.close()
        # After the close: an index row is only ever given for bytes that are stored.
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64()] + [pa.string()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, types)],
            names=[f.split()[0] for f in INDEX_SCHEMA.split(", ")])

    rows = with_originals(pages, page_id, url, html)
    return materialize(rows.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def coalesce(ranges: list[tuple[int, int]], gap: int = MAX_GAP_BYTES,
             most: int = MAX_READ_BYTES) -> Iterator[list[tuple[int, int]]]:
    """Sorted (offset, length) ranges in runs to be read at once."""
    run: list[tuple[int, int]] = []
    for offset, length in ranges:
        if run and (offset - (run[-1][0] + run[-1][1]) > gap
                    or offset + length - run[0][0] > most):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def read_records(selected: DataFrame) -> DataFrame:
    """The records that the index rows ``selected`` point to."""
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(),
             pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, types)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict[str, list[tuple[int, int]]] = {}
            for r in batch.to_pylist():
                places.setdefault(r["file"], []).append((r["offset"], r["length"]))
            for file, ranges in places.items():
                system, path = _filesystem(file)
                with system.open_input_file(path) as f:
                    for run in coalesce(sorted(ranges)):
                        start = run[0][0]
                        data = f.read_at(run[-1][0] + run[-1][1] - start, start)
                        yield batch_of([parse(zlib.decompress(
                            data[o - start:o - start + n], 31)) for o, n in run])

    place = selected.select("file", "offset", "length")
    total = place.agg(F.sum("length")).first()[0] or 0
    # A fixed number: an index row is small, but what it points to is not.
    dealt = place.repartition(max(1, -(-total // READER_BYTES)), "file",
                              F.floor(F.col("offset") / READER_BYTES))
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD_SCHEMA)
