"""WARC archives: a writer, and a splittable reader of gzip-per-record files.

Writer: every record is a gzip member of its own.  The row with the smallest id
among rows of equal payloads (of ``min_bytes`` at least) is a response, the
others are revisits that refer to it and hold no payload.  A task writes its
rows to a file named by a fresh random name and reports the name only when the
file is closed; the list of reported files is written as a table by Spark, so
that files of lost or repeated attempts are in no list and are never read.

Reader: files are cut into byte ranges, one row each.  A range scans its bytes
for the gzip magic and validates a candidate by decoding the head of the member,
which must be a WARC header with the fields that every record has; bytes that
look like a magic inside compressed data fail there, or with the checksum at
the member's end.  A range owns the records that start inside it, reads the
last of them to its end beyond the range, and members after a valid one follow
each other without a scan.

Results: null payloads count as empty.  Ids are not unique necessarily: every
row gives one record; of several rows that tie on payload and smallest id each
is a response.  A null id is written as an empty id, and comes first only where
its payload has no row with an id.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspan.llm.common import file_of, shared_folder, slices, text_or_empty

MAGIC = b"\x1f\x8b\x08"
#: Bytes of one range of the reader.
RANGE_BYTES = 8 << 20
#: Bytes read from a file at a time.
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n").match
NEEDED = ("warc-type", "warc-record-id", "content-length")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _id(key) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def record(key, url: str, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One gzip member with a response or revisit record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(key)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    head += [f"WARC-Target-URI: {url}"] if url else []
    head += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    head += [f"WARC-Refers-To: {_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def plan_records(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None, min_bytes: int) -> DataFrame:
    """id, url, payload, refers_to (null: a response) of every row."""
    rows = pages.select(F.col(id_col).alias("id"), (text_or_empty(url_col) if url_col else F.lit("")).alias("url"), F.encode(text_or_empty(payload_col), "UTF-8").alias("payload"))
    key = F.unhex(F.sha1("payload")).alias("digest")
    same = rows.where(F.length("payload") >= min_bytes).groupBy(key, F.length("payload").alias("n")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("digest", "n", "first")
    met = rows.withColumns({"digest": key, "n": F.length("payload")}).join(same, ["digest", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return met.select("id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", min_bytes: int = 0) -> DataFrame:
    """Writes the archives; returns the list of files (path, bytes, records)."""
    spark = pages.sparkSession
    rows = plan_records(pages, id_col, payload_col, url_col, min_bytes)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, records = None, "", 0, 0
        for b in slices(batches, 64):
            if out is None:
                store, top = file_of(folder)
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(f"{top}/{path.rsplit('/', 1)[1]}", compression=None)
            for key, url, payload, first in zip(*(c.to_pylist() for c in b.columns)):
                data = record(key, url, payload, first, first is not None)
                out.write(data)
                size, records = size + len(data), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})

    listed = f"{folder}/files"
    rows.mapInArrow(archive, "path string, bytes long, records long").write.parquet(listed)
    return spark.read.parquet(listed)


class _File:
    """Bytes of a file by position, with the last chunks at hand."""

    def __init__(self, path: str):
        store, inside = file_of(path)
        self.file = store.open_input_file(inside)
        self.size, self.at, self.data = self.file.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.data)):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(max(n, CHUNK))
        return self.data[at - self.at: at - self.at + n]


def _headers(block: bytes) -> dict[str, str] | None:
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/\d+\.\d+", lines[0]):
        return None
    found = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))
    return found if all(k in found for k in NEEDED) and found["content-length"].isdigit() else None


def _member(file: _File, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header fields, block and end of the WARC record in the gzip member at
    ``at``; None if there is none.  The version line is judged as soon as it is decoded,
    the head, however long, before the rest."""
    unpack, data, fields, start, end, seen = zlib.decompressobj(31), bytearray(), None, 0, at, 0
    try:
        while not unpack.eof:
            piece = file.get(end, min(1 << 16, file.size - end))
            if not piece:
                return None
            data += unpack.decompress(piece)
            end += len(piece) - len(unpack.unused_data)
            if fields is None:
                if data[:5] != b"WARC/"[: len(data[:5])] or len(data) >= 32 and not VERSION(data):
                    return None
                if (cut := data.find(b"\r\n\r\n", max(0, seen - 3))) >= 0:
                    fields, start = _headers(bytes(data[:cut])), cut + 4
                    if fields is None:
                        return None
                seen = len(data)
    except zlib.error:
        return None
    if fields is None or len(data) - start < int(fields["content-length"]):
        return None
    return fields, bytes(data[start: start + int(fields["content-length"])]), end


def records_in(path: str, start: int, stop: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records that start in [start, stop) of a file."""
    file, at = _File(path), start
    while at < min(stop, file.size):
        if found := _member(file, at) if file.get(at, 3) == MAGIC else None:
            yield found[0], found[1]
            at = found[2]
            continue
        at += 1  # no member begins here: on to the next magic
        while at < min(stop, file.size):
            piece = file.get(at, min(CHUNK, file.size - at, stop - at + 2))
            if (hit := piece.find(MAGIC)) >= 0:
                at += hit
                break
            at += max(1, len(piece) - 2)


def read(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, type, record_id, refers_to, digest, block of every record in ``files`` (path, bytes)."""
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.withColumn("stop", F.col("start") + range_bytes)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "type", "record_id", "refers_to", "digest", "block"]
        for b in batches:
            for path, start, stop in zip(*(c.to_pylist() for c in b.columns)):
                rows, size = [], 0
                for f, block in records_in(path, start, stop):
                    rows.append((path, f["warc-type"], f["warc-record-id"], f.get("warc-refers-to"), f.get("warc-payload-digest"), block))
                    size += len(block)
                    if size > 4 << 20:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return ranges.repartition(parts, "path", "start").mapInArrow(scan, "path string, type string, record_id string, refers_to string, digest string, block binary")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def payloads(records: DataFrame, id_type: str = "long") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of response and
    revisit records.  Digest and length of a response come from its payload, and
    must agree with its header; a revisit states those of the response."""

    def name(c: str):
        return F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(id_type)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            kinds, ids, refers, digests, blocks = (b.column(i).to_pylist() for i in range(5))
            sizes, found = [], []
            for kind, digest, block in zip(kinds, digests, blocks):
                head, _, body = block.partition(b"\r\n\r\n")
                said = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)[1])
                digest = digest.rpartition(":")[2]
                if kind == "response" and (len(body) != said or digest_of(body) != digest):
                    raise ValueError("a response's payload differs from its header")
                sizes.append(said)
                found.append(digest)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.string()), b.column(0), b.column(2)], names=["id", "payload_bytes", "payload_digest", "record_type", "refers"])

    got = records.select("type", "record_id", "refers_to", "digest", "block").where("type IN ('response', 'revisit')")
    got = got.mapInArrow(judge, "id string, payload_bytes long, payload_digest string, record_type string, refers string")
    return got.select(name("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", name("refers").alias("refers_to"))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives in the shared folder and reads them back."""
    files = write(pages, f"{shared_folder(pages.sparkSession)}/warc", min_bytes=min_bytes)
    return payloads(read(pages.sparkSession, files), pages.schema["page_id"].dataType.simpleString())
