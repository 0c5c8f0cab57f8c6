"""WARC archives by index: write records and an index of their places, then read chosen records by coalesced byte ranges.

Each task writes its pages into archives of bounded size in the shared folder, one gzip member for each record, and
yields an index row for each: file, offset, length, url and digest. The index, written as a table, is what counts: a
task that runs again writes new files, and files that no index row names are never read. Reading sorts the wanted rows
by file and offset, joins near ranges into one read and cuts the records out of it; its tasks follow the bytes to read.

Cases: a null html is an empty payload; a null url gives no target header; payloads under `least` bytes are always
responses; of equal larger payloads the rows with the smallest page_id are responses and the others revisit it; rows
with a null page_id are responses; a page_id may stand on several rows, each is a record of its own payload; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsieve.llm.tables import cut, shared_folder

ARCHIVE_BYTES, GAP, READ_BYTES, TASK_BYTES = 16 << 20, 64 << 10, 4 << 20, 32 << 20
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
INDEX = "page_id long, url string, file string, offset long, length long, record_type string, refers_to long, payload_digest string, payload_bytes long"


def record(page_id, url, payload: bytes, refers_to, date: str) -> tuple[bytes, str]:
    """A WARC/1.1 record and its payload's SHA-256."""
    name = lambda i: f"<urn:uuid:{uuid.uuid5(NAMES, str(i))}>"
    digest = hashlib.sha256(payload).hexdigest()
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}", f"Page-Refers-To: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}", f"Page-ID: {'' if page_id is None else page_id}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers and its payload (of a revisit: none)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def first_of(pages: DataFrame) -> DataFrame:
    """(digest, first): the smallest page_id of each digest that several rows have."""
    return cut(pages.where("digest IS NOT NULL").groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))


def write(pages: DataFrame, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every row as a record; returns the index as a table of the shared folder."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, at = None, "", 0
        for b in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                payload = (html or "").encode()
                data, digest = record(page_id, url, payload, refers_to, date)
                pack = zlib.compressobj(1, wbits=31)
                data = pack.compress(data) + pack.flush()
                if out is None or at + len(data) > ARCHIVE_BYTES and at:
                    if out is not None:
                        out.close()
                    path, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                out.write(data)
                rows.append((page_id, url, path, at, len(data), "response" if refers_to is None else "revisit", refers_to, digest, len(payload)))
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 9, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["page_id", "url", "file", "offset", "length", "record_type", "refers_to", "payload_digest", "payload_bytes"])
        if out is not None:
            out.close()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    large = (F.octet_length("html") >= least) & F.col("page_id").isNotNull()
    rows = rows.withColumn("digest", F.when(large, F.sha2("html", 256)))
    # Rows that can't revisit get keys of their own, so that no key but a payload's holds many rows; adaptive execution splits those.
    key = F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64("page_id", "url", "html").cast("string")))
    first = first_of(rows).withColumnRenamed("digest", "key")
    rows = rows.withColumn("key", key).join(first, "key", "left").select("page_id", "url", "html", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))
    return cut(rows.mapInArrow(run, INDEX)).withColumn("folder", F.lit(folder))


def read(index: DataFrame) -> DataFrame:
    """The records of the index rows: (page_id, url, record_type, refers_to, payload, payload_digest, payload_bytes), from the archives; a revisit's payload is null and its digest and size are the full payload's."""

    def run(batches):
        store = None
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            k = 0
            while k < len(rows):
                folder, file, start, _ = rows[k]
                last, end = k, start
                while last < len(rows) and rows[last][1] == file and rows[last][2] - end <= GAP and (last == k or rows[last][2] + rows[last][3] - start <= READ_BYTES):
                    end = rows[last][2] + rows[last][3]
                    last += 1
                store = store or fs.FileSystem.from_uri(folder)[0]
                with store.open_input_file(file) as f:
                    data = f.read_at(end - start, start)
                out = []
                for _, _, offset, length in rows[k:last]:
                    fields, payload = parse(zlib.decompress(data[offset - start : offset - start + length], wbits=31))
                    kind = fields["WARC-Type"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(fields["Payload-Length"])):
                        raise ValueError(f"{file} at {offset}: the payload is not the one that was written")
                    page, refers = fields.get("Page-ID", ""), fields.get("Page-Refers-To")
                    out.append((int(page) if page else None, fields.get("WARC-Target-URI"), kind, int(refers) if refers else None, payload.decode() if kind == "response" else None, digest, int(fields["Payload-Length"])))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], ["page_id", "url", "record_type", "refers_to", "payload", "payload_digest", "payload_bytes"])
                k = last

    size = index.agg(F.sum("length")).first()[0] or 0
    parts = max(index.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    places = index.select("folder", "file", "offset", "length").repartition(parts, "file", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("file", "offset")
    return places.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload string, payload_digest string, payload_bytes long")
