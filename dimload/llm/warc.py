"""WARC archives with an index written first and read by coalesced byte ranges.

``write_archive`` writes one record for each page into gzip-per-record WARC 1.1 files under
``<path>/archives`` and their index (file, offset, length, url, digest, ...) to the Parquet table
``<path>/index``. ``read_archive`` takes rows of an index, sorts them by file and offset, joins
neighbouring byte ranges into single reads, and parses and verifies the records found there.

Of the pages with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is
a ``response``, the others are ``revisit`` records that refer to it and hold no payload; all other
pages are responses. A null html counts as an empty payload. Rows that repeat the largest page_id of
their payload are all responses; rows without a page_id never serve as the one referred to unless
the whole group has none, and are then responses. A null url leaves the target field out. Very long
payloads are records like others, read by one task each. Other columns are not looked at. An empty
table gives an empty index and no archives.

Archives are written by the tasks through ``pyarrow.fs`` under names of their own attempt, and the
index, which Spark commits, names only files of attempts that succeeded: a lost executor's task is
run again and files of failed attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SALTS = 16
FILE_BYTES = 256 << 20
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
TASK_BYTES = 16 << 20  # of records that a task reads back
_INDEX = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str):
    """The file system and path of a URI (Spark writes local ones with a single slash)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of one record; a ValueError if its payload doesn't have its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda urn: int(urn[12:-1]) if urn[12:-1] else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if version != "WARC/1.1" or len(block) != int(fields["Content-Length"]) or not revisit and base32_sha1(payload) != digest:
        raise ValueError("a record is damaged")
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
        "html": None if revisit else payload.decode(),
    }


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and ``refers_to`` (null: a response). Only digests are grouped, and only
    groups of two or more are joined back, salted since one of them may hold a third of all rows."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("_digest", F.sha1(F.col("html").cast("binary"))).withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    groups = rows.where(F.octet_length("html") >= min_bytes).groupBy("_digest").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
    groups = groups.where("_n > 1").select("_digest", "_first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    joined = rows.join(groups, ["_digest", "_salt"], "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("refers_to"))


def _written(folder: str, date: str):
    schema = arrow_schema(_INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        out, name, offset, number = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"part-{task.partitionId():05d}-{number:03d}-{uuid.uuid4().hex[:12]}.warc.gz"
                        out, offset, number = fs.open_output_stream(f"{base}/{name}", compression=None), 0, number + 1
                    payload = html.encode()
                    digest = base32_sha1(payload)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    raw = packer.compress(record_bytes(page_id, url, payload, digest, refers_to, date)) + packer.flush()
                    out.write(raw)
                    rows.append((page_id, url, len(payload), digest, "response" if refers_to is None else "revisit", refers_to, name, offset, len(raw)))
                    offset += len(raw)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        finally:
            if out is not None:
                out.close()

    return run


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write all ``pages`` (page_id, url, html) as WARC records below ``path``, with their index."""
    index = with_revisits(pages, min_bytes).mapInArrow(_written(f"{path}/archives", date), _INDEX)
    index.write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{path}/index")


def _records(folder: str):
    schema = arrow_schema(_RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        handle, opened = None, None

        def fetch(name: str, ranges: list[tuple[int, int]]) -> list[dict]:
            nonlocal handle, opened
            if opened != name:
                if handle is not None:
                    handle.close()
                handle, opened = fs.open_input_file(f"{base}/{name}"), name
            first = ranges[0][0]
            raw = handle.read_at(max(a + n for a, n in ranges) - first, first)
            return [parse_record(zlib.decompress(raw[a - first : a - first + n], 31)) for a, n in ranges]

        def table(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        name, ranges = None, []
        for batch in batches:
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if ranges and (file != name or offset > ranges[-1][0] + ranges[-1][1] + GAP_BYTES or offset + length - ranges[0][0] > READ_BYTES):
                    yield table(fetch(name, ranges))
                    ranges = []
                name = file
                ranges.append((offset, length))
        if ranges:
            yield table(fetch(name, ranges))
        if handle is not None:
            handle.close()

    return run


def read_archive(selected: DataFrame, path: str) -> DataFrame:
    """The records that rows of an index name, read by sorted, coalesced byte ranges.

    Files are strung together and cut every ``TASK_BYTES``: tasks follow the bytes that the rows stand
    for, not the rows."""
    places = selected.select("file", "offset", "length")
    sizes = places.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("_end"))  # a row for each file
    sizes = sizes.withColumn("_base", F.sum("_end").over(Window.orderBy("file")) - F.col("_end"))
    total = sizes.agg(F.sum("_end")).head()[0] or 0
    places = places.join(sizes, "file").withColumn("_piece", F.floor((F.col("_base") + F.col("offset")) / TASK_BYTES).cast("int"))
    places = places.repartitionById(max(1, -(-total // TASK_BYTES)), F.col("_piece"))
    places = places.sortWithinPartitions("file", "offset").select("file", "offset", "length")
    return places.mapInArrow(_records(f"{path}/archives"), _RECORD)
