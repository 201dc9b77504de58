"""WARC archives: an index of records comes first, reads are coalesced byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import stored
from tiffin.session import scratch_dir

ARCHIVE_BYTES = 1 << 30  # an archive is closed at this size
GAP_BYTES = 1 << 16  # selected records no further apart are read together
READ_BYTES = 1 << 23  # a joint read ends here, one longer record aside
BATCH_RECORDS = 500
MIN_REVISIT_BYTES = 0

INDEX = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
     ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)
INDEX_DDL = (
    "page_id long, url string, record_type string, payload_digest string, refers_to long, archive string, "
    "offset long, length long"
)
RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
     ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)
RECORD_DDL = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "payload binary"
)
DATE = "1970-01-01T00:00:00Z"  # the pages have no capture time


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, revisit: bool
) -> bytes:
    """One record as a gzip member; a revisit holds the headers of the reply without its payload."""
    reply = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = reply if revisit else reply + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=-._~"))
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(refers_to)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=4, mtime=0)


def parse_record(data: bytes) -> tuple:
    """(page_id, record_type, digest, payload_bytes, refers_to, payload) of one record; a bad one raises."""
    text = gzip.decompress(data)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} is torn")
    reply, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in reply.decode().split("\r\n")[1:])["Content-Length"])
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    refers = _page_id(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return _page_id(fields["WARC-Record-ID"]), kind, digest, size, refers, payload if kind == "response" else None


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with refers_to: the page that holds the same payload, null for responses.

    Payloads are compared by SHA-256 and length; counting is combined in the
    tasks first, so a payload of a third of all pages costs one row per task.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "same", F.sha2(payload, 256)
    )
    holders = stored(
        hashed.filter(F.octet_length("html") >= min_bytes)
        .groupBy("same")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .filter("n > 1 and holder is not null"),
        "warc-holders",
    ).select("same", "holder")
    return hashed.join(holders, "same", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html, refers_to) below ``folder``; returns the index.

    Every task writes archives of its own, with names no other attempt uses, and
    reports offset, length, url and digest of each record. The index is written
    as a table; what it does not name (a lost task's archive) is not there.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_RECORDS):
                rows = []
                for row in batch.slice(start, BATCH_RECORDS).to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    payload = row["html"].encode()
                    digest = base32_sha1(payload)
                    revisit = row["refers_to"] is not None
                    data = record_bytes(
                        row["page_id"], row["url"], payload, digest, len(payload), row["refers_to"], revisit
                    )
                    out.write(data)
                    kind = "revisit" if revisit else "response"
                    rows.append((row["page_id"], row["url"], kind, digest, row["refers_to"], name, at, len(data)))
                    at += len(data)
                yield _batch(rows, INDEX)
        if out is not None:
            out.close()

    _make_folder(pages.sparkSession, folder)
    return stored(pages.select("page_id", "url", "html", "refers_to").mapInArrow(write, INDEX_DDL), "warc-index")


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name, read back and checked against their digests.

    The rows are put in the order of archive and offset; in a task, neighbours
    with small gaps are read as one byte range.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        handles: dict[str, object] = {}
        for batch in batches:
            for run in _runs(batch.to_pylist()):
                name, first = run[0]["archive"], run[0]["offset"]
                if name not in handles:
                    for old in handles.values():
                        old.close()
                    handles = {name: store.open_input_file(f"{base}/{name}")}
                handles[name].seek(first)
                data = handles[name].read(run[-1]["offset"] + run[-1]["length"] - first)
                rows = []
                for entry in run:
                    at = entry["offset"] - first
                    page_id, kind, digest, size, refers, payload = parse_record(data[at : at + entry["length"]])
                    if (page_id, kind, digest) != (entry["page_id"], entry["record_type"], entry["payload_digest"]):
                        raise ValueError(f"{name} at {entry['offset']} is not what the index says")
                    rows.append(
                        (page_id, entry["url"], kind, digest, size, refers, payload if with_payload else None)
                    )
                yield _batch(rows, RECORD)
        for old in handles.values():
            old.close()

    order = ["archive", "offset"]
    return index.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(read, RECORD_DDL)


def _runs(entries: list[dict]) -> Iterator[list[dict]]:
    """Sorted index rows cut into ranges to be read at once."""
    run: list[dict] = []
    for entry in entries:
        if run:
            end = run[-1]["offset"] + run[-1]["length"]
            near = entry["archive"] == run[0]["archive"] and 0 <= entry["offset"] - end <= GAP_BYTES
            if not near or entry["offset"] + entry["length"] - run[0]["offset"] > READ_BYTES:
                yield run
                run = []
        run.append(entry)
    if run:
        yield run


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, folder: str | None = None) -> DataFrame:
    """Write every page as a WARC record and read all records back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, url,
    one row per input row, from the bytes of the archives. Of equal payloads of
    at least ``min_bytes`` the largest page_id is the response, the others
    revisit it. A missing html is empty; a missing url leaves its header out; a
    missing page_id is smaller than any other, and payloads that only such pages
    have are responses; rows repeated under the largest id are all responses. An
    empty table gives no rows; other columns are ignored.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    index = write_archives(with_revisits(pages, min_bytes), folder)
    return read_records(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
