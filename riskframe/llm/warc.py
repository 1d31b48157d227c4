"""WARC archives of web pages: an index first, then coalesced byte-range reads.

Writing gives every record's file, offset, length, URL and digest as rows of an index. Reading takes index rows,
sorts them by place, merges ranges that lie close together into single reads, and cuts the records out of those.
Records are gzip members of their own, so any range of whole records can be read alone. A payload that equals
another page's is written once; the other records revisit it.

A task writes files under names of its own attempt, and only the index rows of the attempt that Spark commits are
kept, so a task that is run again leaves at most files that no index row names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import new_path, salted_join, stored

# Shorter payloads are written in full each time.
REVISIT_BYTES = 1000
FILE_BYTES = 1 << 30
# A read spans gaps up to GAP and ends beyond RANGE bytes.
GAP = 1 << 16
RANGE = 8 << 20
DATE = "2000-01-01T00:00:00Z"
INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, payload_bytes long, record_type string, refers_to long"


def _open(uri: str):
    """(filesystem, path) of a URI or a plain path; any store that Arrow knows."""
    from pyarrow import fs

    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", uri):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return fs.LocalFileSystem(), uri


def _clean(value: str) -> str:
    """Header values hold no control characters and no blanks; they are percent-encoded."""
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC/1.1 record with its two line ends, not compressed."""
    sha1 = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1.digest()).decode()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {_clean(url)}")
    if is_revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record: page_id, url, record_type, payload_digest (hex), payload_bytes, refers_to, payload (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(m[1]) if (m := re.search(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    revisit = fields["WARC-Type"] == "revisit"
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": number("WARC-Record-ID"),
        "url": None if url is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        "record_type": fields["WARC-Type"],
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "refers_to": number("WARC-Refers-To"),
        "payload": None if revisit else payload,
    }


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(folder: str, file_bytes: int):
    """Task function: (page_id, url, payload, digest, bytes, refers_to, is_revisit) -> index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        out = name = None
        at = 0
        try:
            for batch in batches:
                files, offsets, lengths = [], [], []
                for page_id, url, payload, refers_to, revisit in zip(*[batch.column(i) for i in (0, 1, 2, 5, 6)], strict=True):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = _member(record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), revisit.as_py()))
                    out.write(data)
                    files.append(name)
                    offsets.append(at)
                    lengths.append(len(data))
                    at += len(data)
                kinds = pa.array(["revisit" if r else "response" for r in batch.column(6).to_pylist()], pa.string())
                columns = [batch.column(0), batch.column(1), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), batch.column(3), batch.column(4), kinds, batch.column(5)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return run


def write(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (needs page_id, url, html) to ``folder``; returns the stored index.

    Of pages whose payloads are equal and have at least ``revisit_bytes`` bytes, the one with the largest page_id is
    the response and the others revisit it. Null html is an empty payload; a null url is left out of the record. Rows
    without page_id are responses. Of rows that repeat page_id and payload, each is written; all are responses if
    theirs is the largest id. An empty table writes nothing.
    """
    spark = pages.sparkSession
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    copied = rows.where(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest", "payload_bytes")
    first = copied.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    keyed = salted_join(rows, first.drop("n"), ["payload_digest", "payload_bytes"], "left")
    again = F.coalesce(F.col("page_id") < F.col("first"), F.lit(False))
    ready = keyed.select("page_id", "url", "payload", "payload_digest", "payload_bytes", F.when(again, F.col("first")).alias("refers_to"), again.alias("is_revisit"))
    index = ready.mapInArrow(_write(folder, file_bytes), INDEX)
    return stored(index, "warc-index")


def _read(folder: str, keep_payload: bool):
    """Task function: index rows sorted by place, with the number of their range -> records as read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        source, opened = None, None
        begin, chunk = 0, b""
        for batch in batches:
            found = []
            for file, offset, length, low, high in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if file != opened:
                    if source is not None:
                        source.close()
                    source, opened, begin, chunk = store.open_input_file(f"{root}/{file}"), file, 0, b""
                if not begin <= offset or offset + length > begin + len(chunk):
                    begin = low
                    chunk = source.read_at(high - low, low)
                data = zlib.decompress(chunk[offset - begin : offset - begin + length], 31)
                got = parse(data)
                if got["payload"] is not None and hashlib.sha1(got["payload"]).hexdigest() != got["payload_digest"]:
                    raise ValueError(f"Digest of {file} at {offset} is not that of its payload")
                found.append(got)
            columns = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
            columns += [("payload", pa.binary())] if keep_payload else []
            yield pa.RecordBatch.from_arrays([pa.array([g[n] for g in found], t) for n, t in columns], [n for n, _ in columns])
        if source is not None:
            source.close()

    return run


def read(index: DataFrame, folder: str, gap: int = GAP, span: int = RANGE, keep_payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name, read back from the files of ``folder`` and checked against their digests.

    Rows of one stretch of ``span`` bytes of a file are read together: ranges with at most ``gap`` bytes between them
    become one read. Returns page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for
    revisits), in no order.
    """
    rows = index.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / span))
    place = Window.partitionBy("file", "stretch").orderBy("offset")
    end = F.col("offset") + F.col("length")
    before = F.max(end).over(place.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("opens", F.when(F.col("offset") - before <= gap, 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("opens").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("file", "stretch", "run")
    rows = rows.withColumns({"low": F.min("offset").over(whole), "high": F.max(end).over(whole)})
    rows = rows.sortWithinPartitions("file", "offset").select("file", "offset", "length", "low", "high")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if keep_payload else "")
    return rows.mapInArrow(_read(folder, keep_payload), schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive all ``pages`` in the shared folder and read every record back, without the payloads."""
    folder = new_path(pages.sparkSession, "warc")
    return read(write(pages, folder), folder, keep_payload=False)


#: The same in DuckDB.
SQL = """
with p as (
  select page_id, sha1(coalesce(html, '')) as payload_digest, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes from pages),
f as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id < first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id < first then first end as refers_to
from f
"""
