"""WARC archives: written as whole-file gzip streams, normalised to one member per record.

``write_archives`` turns pages into WARC records (a repeated payload becomes a revisit record of
the page with the smallest id) and writes archives of bounded size, each one gzip stream.
``normalise`` inflates every archive once, as a stream, rewrites each record as a gzip member of
its own and writes a sidecar index of offsets beside the file. ``read_records`` seeks to the
offsets of an index and reads single members.

Archives get names no other attempt uses, and only names in a table that Spark has committed are
read, so a task that is run again leaves nothing half-written behind. They are written through
pyarrow's file systems, to any folder of which those know the scheme.

Defined cases: a null html is an empty payload; a null url gives an empty target; a null
page_id stays null and is never referred to; rows that share the smallest id of a payload are
all responses; characters a header cannot hold are percent-encoded; an empty table gives no
archive and no rows; a cut or damaged archive raises an error naming the file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.session import cut, workspace

#: Inflated bytes after which a task begins its next archive.
ARCHIVE_BYTES = 64 << 20
#: WARC needs a date; the pages table has none.
DATE = "1970-01-01T00:00:00Z"
_READ = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    said = urn.rpartition(":")[2].rstrip(">")
    return int(said) if said else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which keeps the headers of the payload only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


def split_stream(parts: Iterator[bytes], name: str) -> Iterator[bytes]:
    """WARC records of an inflated stream, one at a time."""
    held = bytearray()

    def more() -> None:
        part = next(parts, b"")
        if not part:
            raise ValueError(f"{name}: the archive ends inside a record")
        held.extend(part)

    for part in parts:
        held.extend(part)
        while held:
            while (end := held.find(b"\r\n\r\n")) < 0:
                more()
            if not held.startswith(b"WARC/"):
                raise ValueError(f"{name}: no WARC record where one should begin")
            size = end + 4 + int(_headers(bytes(held[:end]))["content-length"]) + 4
            while len(held) < size:
                more()
            yield bytes(held[:size])
            del held[:size]


def inflate(source, name: str) -> Iterator[bytes]:
    """Bytes of a gzip file of one or more members, about a megabyte at a time."""
    engine = zlib.decompressobj(31)
    while raw := source.read(_READ):
        while raw:
            if engine.eof:
                engine = zlib.decompressobj(31)
            try:
                out = engine.decompress(raw, _READ)
            except zlib.error as e:
                raise ValueError(f"{name}: {e}") from e
            raw = engine.unused_data if engine.eof else engine.unconsumed_tail
            if out:
                yield out
    if not engine.eof:
        raise ValueError(f"{name}: the gzip stream is cut short")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _write(folder: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, top = _open(folder)
    store.create_dir(top, recursive=True)
    out, engine, name, size, count, done = None, None, "", 0, 0, []

    def close() -> None:
        out.write(engine.flush())
        out.close()
        done.append((f"{folder}/{name}", count))

    for batch in batches:
        for page_id, url, html, first in zip(*(batch.column(i) for i in range(4)), strict=True):
            if out is None:
                name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                out, engine = store.open_output_stream(f"{top}/{name}", compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
            refers = first.as_py() if first.is_valid and page_id.is_valid and first.as_py() != page_id.as_py() else None
            raw = record(page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), refers)
            out.write(engine.compress(raw))
            size, count = size + len(raw), count + 1
            if size >= limit:
                close()
                out = None
    if out is not None:
        close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["archive", "n_records"])


def write_archives(pages: DataFrame, min_bytes: int = 0, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes all pages; returns archive paths and record counts.

    Of pages with equal payloads of at least ``min_bytes`` the smallest page_id is the response.
    """
    rows = pages.select("page_id", "url", "html").withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    first = rows.where(F.length(F.coalesce("html", F.lit("")).cast("binary")) >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"))
    folder = workspace(pages.sparkSession, "warc")
    records = rows.join(first, "digest", "left").select("page_id", "url", "html", "first")
    return cut(records.mapInArrow(partial(_write, folder, limit), "archive string, n_records bigint"), "archives")


_INDEX = "archive string, offset bigint, length bigint, type string, record_id string, target string"


def _rewrite(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, own = _open(path)
            to, top = _open(folder)
            to.create_dir(top, recursive=True)
            name, rows, at = f"{uuid.uuid4().hex}.warc.gz", [], 0
            with store.open_input_stream(own, compression=None) as source, to.open_output_stream(f"{top}/{name}", compression=None) as out, \
                    to.open_output_stream(f"{top}/{name}.idx", compression=None) as index:
                for raw in split_stream(inflate(source, path), path):
                    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = engine.compress(raw) + engine.flush()
                    head = _headers(raw[:raw.find(b"\r\n\r\n")])
                    row = (f"{folder}/{name}", at, len(member), head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"))
                    out.write(member)
                    index.write((json.dumps(dict(zip(("offset", "length", "type", "id", "target"), row[1:], strict=True))) + "\n").encode())
                    rows.append(row)
                    at += len(member)
                    if len(rows) >= 10_000:
                        yield _index_rows(rows)
                        rows = []
            if rows:
                yield _index_rows(rows)


def _index_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _INDEX.split(", ")])


def _tasks(archives: DataFrame) -> int:
    """One for each archive, as far as the session's shuffle width goes; few rows are much work here."""
    return max(1, min(archives.count(), 4 * int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrites the named archives; returns the rows of all sidecar indexes."""
    folder = workspace(archives.sparkSession, "warc-members")
    spread = archives.select("archive").repartition(_tasks(archives))
    return cut(spread.mapInArrow(partial(_rewrite, folder), _INDEX), "warc-index")


_RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, html string"


def _read(with_html: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, file = None, None
    for batch in batches:
        rows, held = [], 0
        for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if archive != path:
                if file is not None:
                    file.close()
                store, own = _open(archive)
                path, file = archive, store.open_input_file(own)
            file.seek(offset)
            raw = zlib.decompress(file.read(length), 31)
            head, _, rest = raw.partition(b"\r\n\r\n")
            about = _headers(head)
            http, _, payload = rest[:int(about["content-length"])].partition(b"\r\n\r\n")
            stated = about["warc-payload-digest"].partition(":")[2]
            if about["warc-type"] == "response":
                if digest_of(payload) != stated:
                    raise ValueError(f"{archive}: payload at {offset} does not match its digest")
                size, refers = len(payload), None
            else:
                size, refers = int(_headers(http)["content-length"]), _page_of(about["warc-refers-to"])
            html = payload.decode() if with_html and about["warc-type"] == "response" else None
            rows.append((_page_of(about["warc-record-id"]), size, stated, about["warc-type"], refers, about["warc-target-uri"], html))
            held += len(html or "")
            if held > 16 << 20:
                yield _record_rows(rows)
                rows, held = [], 0
        if rows:
            yield _record_rows(rows)
    if file is not None:
        file.close()


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _RECORDS.split(", ")])


def read_records(index: DataFrame, with_html: bool = True) -> DataFrame:
    """Every record an index lists, read by its offset."""
    spread = index.select("archive", "offset", "length").repartition(_tasks(index.select("archive").distinct()), "archive").sortWithinPartitions("archive", "offset")
    return spread.mapInArrow(partial(_read, with_html), _RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    index = normalise(write_archives(pages, min_bytes))
    return read_records(index, with_html=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
