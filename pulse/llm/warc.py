"""Web pages in WARC records, packaged in ZIP archives that are read by ranges.

Writing: every task streams its records, each a gzip member, into a stored (uncompressed) member of
a ZIP archive, followed by a stored index with a line per record. Names are new for every attempt,
and only what successful tasks report is read, so repeated attempts do no harm.

Reading: the end-of-archive record and, where sizes ask for it, its ZIP64 counterpart lead to the
central directory; that gives the places of the stored members. The index member tells where
records lie. Runs of records are dealt out and read by their byte ranges. Nothing is extracted.

Of pages with equal payloads of at least ``least`` bytes, the one with the largest id is a response and
the others revisit it.

Edge cases: a null payload is empty. A page without an id revisits an equal page that has one, else
it is a response. Rows with the largest id of a payload are all responses, if that id occurs more
than once. A null or empty address is left out of the record. No pages give no archives and no
rows. Columns besides id, address and payload are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from ..settle import settle
from . import arrow

#: Bytes of an archive, and of records that are read at once, about.
ARCHIVE_BYTES, READ_BYTES = 64 << 20, 2 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record: an HTTP response, or the headers of one whose payload another record has."""
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page)}", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c >= " "))
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    else:
        body += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
    page = lambda x: int(x[10:-1]) if x and len(x) > 11 else None
    kind, named = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and digest(payload) != named:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {"page_id": page(fields["warc-record-id"]), "payload_bytes": len(payload) if kind == "response" else sizes[0], "payload_digest": named,
            "record_type": kind, "refers_to": page(fields.get("warc-refers-to")), "url": fields.get("warc-target-uri"),
            "payload": payload if kind == "response" else None}


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _Archive:
    """A ZIP archive being written: a stored member of records, then its index."""

    def __init__(self, folder: str) -> None:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.wacz"
        self.sink = store.open_output_stream(f"{path}/{self.name}")
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open("archive/data.warc.gz", "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, url, data: bytes, named: str) -> None:
        squeezed = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = squeezed.compress(data) + squeezed.flush()
        self.member.write(packed)
        entry = {"digest": named, "offset": self.size, "length": len(packed), "filename": "data.warc.gz"}
        self.lines.append(f"{''.join((url or '-').split())} 20240101000000 {json.dumps(entry)}\n")
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open("indexes/index.cdxj", "w", force_zip64=True) as f:
            for line in self.lines:  # the reader wants offsets in order, so lines stay as written
                f.write(line.encode())
        self.zip.close()
        self.sink.close()
        return self.name, len(self.lines), self.size


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Write all pages; returns the list of archives (``archive``, ``records``, ``bytes``) as a table.

    Equal payloads are counted by digest before anything is moved. The digests that occur more than
    once are then joined: while they are few by broadcast, so that a task writes what it has read,
    else by digest, where adaptive execution splits a payload that very many pages have.
    """
    arrow.prepare(pages.sparkSession)
    own = pages.select(F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"))
    own = own.withColumn("sha", F.sha1(F.encode("body", "utf-8")))
    many = own.where(F.octet_length("body") >= least).groupBy("sha").agg(F.max("page").alias("last"), F.count("*").alias("n")).where("n > 1")
    many = settle(many.select(F.col("sha").alias("of"), "last"), "warc-equal")
    joined = own.join(many, F.col("sha") == F.col("of"), "left").select("page", "url", "body", "last", F.col("of").isNotNull().alias("equal"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, archive = [], None
        for b in batches:
            for page, address, body, last, equal in zip(*(b[c] for c in ("page", "url", "body", "last", "equal"))):
                page, address, last, data = page.as_py(), address.as_py(), last.as_py(), body.as_py().encode()
                revisit = equal.as_py() and last is not None and page != last
                archive = archive or _Archive(folder)
                archive.add(address, record(page, address, data, last, revisit), digest(data))
                if archive.size >= ARCHIVE_BYTES:
                    made.append(archive.close())
                    archive = None
        if archive:
            made.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{x[0]}" for x in made], pa.string()), *(pa.array([x[k] for x in made], pa.int64()) for k in (1, 2))], ["archive", "records", "bytes"])

    return settle(joined.mapInArrow(run, "archive string, records long, bytes long"), "warc-archives")


def directory(f) -> dict[str, tuple[int, int, int]]:
    """Members of the open ZIP file ``f``: name -> (place of its data, its stored size, method)."""
    size = f.seek(0, 2)
    tail_at = max(0, size - 65557)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: no end record")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or 0xFFFFFFFF in (length, start):
        f.seek(tail_at + at - 20)
        mark, _, end64, _ = struct.unpack("<4sIQI", f.read(20))
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator where the end record asks for one")
        f.seek(end64)
        data = f.read(56)
        if data[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where the locator points")
        count, length, start = struct.unpack_from("<QQQ", data, 32)
    f.seek(start)
    data, at, found = f.read(length), 0, {}
    for _ in range(count):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, full, n_name, n_extra, n_comment, place = struct.unpack_from("<10xH8xIIHHH8xI", data, at)
        name = data[at + 46:at + 46 + n_name].decode()
        extra, k = data[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, k)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                place = next(values) if place == 0xFFFFFFFF else place
            k += 4 + n
        at += 46 + n_name + n_extra + n_comment
        found[name] = place, packed, method
    for name, (place, packed, method) in found.items():
        f.seek(place)
        head = f.read(30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no member where the directory puts {name}")
        found[name] = place + 30 + sum(struct.unpack_from("<HH", head, 26)), packed, method
    return found


def runs_of_records(f) -> Iterator[tuple[int, int]]:
    """Byte ranges of the open archive that hold whole records, about READ_BYTES each, by its indexes."""
    members = directory(f)
    for name, (place, size, method) in members.items():
        if not name.startswith("indexes/"):
            continue
        if method:
            raise ValueError(f"{name} is not stored")
        f.seek(place)
        entries = []
        for line in f.read(size).decode().splitlines():
            entry = json.loads(line.split(" ", 2)[2])
            entries.append((entry["filename"], int(entry["offset"]), int(entry["length"])))
        run = None
        for member, offset, length in sorted(entries):
            base, _, method = members[f"archive/{member}"]
            if method:
                raise ValueError(f"archive/{member} is not stored")
            at = base + offset
            if run and run[1] == at and at + length - run[0] <= READ_BYTES:
                run = run[0], at + length
            else:
                if run:
                    yield run
                run = at, at + length
        if run:
            yield run


def records_in(data: bytes) -> Iterator[bytes]:
    """The records of consecutive gzip members."""
    while data:
        member = zlib.decompressobj(31)
        yield member.decompress(data)
        data = member.unused_data


_FIELDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string()}


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """All records of the archives named in column ``archive``: their fields and, if asked for, the ``payload`` of responses."""
    arrow.prepare(archives.sparkSession)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b["archive"].to_pylist():
                store, path = _store(name)
                with store.open_input_file(path) as f:
                    found = list(runs_of_records(f))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))], ["archive", "low", "high"])

    fields = {**_FIELDS, **({"payload": pa.binary()} if payload else {})}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, low, high in zip(*(b[c].to_pylist() for c in ("archive", "low", "high"))):
                store, path = _store(name)
                with store.open_input_file(path) as f:
                    f.seek(low)
                    rows = [parse(x) for x in records_in(f.read(high - low))]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in fields.items()], list(fields))

    # a number of partitions that is given is not merged for the few bytes that name a run of megabytes
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = archives.select("archive").repartition(tasks, "archive").mapInArrow(locate, "archive string, low long, high long")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * payload
    return runs.repartition(tasks, "archive", "low").mapInArrow(read, schema)


def fresh_folder(pages: DataFrame) -> str:
    """A new folder for archives, shared by driver and executors."""
    return shared_dir(pages.sparkSession, "warc")
