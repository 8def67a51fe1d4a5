"""WARC archives: a Python data source that reads and writes them, and page archiving.

Reading plans partitions of whole files, up to ``splitBytes`` together. Equality and IN
predicates on the record type and the other header columns are pushed down. A record's header
is parsed first; when it fails a predicate, or the option ``payload`` is false, the reader
moves past the record's block without decoding it. Blocks of Content-Type ``application/http``
are split after their HTTP header; other blocks are whole payloads. Without a Content-Length
``payload_bytes`` is the length of the bytes that are there (null for a revisit). Files are plain or ``.gz``, with a member
for each record. Members written here carry their length in an extra field (``sl``), so that
the reader inflates the header and seeks past the rest; other ``.gz`` files are read on. With ``verify`` the SHA-1 of every payload that is decoded must
equal the header's.

Writing makes one file per task, rolled at ``rollBytes``. Files appear under their final name
when the whole write commits, so repeated or lost tasks leave nothing that is read.

Archiving writes one record per page. Of pages with equal payloads of at least ``least``
bytes the one with the largest page_id is a response and the others are revisits of it, which
hold the HTTP header and no payload; the header's Content-Length is that of the full payload.
Null html is an empty payload. A null page_id is never referred to. Pages that repeat an id
with the kept payload are responses all. Extra columns are ignored; no pages, no records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import struct
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage,
)

from clickwarden.llm.common import fresh_folder

SCHEMA = ("record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, payload binary")
HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
             "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ARROW = pa.schema([(n, pa.string()) for n in HEADER_OF] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _line(value: str) -> str:
    """A header value on one line; control characters and line ends are percent-encoded."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_bytes(record_type: str, record_id: str, target_uri: str | None, refers_to: str | None,
                 digest: str, payload_bytes: int, payload: bytes | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [f"WARC-Type: {record_type}", f"WARC-Record-ID: <{_line(record_id)}>", f"WARC-Date: {date}"]
    if target_uri is not None:
        head.append(f"WARC-Target-URI: {_line(target_uri)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_line(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _headers(stream: io.BufferedIOBase, first: bytes) -> dict[str, str]:
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    out = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return out


def _is_http(header: dict[str, str]) -> bool:
    return header.get("content-type", "").split(";")[0].strip().lower() == "application/http"


def _http_length(head: bytes) -> int | None:
    for line in head.split(b"\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value)
    return None


def _http_head(stream: io.BufferedIOBase, length: int) -> tuple[bytes, int]:
    """The HTTP header of a block of ``length`` bytes with its empty line, and the bytes read for it."""
    head, taken = [], 0
    while taken < length and (line := stream.readline(length - taken)):
        head.append(line)
        taken += len(line)
        if line in (b"\r\n", b"\n"):
            break
    return b"".join(head), taken


def row_of(header: dict[str, str]) -> dict:
    row = {c: header.get(h) for c, h in HEADER_OF.items()}
    for c in ("record_id", "refers_to"):
        row[c] = row[c].strip("<>") if row[c] else None
    row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
    return row


def matches(row: dict, wanted: dict[str, frozenset]) -> bool:
    return all(row[c] in values for c, values in wanted.items())


def read_records(stream: io.BufferedIOBase, wanted: dict[str, frozenset], payload: bool, verify: bool):
    """Rows of the records whose headers match ``wanted``."""
    seekable = isinstance(stream, io.BufferedReader)

    def skip(count: int) -> None:
        if seekable:
            stream.seek(count, io.SEEK_CUR)
        else:
            while count > 0 and (got := len(stream.read(min(count, 1 << 20)))):
                count -= got

    while (first := stream.readline()):
        if not first.strip():
            continue
        header = _headers(stream, first)
        length = int(header["content-length"])
        row = row_of(header)
        if not matches(row, wanted):
            skip(length + 4)
            continue
        # only HTTP blocks have a header before the payload; other blocks are payloads as they are
        head, taken = _http_head(stream, length) if _is_http(header) else (b"", 0)
        row["payload_bytes"], row["payload"] = _http_length(head), None
        if row["payload_bytes"] is None and row["record_type"] != "revisit":
            row["payload_bytes"] = length - taken
        if payload and row["record_type"] != "revisit":
            body = stream.read(length - taken)
            if verify and hashlib.sha1(body).hexdigest() != row["payload_digest"]:
                raise ValueError(f"payload of {row['record_id']} does not match its digest")
            row["payload"] = body
            skip(4)
        else:
            skip(length - taken + 4)
        yield row


def gzip_member(data: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field ``sl`` holds its own length and that of the data."""
    pack = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    extra = struct.pack("<2sHQQ", b"sl", 16, _FIXED + len(body) + 8, len(data))
    head = struct.pack("<4sIBBH", b"\x1f\x8b\x08\x04", 0, 0, 255, len(extra))
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


_FIXED = 12 + 20  # header and extra field
_PEEK = 4096


def read_gzip_records(raw, wanted: dict[str, frozenset], payload: bool, verify: bool):
    """Rows of a ``.gz`` file; members that name their length are skipped without inflating them."""
    at = raw.tell()
    while (head := raw.read(_FIXED)):
        if len(head) < _FIXED or head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != b"sl":
            raw.seek(at)  # of another writer
            yield from read_records(gzip.GzipFile(fileobj=raw), wanted, payload, verify)
            return
        size = struct.unpack_from("<Q", head, 16)[0]
        inflate, first = zlib.decompressobj(-15), raw.read(min(_PEEK, size - _FIXED - 8))
        data = inflate.decompress(first, _PEEK)
        start = io.BytesIO(data)
        whole = b"\r\n\r\n" not in data
        if not whole:
            header = _headers(start, start.readline())
            if not matches(row_of(header), wanted):
                at += size
                raw.seek(at)
                continue
        if whole or payload or data.count(b"\r\n\r\n") < 2:
            data += inflate.decompress(inflate.unconsumed_tail + raw.read(size - _FIXED - 8 - len(first)))
        yield from read_records(io.BufferedReader(io.BytesIO(data)), wanted, payload, verify)
        at += size
        raw.seek(at)


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", options.get("splitBytes", 64 << 20)))
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.wanted: dict[str, frozenset] = {}

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            name = f.attribute[0] if values is not None and len(f.attribute) == 1 else None
            if name in HEADER_OF and None not in values:
                self.wanted[name] = self.wanted.get(name, frozenset(values)) & frozenset(values)
            else:
                yield f

    def partitions(self):
        files, root = arrow_fs.FileSystem.from_uri(self.path)
        found = files.get_file_info(arrow_fs.FileSelector(root, recursive=True))
        out, held = [], 0
        for info in sorted(found, key=lambda i: i.path):
            if not info.is_file or info.base_name.startswith((".", "_")) or not info.base_name.endswith((".warc", ".warc.gz")):
                continue
            if not out or held + info.size > self.split:
                out.append(Files([]))
                held = 0
            out[-1].names.append(info.path)
            held += info.size
        return out or [Files([])]

    def read(self, partition):
        files, _ = arrow_fs.FileSystem.from_uri(self.path)
        for name in partition.names:
            with files.open_input_file(name) as raw:
                read = read_gzip_records if name.endswith(".gz") else read_records
                rows, held = [], 0
                for row in read(io.BufferedReader(raw, 1 << 18), self.wanted, self.payload, self.verify):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= 5000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if overwrite:
            raise ValueError("WARC folders are only appended to")
        self.path = options["path"]
        self.roll = int(options.get("rollbytes", options.get("rollBytes", 256 << 20)))
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.gz = str(options.get("gzip", "true")).lower() != "false"

    def write(self, iterator):
        from pyspark import TaskContext

        files, root = arrow_fs.FileSystem.from_uri(self.path)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        names, out, held = [], None, 0
        for batch in iterator:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            columns = [batch.column(at[n]) for n in (
                "record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload")]
            for row in zip(*columns, strict=True):
                data = record_bytes(*(v.as_py() for v in row), self.date)
                data = gzip_member(data) if self.gz else data
                if out is None or held + len(data) > self.roll:
                    if out is not None:
                        out.close()
                    name = f"{root}/.part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(names):04d}.warc{'.gz' if self.gz else ''}"
                    out, held = files.open_output_stream(name, compression=None), 0
                    names.append(name)
                out.write(data)
                held += len(data)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages):
        files, _ = arrow_fs.FileSystem.from_uri(self.path)
        for message in messages:
            for name in message.names if message else ():
                folder, _, base = name.rpartition("/")
                files.move(name, f"{folder}/{base[1:]}")

    def abort(self, messages):
        pass  # unfinished files keep names that are never read


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc").mode("append")``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """One record per page, with repeated payloads of at least ``least`` bytes as revisits.

    Pages are shuffled without their payloads. Payloads go beside them, one of each digest: copies
    are combined where they are read, so a payload that a third of all pages share moves once a task.
    Smaller pages are not shuffled at all.
    """
    body = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), body.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    digest = F.sha1("payload").alias("payload_digest")
    large, small = rows.filter(F.col("payload_bytes") >= least), rows.filter(F.col("payload_bytes") < least)
    payloads = large.select("page_id", "payload", digest).groupBy("payload_digest").agg(
        F.max("page_id").alias("kept"), F.first("payload").alias("payload"))
    joined = large.select("page_id", "target_uri", "payload_bytes", digest).join(payloads, "payload_digest")
    again = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    told = joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"), "target_uri",
        F.when(again, name("kept")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"))
    return told.unionByName(small.select(
        F.lit("response").alias("record_type"), name("page_id").alias("record_id"), "target_uri",
        F.lit(None).cast("string").alias("refers_to"), digest, "payload_bytes", "payload"))


def archive_pages(pages: DataFrame, folder: str, least: int = 1000) -> None:
    register(pages.sparkSession)
    page_records(pages, least).write.format("warc").mode("append").save(folder)


def read_archive(spark: SparkSession, folder: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(folder)


def archived_pages(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write ``pages`` as archives, and what the archives say of every page."""
    folder = fresh_folder(pages.sparkSession, "warc")
    archive_pages(pages, folder, least)
    number = lambda c: F.regexp_extract(F.col(c), r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return read_archive(pages.sparkSession, folder, verify="true").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
