"""WARC archives as a Python data source, and the archiving of pages with revisit records.

Every record is a gzip member whose extra field ``sl`` holds its compressed and its full length, as
archive tools write it, so that a reader can step over a record after a look at its headers.
Archives of other writers, with or without that field or compression, are read as well.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)

from hazardgrid.llm.common import shared_dir

HEAD_SCHEMA = "warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, content_length long, warc_date string"
HEADS = [x.split()[0] for x in HEAD_SCHEMA.split(", ")]
_ARROW = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.string()) for x in HEAD_SCHEMA.split(", ")])
# Names of the format (fixed values).
_FIELDS = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "warc_date": "WARC-Date"}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# -- records ---------------------------------------------------------------------------------------


def _line(value: str) -> str:
    """A header value on one line: control characters as in a URL."""
    return "".join(c if c >= " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(kind: str, record_id: str, payload: bytes, uri: str | None, digest: str, size: int, refers_to: str | None, date: str) -> bytes:
    """A response or, without the payload, a revisit record of HTML pages."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date)]
    fields += [("WARC-Target-URI", uri)] if uri else []
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", refers_to or "")]
        payload = b""
    fields.append(("Content-Length", str(len(http) + len(payload))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {_line(value)}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + http + payload + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member that names its own lengths."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 24 + len(body) + 8
    if max(total, len(data)) >= 1 << 32:  # the lengths don't fit in: an ordinary member
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        return packer.compress(data) + packer.flush()
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(data))
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


_EMPTY_LINE, _LINE_END = re.compile(rb"\r?\n\r?\n"), re.compile(rb"\r?\n")


class _Stream:
    """Bytes of one record, read as far as asked for; ``skip`` steps over the rest of it."""

    def __init__(self, file, packed: bool):
        self.file, self.packed, self.have, self.stop = file, packed, b"", None
        if packed:
            start = file.tell()
            head = file.read(24)
            if len(head) == 24 and head[3] & 4 and head[10:14] == b"\x0c\x00sl":
                self.stop = start + struct.unpack("<I", head[16:20])[0]
            self.unpack, self.tail = zlib.decompressobj(31), head

    def more(self, size: int = 1 << 12) -> bool:
        """Read on; False at the end."""
        if not self.packed:
            data = self.file.read(size)
            self.have += data
            return bool(data)
        if self.unpack.eof:
            return False
        at = self.tail or self.file.read(size if self.stop is None else min(size, max(0, self.stop - self.file.tell())))
        self.tail = b""
        if not at:
            return False
        self.have += self.unpack.decompress(at)
        return True

    def take(self, n: int) -> bytes:
        while len(self.have) < n and self.more(max(1 << 12, min(n - len(self.have), 1 << 20))):
            pass
        out, self.have = self.have[:n], self.have[n:]
        return out

    def head(self) -> bytes | None:
        """Up to an empty line; None at the end of the file."""
        while (at := self.have.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.have.strip():
                    raise ValueError("a record's headers have no end")
                return None
        out, self.have = self.have[:at], self.have[at + 4 :]
        return out

    def http_head(self, size: int) -> tuple[bytes, int]:
        """The HTTP head of a block of ``size`` bytes and how many bytes it takes with the empty line behind it.

        Lines may end in a bare line feed. A head without an end within the block, or within its first
        megabyte, is all there is: such a block has no payload.
        """
        size = min(size, 1 << 20)
        while not (end := _EMPTY_LINE.search(self.have, 0, size)) and len(self.have) < size and self.more():
            pass
        stop = end.end() if end else min(size, len(self.have))
        out, self.have = self.have[: end.start() if end else stop], self.have[stop:]
        return out, stop

    def skip(self, rest: int) -> None:
        """Step over ``rest`` bytes of the block and what follows it in the record."""
        if not self.packed:
            if rest > len(self.have):
                self.file.seek(rest - len(self.have), io.SEEK_CUR)
                self.have = b""
            else:
                self.file.seek(rest - len(self.have), io.SEEK_CUR)
                self.have = b""
            self.file.read(4)
        elif self.stop is not None:
            self.file.seek(self.stop)
        else:
            while not self.unpack.eof and self.more(1 << 16):
                self.have = b""
            self.file.seek(-len(self.unpack.unused_data), io.SEEK_CUR)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":")[::2] for line in _LINE_END.split(head)[1:])
    return {name.decode("latin-1").strip().lower(): value.decode("utf-8", "replace").strip() for name, value in pairs}


def records(file, size: int, wanted=lambda row: True, payload: bool = False) -> Iterator[tuple]:
    """Rows of an archive: headers first; blocks of rows that aren't wanted stay unread."""
    packed = file.read(2) == b"\x1f\x8b"
    file.seek(0)
    while file.tell() < size:
        stream = _Stream(file, packed)
        head = stream.head()
        if head is None:
            return
        if not head.lstrip().startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {head[:40]!r}")
        fields = _fields(head.lstrip())
        length = int(fields.get("content-length", 0))
        row = {name: fields.get(field.lower()) for name, field in _FIELDS.items()}
        row["payload_digest"] = (row["payload_digest"] or "").rpartition(":")[2] or None
        row["content_length"] = row["payload_bytes"] = length
        rest, ended = length, True
        if fields.get("content-type", "").startswith("application/http") and length:
            http, taken = stream.http_head(length)
            ended = taken > len(http)
            rest = length - taken
            stated = _fields(http).get("content-length", "")
            # What an HTTP head states counts only as a number; a head without an end has no payload.
            row["payload_bytes"] = (int(stated) if stated.isascii() and stated.isdigit() else rest) if ended else 0
        ok = wanted(row)
        body = None
        if ok and payload and row["warc_type"] != "revisit":
            body = stream.take(rest) if ended else b""
            rest -= len(body)
        stream.skip(rest)
        if ok:
            yield (*[row[name] for name in HEADS], body)


# -- the data source ---------------------------------------------------------------------------------


_TESTS = {
    EqualTo: lambda a, b: a is not None and a == b, EqualNullSafe: lambda a, b: a == b, In: lambda a, b: a is not None and a in b,
    GreaterThan: lambda a, b: a is not None and a > b, GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b, LessThanOrEqual: lambda a, b: a is not None and a <= b,
    StringStartsWith: lambda a, b: a is not None and a.startswith(b), IsNull: lambda a, b: a is None, IsNotNull: lambda a, b: a is not None,
}


@dataclass
class Files(InputPartition):
    """Archive files that one task reads: path and bytes."""

    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = str(options.get("payload", "false")).lower() == "true"
        self.split = int(options.get("split_bytes", 64 << 20))
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in HEADS:
                self.tests.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        """Files in the order of their size, small ones together up to the split size."""
        system, folder = _place(self.path)
        if system.get_file_info(folder).type == pafs.FileType.File:
            return [Files([(folder, system.get_file_info(folder).size)])]
        listed = f"{folder}/{MANIFEST}"
        if system.get_file_info(listed).type == pafs.FileType.File:
            with system.open_input_stream(listed) as file:
                lines = file.read().decode().split("\n")
            found = [(f"{folder}/{name}", int(size)) for name, _, size in (x.partition("\t") for x in lines if x)]
        else:
            infos = system.get_file_info(pafs.FileSelector(folder, recursive=True))
            found = [(x.path, x.size) for x in infos if x.type == pafs.FileType.File and x.path.endswith((".warc", ".warc.gz"))]
        out: list[Files] = []
        held = self.split + 1
        for path, size in sorted(found, key=lambda x: (-x[1], x[0])):
            if held + size > self.split:
                out.append(Files([]))
                held = 0
            out[-1].files.append((path, size))
            held += size
        return out or [Files([])]

    def read(self, partition):
        tests = [(name, _TESTS[kind], value) for name, kind, value in self.tests]
        schema = _ARROW.append(pa.field("payload", pa.binary())) if self.payload else _ARROW

        def wanted(row):
            return all(test(row[name], value) for name, test, value in tests)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        system, _ = _place(self.path)
        rows, held = [], 0
        for path, size in partition.files:
            with io.BufferedReader(system.open_input_file(path), 1 << 18) as file:
                for row in records(file, size, wanted, self.payload):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if len(rows) >= 8192 or held >= 16 << 20:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of ``record_id, warc_type, target_uri, refers_to, payload_bytes, payload_digest, payload``.

    Each attempt of a task writes files of its own, new ones past ``file_bytes``; the manifest that
    ends the job names those of the attempts that counted, so what a lost executor left is never read.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.date = options["path"], options.get("date", "2024-01-01T00:00:00Z")
        self.most = int(options.get("file_bytes", 256 << 20))

    def write(self, iterator):
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        files, out, size, name = [], None, 0, ""
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                payload = row["payload"] or b""
                digest = row["payload_digest"] or base64.b32encode(hashlib.sha1(payload).digest()).decode()
                data = member(record(row["warc_type"], row["record_id"], payload, row["target_uri"], digest, row["payload_bytes"], row["refers_to"], self.date))
                out.write(data)
                size += len(data)
                if size >= self.most:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def commit(self, messages):
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as file:
            file.write("".join(f"{name}\t{size}\n" for m in messages if m for name, size in m.files).encode())

    def abort(self, messages):
        system, folder = _place(self.path)
        for m in messages:
            for name, _ in m.files if m else ():
                system.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Options: ``path``; for reading ``payload`` (``true`` adds the decoded payload as a column; without it
    blocks are stepped over) and ``split_bytes``; for writing ``date`` and ``file_bytes``.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return HEAD_SCHEMA + (", payload binary" if str(self.options.get("payload", "false")).lower() == "true" else "")

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def read_warc(spark: SparkSession, path: str, payload: bool = False, **options) -> DataFrame:
    """Records of the archives under a path; filters on header columns reach the files."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(path=path, payload=str(payload).lower(), **options).load()


def write_warc(df: DataFrame, path: str, **options) -> None:
    df.sparkSession.dataSource.register(WarcSource)
    df.write.format("warc").options(path=path, **options).mode("append").save()


# -- pages -------------------------------------------------------------------------------------------

_PAGE, _NO_PAGE = "<urn:uuid:70616765-0000-8000-", "<urn:uuid:6e6f6964-0000-8000-"


def _record_id(page_id: Column) -> Column:
    digits = F.lower(F.lpad(F.hex(page_id), 16, "0"))
    return F.when(page_id.isNull(), F.concat(F.lit(_NO_PAGE), F.lit("0000-000000000000>"))).otherwise(
        F.concat(F.lit(_PAGE), F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12), F.lit(">"))
    )


def _page_id(record_id: str) -> Column:
    digits = F.translate(F.substring(record_id, len(_PAGE) + 1, 17), "-", "")
    return F.when(F.startswith(F.col(record_id), F.lit(_PAGE)), F.conv(digits, 16, -10).cast("long"))


def _base32(digest: Column) -> Column:
    """Upper-case base 32 of a SHA-1 in hex: ten hex digits at a time are eight characters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = [F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("long") for i in range(4)]
    return F.concat(*[F.substring(letters, (F.shiftright(p, 35 - 5 * j).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for p in parts for j in range(8)])


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages (``page_id``, ``url``, ``html``) as records to write.

    The payload is the HTML in UTF-8, null as empty. Of pages with equal payloads of at least
    ``least`` bytes the one with the smallest id is the response (rows that repeat it, too) and the
    others revisit it, without a payload; a null id comes behind all others. Copies are found by
    SHA-256 and length; the group of a payload is one row before the join, which has one row per
    payload on its small side, however many copies there are.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("copy", F.sha2("payload", 256))
    groups = rows.filter(F.col("payload_bytes") >= least).groupBy("copy", "payload_bytes")
    groups = groups.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.join(groups, ["copy", "payload_bytes"], "left").withColumn("payload_digest", _base32(F.sha1("payload")))
    return rows.select(
        _record_id(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        F.col("url").alias("target_uri"),
        F.when(revisit, _record_id(F.col("first"))).alias("refers_to"),
        "payload_bytes", "payload_digest",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archived_pages(pages: DataFrame, path: str | None = None, least: int = 0) -> DataFrame:
    """Write pages to archives and read their headers back, one row per page.

    Returns ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``. Without a
    path, a new folder in the shared folder is used. A page without id is a record without one; an
    empty table gives an archive without records.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    write_warc(page_records(pages, least), path)
    found = read_warc(spark, path).filter(F.col("warc_type").isin("response", "revisit"))
    return found.select(
        _page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        _page_id("refers_to").alias("refers_to"), F.col("target_uri").alias("url"),
    )
