"""WARC archives as a PySpark data source, written and read in parallel.

Writing: each task writes compressed files of about ``ROLL_BYTES``, one gzip member for each record, with the member's
length in the gzip header (the ``sl`` field of the format's annex). Files get names of their own, and the driver lists those
of successful tasks in a manifest, so a task that runs twice leaves nothing behind that is read.

Reading: files are planned into partitions of about ``PARTITION_BYTES``. Filters on record type and header columns
are pushed down. Of each record the header is unpacked first; unless the filters hold and the payload is wanted, the rest of
the member is skipped unread. Files are opened through pyarrow's file systems, not as local files.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from twosided.llm.common import col, let
from twosided.session import materialise, new_path

ROLL_BYTES, PARTITION_BYTES, BATCH_BYTES = 64 << 20, 32 << 20, 8 << 20
MANIFEST = "_manifest.json"

# The header line of each column, in the order of the columns: fixed values.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "profile": "WARC-Profile",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ", ".join(f"{name} string" for name in HEADERS) + ", payload binary"
_COLUMN = {header.lower(): name for name, header in HEADERS.items()}
_ARROW = pa.schema([*((name, pa.string()) for name in HEADERS), ("payload", pa.binary())])
_SPLIT = b"\r\n\r\n"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _record(row: dict) -> bytes:
    """A record: header lines, and for a response an HTTP head and the payload."""
    payload = row["payload"] or b""
    lines = ["WARC/1.1"]
    for name, header in HEADERS.items():
        if row.get(name) is not None:
            value = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in row[name])
            lines.append(f"{header}: {value}")
    block = b""
    if row["record_type"] == "response":
        lines.append("Content-Type: application/http; msgtype=response")
        block = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}".encode() + _SPLIT + payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + _SPLIT + block + _SPLIT


def _member(record: bytes) -> bytes:
    """A gzip member whose header tells its length; a length beyond 32 bits is told as 0."""
    packer = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    length = 24 + len(body) + 8
    told = (length, len(record)) if max(length, len(record)) < 1 << 32 else (0, 0)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *told)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _told_length(head: bytes) -> int:
    """The length of a gzip member by its ``sl`` field, 0 if it has none."""
    if len(head) >= 24 and head[3] & 4 and head[12:14] == b"sl":
        return struct.unpack_from("<I", head, 16)[0]
    return 0


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record here: {lines[0][:40]!r}")
    named = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in named}


@dataclass
class _Files(InputPartition):
    paths: list[str] = field(default_factory=list)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]] = field(default_factory=list)


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``; option ``payload=false`` leaves payloads null."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], str(self.options.get("payload", "true")).lower() != "false")

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        return _Writer(self.options["path"])


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        done, out, name, size = [], None, "", 0
        for batch in iterator:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if out is None:
                        name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    size += out.write(member := _member(_record(row))) or len(member)
                    if size >= ROLL_BYTES:
                        out.close()
                        done.append((name, size))
                        out = None
        if out is not None:
            out.close()
            done.append((name, size))
        return _Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        files = sorted(x for message in messages if message for x in message.files)
        with system.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = _open(self.path)
        for name, _ in (x for message in messages if message for x in message.files):
            system.delete_file(f"{folder}/{name}")


class _Reader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.wanted = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes over equality, membership, presence and prefix of header columns."""
        for x in filters:
            if isinstance(x, (EqualTo, In, IsNotNull, StringStartsWith)) and x.attribute[0] in HEADERS and len(x.attribute) == 1:
                self.wanted.append((x.attribute[0], type(x).__name__, getattr(x, "value", None)))
            else:
                yield x

    def _holds(self, row: dict[str, str | None]) -> bool:
        for name, kind, value in self.wanted:
            own = row[name]
            if own is None or not (kind == "IsNotNull" or kind == "EqualTo" and own == value
                                   or kind == "In" and own in value or kind == "StringStartsWith" and own.startswith(value)):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        """Files by the manifest, else all archives of the folder, in partitions of bounded bytes."""
        system, folder = _open(self.path)
        listed = {x.base_name: x for x in system.get_file_info(fs.FileSelector(folder))}
        if MANIFEST in listed:
            with system.open_input_stream(f"{folder}/{MANIFEST}") as file:
                files = json.loads(file.read())
        else:
            files = [(name, x.size) for name, x in sorted(listed.items()) if name.endswith((".warc", ".warc.gz"))]
        planned, held = [_Files([])], 0
        for name, size in files:
            if held and held + size > PARTITION_BYTES:
                planned.append(_Files([]))
                held = 0
            planned[-1].paths.append(name)
            held += size
        return planned

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, folder = _open(self.path)
        rows, held = [], 0
        for name in partition.paths:
            with system.open_input_file(f"{folder}/{name}") as file:
                for row in self._records(file):
                    rows.append(row)
                    held += 512 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def _records(self, file: pa.NativeFile) -> Iterator[dict]:
        at, end = 0, file.size()
        while at < end:
            file.seek(at)
            head = file.read(8192)
            packed = head[:2] == b"\x1f\x8b"
            unpacker, told = (zlib.decompressobj(31), _told_length(head)) if packed else (None, 0)
            read, text = len(head), b""
            text = unpacker.decompress(head, 4096) if packed else head
            while (cut := text.find(_SPLIT)) < 0:  # headers longer than what was unpacked
                more = unpacker.unconsumed_tail if packed and unpacker.unconsumed_tail else file.read(8192)
                if not more:
                    raise ValueError(f"a record at byte {at} has no end of its header")
                read += 0 if packed and unpacker.unconsumed_tail else len(more)
                text += unpacker.decompress(more, 4096) if packed else more
            headers = _headers(text[:cut])
            length = int(headers.get("content-length", 0))
            row = {name: None for name in HEADERS} | {_COLUMN[k]: v for k, v in headers.items() if k in _COLUMN}
            wanted = self._holds(row)
            whole = cut + 4 + length + 4
            if packed and told and not (wanted and self.payload):
                at += told
            elif packed:
                parts = [text]
                while not unpacker.eof:
                    more = unpacker.unconsumed_tail or file.read(1 << 16)
                    if not more:
                        raise ValueError(f"a record at byte {at} is cut off")
                    read += 0 if unpacker.unconsumed_tail else len(more)
                    parts.append(unpacker.decompress(more, 1 << 20))
                text = b"".join(parts)
                at += read - len(unpacker.unused_data)
            elif wanted and self.payload:
                if len(text) < whole:
                    text += file.read(whole - len(text))
                at += whole
            else:
                at += whole
            if wanted:
                row["payload"] = None
                if self.payload:
                    block = text[cut + 4 : cut + 4 + length]
                    if headers.get("content-type", "").startswith("application/http"):
                        block = block[block.find(_SPLIT) + 4 :]
                    row["payload"] = block
                yield row


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: each five hexadecimal digits give four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    letter = lambda v, shift: F.substr(letters, F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    number = lambda digest, i: F.conv(F.substr(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
    return let(F.sha1(payload), lambda digest: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: let(
        number(digest, i), lambda v: F.concat(*(letter(v, shift) for shift in (15, 10, 5, 0))))), ""))


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes a record for each row of ``pages`` to a new folder of archives.

    The payload is the page in UTF-8, empty for null. Of records with equal payloads of at least ``min_bytes`` bytes the one with the
    largest id is a response and others are revisits that refer to it; smaller ones are responses. Rows of that id are all
    responses; a null id refers to the response of an id, and without any all are responses. A null URL has no header;
    control characters in one are written as percent codes. No rows give an empty archive.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    payload = F.coalesce(col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(col(id_col).alias("id"), col(url_col).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "length": F.octet_length("payload").cast("long")})
    large = rows.filter(F.col("length") >= min_bytes).groupBy("digest").agg(F.max("id").alias("largest"), F.count("*").alias("n"))
    repeated = materialise(large.filter("n > 1").select("digest", "largest"), "repeated_payloads")
    joined = rows.join(repeated, "digest", "left")
    revisit = F.col("largest").isNotNull() & (F.col("length") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("largest"))
    records = joined.withColumn("revisit", revisit).select(
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
        record_id(F.col("id")).alias("record_id"), "target_uri", F.lit(date).alias("date"),
        F.when(F.col("revisit"), record_id(F.col("largest"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"), F.col("length").cast("string").alias("payload_length"),
        F.when(F.col("revisit"), REVISIT_PROFILE).alias("profile"),
        F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload")).alias("payload"))
    records.write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of a folder of archives; the session's setting for pushing filters to Python sources is put on."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and tells of each page what the archives hold.

    Responses are measured by their payloads; revisits, whose payloads are not there, by their headers.
    """
    spark, path = pages.sparkSession, new_path(pages.sparkSession, "warc")
    write_pages(pages, path)
    page = lambda name: F.regexp_extract(name, r"<urn:x-page:(-?\d*)>", 1)
    number = lambda name: F.when(page(name) != "", page(name).cast("long"))
    responses = read(spark, path).filter(F.col("record_type") == "response").select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read(spark, path, payload=False).filter(F.col("record_type") == "revisit").select(
        number("record_id").alias("page_id"), F.col("payload_length").cast("long").alias("payload_bytes"),
        F.replace(F.col("payload_digest"), F.lit("sha1:"), F.lit("")).alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"))
    return responses.union(revisits)
