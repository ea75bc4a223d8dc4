"""WARC archives as a PySpark data source.

Writing makes one gzip member per record (``*.warc.gz``), with the member's compressed and
plain length in the header's ``sl`` field.  Tasks write under temporary names; the driver
renames the files of the successful attempts at commit, so retried tasks leave nothing behind.

Reading plans partitions of whole files up to ``partitionBytes``.  Of each record only the
beginning is inflated and its headers parsed; equality and IN filters on ``record_type``,
``page_id``, ``target_uri`` and ``payload_digest`` are pushed down and decided there, and a
rejected record is skipped by its stored length.  With option ``payload`` = ``false`` no
payload is decoded at all.

A null payload is an empty one.  A null id is written as a random one and read back as null, as
is a missing address; line breaks in a header are percent-encoded.  A folder without archives is an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition,
                                    WriterCommitMessage)

from martloom.session import cut_lineage

SCHEMA = ("page_id bigint, target_uri string, record_type string, refers_to bigint, payload_bytes bigint, "
          "payload_digest string, payload binary")
FORMAT = "warc_archive"
_HEADERS = {"record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest",
            "page_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "payload_bytes": "X-Payload-Length"}
_ID = "<urn:page:{}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, uri: str | None, record_type: str, refers_to: int | None, payload: bytes) -> bytes:
    """One gzip member with the record; a revisit has the headers of the full payload and no content."""
    content = payload if record_type == "response" else b""
    name = f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else _ID.format(page_id)
    headers = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {name}",
               time.strftime("WARC-Date: %Y-%m-%dT%H:%M:%SZ", time.gmtime())]
    if uri is not None:
        headers.append("WARC-Target-URI: " + uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        headers += [f"WARC-Refers-To: {_ID.format(refers_to)}",
                    "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    headers += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}",
                "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(content)}"]
    plain = "\r\n".join(headers).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(plain) + packer.flush()
    # header (10), extra field (2 + 4 + 8), data, checksum and plain length (8)
    whole = 24 + len(packed) + 8
    extra = b"sl" + struct.pack("<HII", 8, whole & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed
            + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF))


def _stored_length(head: bytes) -> int | None:
    """Length of a member from the ``sl`` field of its header; none if there is no such field."""
    if len(head) < 24 or not head[3] & 4:
        return None
    end, at = 12 + struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(end, len(head)):
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at:at + 2] == b"sl" and at + 12 <= len(head):
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + size
    return None


def _headers(plain: bytes) -> dict[str, str]:
    lines = plain.decode("utf-8", "replace").split("\r\n")
    return {name.lower(): value.strip() for name, colon, value in (line.partition(":") for line in lines[1:]) if colon}


def _id(value: str | None) -> int | None:
    return int(value[len("<urn:page:"):-1]) if value and value.startswith("<urn:page:") else None


def _fields(headers: dict[str, str]) -> dict:
    value = {column: headers.get(name.lower()) for column, name in _HEADERS.items()}
    uri = value["target_uri"]
    return {"page_id": _id(value["page_id"]), "refers_to": _id(value["refers_to"]), "record_type": value["record_type"],
            "target_uri": uri and uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
            "payload_bytes": int(value["payload_bytes"] or headers.get("content-length", 0)),
            "payload_digest": (value["payload_digest"] or "").removeprefix("sha1:") or None}


def read_records(stream, wanted=lambda fields: True, payload: bool = True) -> Iterator[dict]:
    """Records of one archive whose header fields are ``wanted``."""
    held, at, ended = b"", 0, False

    def more(size: int) -> bytes:
        """The next ``size`` bytes, less only at the end of the archive; they stay unread."""
        nonlocal held, at, ended
        while len(held) - at < size and not ended:
            got = stream.read(max(1 << 20, size))
            ended = not got
            held, at = held[at:] + got, 0
        return held[at:at + size]

    while more(24):
        length = _stored_length(more(12 + struct.unpack_from("<H", more(12), 10)[0]))
        unpacker, plain, used = zlib.decompressobj(31), b"", 0
        while b"\r\n\r\n" not in plain and not unpacker.eof:
            piece = more(used + 4096)[used:] if length is None else more(length)[used:used + 4096]
            if not piece:
                raise ValueError("an archive ends within a record")
            plain += unpacker.decompress(piece)
            used += len(piece)
        head, _, rest = plain.partition(b"\r\n\r\n")
        fields = _fields(headers := _headers(head))
        keep = wanted(fields)
        if length is None or (keep and payload):
            while not unpacker.eof:
                piece = more(used + (1 << 20))[used:]
                if not piece:
                    raise ValueError("an archive ends within a record")
                rest += unpacker.decompress(piece)
                used += len(piece)
            length = used - len(unpacker.unused_data)
        if keep:
            yield fields | {"payload": rest[:int(headers.get("content-length", 0))] if payload else None}
        more(length)
        at += length


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@dataclass
class _Files(InputPartition):
    paths: list[str]


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", 64 << 20))
        self.accepted: dict[str, list[set]] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in _HEADERS:
                self.accepted.setdefault(column, []).append(set(f.value) if isinstance(f, In) else {f.value})
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, folder = _file_system(self.path)
        found = sorted((i for i in system.get_file_info(fs.FileSelector(folder)) if i.path.endswith(".warc.gz")), key=lambda i: i.path)
        groups, size = [], 0
        for info in found:
            if not groups or size + info.size > self.partition_bytes:
                groups.append([])
                size = 0
            groups[-1].append(info.path)
            size += info.size
        return [_Files(paths) for paths in groups] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(self.path)
        schema = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

        def wanted(fields: dict) -> bool:
            return all(fields[column] in values for column, sets in self.accepted.items() for values in sets)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_stream(path, compression=None) as stream:
                for row in read_records(stream, wanted, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.file_bytes = int(options.get("fileBytes", 128 << 20))

    def write(self, iterator) -> _Written:
        system, folder = _file_system(self.path)
        system.create_dir(folder, recursive=True)
        files, stream, size = [], None, 0
        for row in iterator:
            if stream is None or size > self.file_bytes:
                if stream is not None:
                    stream.close()
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                files.append((f"{name}.part", name))
                stream, size = system.open_output_stream(f"{name}.part", compression=None), 0
            record = record_bytes(row["page_id"], row["target_uri"], row["record_type"], row["refers_to"], bytes(row["payload"] or b""))
            stream.write(record)
            size += len(record)
        if stream is not None:
            stream.close()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        system, folder = _file_system(self.path)
        system.create_dir(folder, recursive=True)
        for message in messages:
            for temporary, name in message.files if message else ():
                system.move(temporary, name)

    def abort(self, messages: list[_Written | None]) -> None:
        system, _ = _file_system(self.path)
        for message in messages:
            for temporary, _name in message.files if message else ():
                system.delete_file(temporary)


class WarcDataSource(DataSource):
    """``spark.read.format("warc_archive").load(folder)`` and ``df.write.format(...).mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(dict(self.options))


def archive_rows(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows to write, from ``page_id, url, html``: of equal payloads of at least ``least_bytes`` the largest page is the response.

    Digests are counted without the payloads; only they and the ids are shuffled twice, the pages once by id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = cut_lineage(pages.filter(F.col("page_id").isNotNull() & (F.length(payload) >= least_bytes))
                        .select("page_id", F.sha1(payload).alias("sha")).distinct())
    first = cut_lineage(known.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    revisits = known.join(first, "sha").filter("page_id <> refers_to").select("page_id", "sha", "refers_to")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    return rows.join(revisits, ["page_id", "sha"], "left").select(
        "page_id", "target_uri", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"),
        "refers_to", F.lit(None).cast("bigint").alias("payload_bytes"), F.lit(None).cast("string").alias("payload_digest"), "payload")


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """One record per page, in archives below ``folder``."""
    register(pages.sparkSession)
    archive_rows(pages, least_bytes).write.format(FORMAT).mode("append").save(folder)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of all archives in ``folder`` with the columns of ``SCHEMA``."""
    register(spark)
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).load(folder)
