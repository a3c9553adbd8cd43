"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
    WriterCommitMessage,
)

#: One row per record. ``payload`` is the body after the HTTP header block, null for a revisit or where it isn't wanted;
#: digest and length are those of the full payload.
SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes long, headers map<string,string>, payload binary"
)
_ARROW = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
    ("payload", pa.binary()),
])
# fixed values of the format: header names, version line and the profile of revisits with identical payload
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
}
DIGEST, LENGTH, FULL_LENGTH = "WARC-Payload-Digest", "Content-Length", "X-Payload-Length"
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_files-"


def _folder(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _line(value: str) -> str:
    """A header value on one line: control characters as percent codes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode_record(row: dict) -> bytes:
    """One record. A revisit has the HTTP header block of its response and no body."""
    revisit, body = row["record_type"] == "revisit", row["payload"] or b""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + body
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = [(name, row[column]) for column, name in HEADERS.items() if row[column] is not None]
    head += [(DIGEST, f"sha1:{digest}"), (FULL_LENGTH, str(row["payload_bytes"]))]
    head += [("WARC-Profile", PROFILE)] if revisit else []
    head += [("Content-Type", "application/http; msgtype=response")]
    head += sorted((k, v) for k, v in dict(row["headers"] or {}).items() if v is not None)
    lines = [VERSION, *(f"{name}: {_line(value)}" for name, value in head), f"{LENGTH}: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """One record as a gzip member, whose extra field ``sl`` tells both lengths, so that readers can skip it."""
    packer = zlib.compressobj(3, zlib.DEFLATED, -15)
    data = packer.compress(record) + packer.flush()
    total = 10 + 2 + 12 + len(data) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(record))
    return (
        b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + data
        + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    )


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes files of bounded size; only files named by a committed list count, so a lost task leaves no records."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("fileBytes", 256 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _folder(self.path)
        store.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for k in range(batch.num_rows):
                    record = encode_record({n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)})
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.gzip else ""))
                        out, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    data = member(record) if self.gzip else record
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written]) -> None:
        store, root = _folder(self.path)
        store.create_dir(root, recursive=True)
        names = sorted(n for m in messages if m is not None for n in m.names)
        with store.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[Written]) -> None:
        """Files without a list are never read."""


@dataclass
class WarcFile(InputPartition):
    name: str


class WarcReader(DataSourceReader):
    """One partition per file. Filters on record type, ids and uris are applied to headers, before any payload."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.wanted: dict[str, set] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.wanted[column] = self.wanted.get(column, {f.value}) & {f.value}
            elif column in HEADERS and isinstance(f, In):
                self.wanted[column] = self.wanted.get(column, set(f.value)) & set(f.value)
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.present.add(column)
            else:
                yield f

    def partitions(self) -> Sequence[WarcFile]:
        store, root = _folder(self.path)
        found = store.get_file_info(arrow_fs.FileSelector(root, allow_not_found=True))
        listed, files = [], []
        for info in found:
            if info.base_name.startswith(MANIFEST):
                with store.open_input_stream(info.path, compression=None) as lines:
                    listed += json.loads(lines.read())
            elif info.base_name.endswith((".warc", ".warc.gz")):
                files.append(info.base_name)
        # a folder that this source has not written has no lists: all its archives count
        any_list = any(i.base_name.startswith(MANIFEST) for i in found)
        return [WarcFile(n) for n in (listed if any_list else sorted(files))]

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        if partition is None or not getattr(partition, "name", None):
            return
        store, root = _folder(self.path)
        rows, size = [], 0
        with store.open_input_file(f"{root}/{partition.name}") as file:
            records = _zipped(file, self) if partition.name.endswith(".gz") else _plain(file, self)
            for row in records:
                rows.append(row)
                size += 500 + len(row["payload"] or b"")
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def row(self, head: bytes) -> dict | None:
        """The columns that headers give, or null if a filter turns the record away."""
        lines = head.decode("utf-8", "replace").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        row = {column: fields.get(name) for column, name in HEADERS.items()}
        if any(row[c] not in allowed for c, allowed in self.wanted.items()) or any(row[c] is None for c in self.present):
            return None
        digest = fields.get(DIGEST, "")
        row["payload_digest"] = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
        row["payload_bytes"] = int(fields[FULL_LENGTH]) if FULL_LENGTH in fields else None
        known = {*HEADERS.values(), DIGEST, FULL_LENGTH, LENGTH, "Content-Type", "WARC-Profile"}
        row["headers"] = [(k, v) for k, v in fields.items() if k not in known]
        return row | {"payload": None, "__length": int(fields[LENGTH])}

    def finish(self, row: dict, block: bytes) -> dict:
        """The payload of a record, checked against its digest; a revisit has none."""
        if row["record_type"] != "revisit":
            at = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -4
            row["payload"] = block[at + 4:]
            found = hashlib.sha1(row["payload"]).hexdigest()
            if row["payload_digest"] is None:
                row["payload_digest"] = found
            elif row["payload_digest"] != found:
                raise ValueError(f"record {row['record_id']}: payload differs from its digest")
            row["payload_bytes"] = len(row["payload"])
        return row


_END = b"\r\n\r\n"


def _plain(file, reader: WarcReader) -> Iterator[dict]:
    at, total = 0, file.size()
    while at < total:
        file.seek(at)
        head = b""
        while _END not in head and (more := file.read(4096)):
            head += more
        if not head.strip():
            return
        cut = head.index(_END)
        row = reader.row(head[:cut])
        length = int(row["__length"]) if row else _length(head[:cut])
        if row is not None:
            row.pop("__length")
            if reader.payload:
                file.seek(at + cut + 4)
                row = reader.finish(row, file.read(length))
            yield row
        at += cut + 4 + length + 4


def _length(head: bytes) -> int:
    return next(int(x[len(LENGTH) + 2:]) for x in head.decode("utf-8", "replace").split("\r\n") if x.startswith(LENGTH + ": "))


def _zipped(file, reader: WarcReader) -> Iterator[dict]:
    at, total = 0, file.size()
    while at < total:
        file.seek(at)
        start = file.read(4096)
        skip = _skip_length(start)
        unpack, data, end = zlib.decompressobj(31), b"", None
        data = unpack.decompress(start)
        while _END not in data and not unpack.eof and (more := file.read(4096)):
            data += unpack.decompress(more)
        cut = data.index(_END)
        row = reader.row(data[:cut])
        if (row is None or not reader.payload) and skip:
            end = at + skip  # nothing else of this record is read
        else:
            rest = [data[cut + 4:]]
            while not unpack.eof and (more := file.read(1 << 16)):
                rest.append(unpack.decompress(more))
            end = file.tell() - len(unpack.unused_data)
            if row is not None and reader.payload:
                row = reader.finish(row, b"".join(rest)[:row["__length"]])
        if row is not None:
            row.pop("__length")
            yield row
        at = end


def _skip_length(start: bytes) -> int | None:
    """Length of a gzip member from its extra field ``sl``, if it has one."""
    if len(start) < 24 or not start[3] & 4:
        return None
    size, at = struct.unpack_from("<H", start, 10)[0], 12
    while at + 4 <= 12 + size:
        name, length = start[at:at + 2], struct.unpack_from("<H", start, at + 2)[0]
        if name == b"sl":
            return struct.unpack_from("<I", start, at + 4)[0]
        at += 4 + length
    return None


class WarcSource(DataSource):
    """Options: ``path``; reading: ``payload`` (false leaves payloads packed); writing: ``compression``, ``fileBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def use_warc(spark: SparkSession) -> None:
    """Make the source known to a session, with filters pushed into it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 1000
) -> DataFrame:
    """Records of pages, in the columns of ``SCHEMA``; the page's id is the header ``X-Page-Id``.

    Of pages with equal payloads of at least ``least_bytes``, the one with the largest id is the response and the
    others are revisits of it. Rows that repeat that id with that payload are responses too. A null html is an empty
    payload, a null url leaves out its header, a null id its header: such a page is a response only where its payload
    has no page with an id. Payloads are equal when SHA-256 and length are; a payload that a third of all pages share
    is one row per task before it meets its pages.
    """
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("body"),
    ).select("*", F.octet_length("body").cast("long").alias("bytes"), F.sha1("body").alias("sha1"), F.sha2("body", 256).alias("sha256"))
    groups = rows.filter(F.col("bytes") >= least_bytes).groupBy("sha256", "bytes").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")

    def name(page, digest):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), digest, F.lit(">"))

    both = rows.join(groups, ["sha256", "bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return both.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        name(F.col("page_id"), F.col("sha1")).alias("record_id"), F.col("url").alias("target_uri"),
        F.when(revisit, name(F.col("first"), F.col("sha1"))).alias("refers_to"), F.col("sha1").alias("payload_digest"),
        F.col("bytes").alias("payload_bytes"),
        F.when(F.col("page_id").isNotNull(), F.create_map(F.lit("X-Page-Id"), F.col("page_id").cast("string")))
        .otherwise(F.create_map().cast("map<string,string>")).alias("headers"),
        F.when(~revisit, F.col("body")).alias("payload"),
    )


def write_archives(records: DataFrame, path: str, **options: str) -> None:
    use_warc(records.sparkSession)
    records.write.format("warc").options(**options).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below a path. Without payloads only headers are unpacked; filters on the header columns are
    applied before payloads either way."""
    use_warc(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
