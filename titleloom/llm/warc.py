"""WARC archives as a PySpark data source, and archives of pages in which equal payloads are stored once.

``spark.read.format("warc")`` plans one partition per group of files, takes filters on the record type and on
other headers into the scan, reads the headers of a record first, and inflates a payload only when the record
passes and payloads are asked for. Every record is a gzip member of its own whose extra field ``sl`` holds
its compressed length, so that a record that is not wanted is passed over by a seek, and a large archive is read
by several tasks. Archives of other writers are read as a stream of records, whatever members hold them, or as
plain text without compression; such an archive is one task. A task finds the first member of its part by the way
members of this writer begin; archives that hold such archives as payloads should be read whole (``partitionBytes``).

``df.write.format("warc")`` writes one file per task, or several when a file gets full. Files count once the
job is committed: their names go to a list, and files of failed tasks are removed or never listed.

Options of the reader: ``payload`` (default true; false leaves payloads out), ``partitionBytes``.

Defined results
    * A null html counts as empty. A null URL gives a record without a target. A null page id gives a record
      whose id has no number; any other id is larger.
    * Payloads below the least size are never revisits. Rows that repeat page id and payload are equal records.
    * An empty table gives an archive without records.
    * ``payload_bytes`` counts the payload as stored; of a revisit, which has none, it is what its header says.
    * A record that ends within its header is an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from titleloom.llm.common import stored, text_or_empty
from titleloom.session import ship

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, "
    "payload_digest string, payload_bytes bigint, refers_to string, payload binary"
)
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MEMBER = struct.Struct("<4sIBBH2sHII")
_TAIL = struct.Struct("<II")
_FILE_BYTES = 1 << 28
_PARTITION_BYTES = 1 << 26
_HEADER_READ = 1 << 11
_BATCH_BYTES = 1 << 23
_LEVEL = 4


def member(data: bytes) -> bytes:
    """One gzip member with its own length in the extra field ``sl``."""
    deflate = zlib.compressobj(_LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = _MEMBER.size + len(body) + _TAIL.size
    head = _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + _TAIL.pack(zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(fields: dict[str, str | None], http: dict[str, str], payload: bytes) -> bytes:
    """A WARC record whose block is an HTTP response; a field without value is left out."""
    block = "HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http.items()) + "\r\n"
    data = block.encode() + payload
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(data)}\r\n\r\n".encode() + data + b"\r\n\r\n"


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, mark, value in pairs if mark}


def _plain_digest(value: str | None) -> str | None:
    """Bare lower-case hexadecimal digest of ``sha1:`` in base 32 or 16."""
    if not value:
        return None
    bare = value.rpartition(":")[2]
    return base64.b32decode(bare).hex() if len(bare) == 32 else bare.lower()


@dataclass
class FileGroup(InputPartition):
    """Archives that one task reads: name, and where records begin that are its own."""

    files: tuple[tuple[str, int, int], ...]


#: How a member of this writer begins.
_MAGIC = _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, 0, 0)[:16]


def splits(store: fs.FileSystem, path: str) -> bool:
    """Whether the members of an archive can be found from any place in it."""
    with store.open_input_file(path) as file:
        return file.read(len(_MAGIC)) == _MAGIC


def _next_member(file, at: int, end: int) -> int:
    """Where the first member at or behind ``at`` begins, or ``end``."""
    held = b""
    while at + len(held) < end + len(_MAGIC):
        file.seek(at + len(held))
        raw = file.read(1 << 20)
        held += raw
        if (found := held.find(_MAGIC)) >= 0:
            return min(at + found, end)
        if not raw:
            break
        kept = max(0, len(held) - len(_MAGIC) + 1)
        at, held = at + kept, held[kept:]
    return end


class Records:
    """The records of an open archive: ``data`` begins with the current one, as far as it has been read."""

    def __init__(self, file):
        self.file, self.data = file, b""
        self.begin = file.tell()  # of the member in which the current record begins
        self.plain = file.read(2) != b"\x1f\x8b"
        file.seek(self.begin)
        self.inflate, self.waiting = None, b""
        self.end, self.left = None, None  # of this member, if its head tells: the place behind it, bytes not yet read

    def _start(self, raw: bytes) -> None:
        place = self.file.tell() - len(raw)
        if len(raw) < _MEMBER.size:
            raw += self.file.read(_MEMBER.size - len(raw))
        self.inflate, self.waiting, self.end, self.left = zlib.decompressobj(31), raw, None, None
        if not self.data:
            self.begin = place
        if len(raw) >= _MEMBER.size and raw.startswith(_MAGIC):
            size, self.left = _MEMBER.unpack(raw[:_MEMBER.size])[7:]
            self.end = place + size

    def more(self) -> bool:
        """Read some more; false at the end of the archive."""
        step = _HEADER_READ if len(self.data) < _HEADER_READ else 1 << 18
        if self.plain:
            raw = self.file.read(step)
            self.data += raw
            return bool(raw)
        raw = self.waiting or self.file.read(step)
        if not raw:
            return False
        if self.inflate is None:
            self._start(raw)
            raw = self.waiting
        found = self.inflate.decompress(raw)
        self.waiting = b""
        if self.left is not None:
            self.left -= len(found)
        if self.inflate.eof:
            self.waiting, self.inflate, self.end, self.left = self.inflate.unused_data, None, None, None
        self.data += found
        return True

    def next(self) -> bool:
        """Go to the begin of a record; false without one."""
        while True:
            self.data = self.data.lstrip(b"\r\n")
            if self.data or not self.more():
                return bool(self.data)

    def upto(self, mark: bytes, start: int = 0) -> int:
        """Place behind ``mark``."""
        while (at := self.data.find(mark, start)) < 0:
            if not self.more():
                raise ValueError("a record ends within its header")
        return at + len(mark)

    def whole(self, size: int) -> bytes:
        """The first ``size`` bytes of the record."""
        parts, held = [self.data], len(self.data)
        while held < size:
            self.data = b""
            if not self.more():
                break
            parts.append(self.data)
            held += len(self.data)
        self.data = b"".join(parts)
        return self.data[:size]

    def leave(self, size: int) -> None:
        """Pass over the record, which has ``size`` bytes and an end of two lines."""
        size -= len(self.data)
        if self.end is not None and self.left is not None and size <= self.left <= size + 4:
            self.file.seek(self.end)
            self.inflate, self.waiting, self.end, self.left, self.data = None, b"", None, None, b""
            return
        while size > 0:
            self.data = b""
            if self.plain:
                self.file.seek(size, 1)
                return
            if not self.more():
                return
            size -= len(self.data)
        self.data = self.data[len(self.data) + size:] if size else b""


def _accepts(filters: list, row: dict) -> bool:
    for one in filters:
        value = row[one.attribute[0]]
        if isinstance(one, IsNotNull):
            fine = value is not None
        elif value is None:
            fine = False
        elif isinstance(one, EqualTo):
            fine = value == one.value
        elif isinstance(one, In):
            fine = value in one.value
        else:
            fine = value.startswith(one.value)
        if not fine:
            return False
    return True


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.bytes = int(options.get("partitionbytes", options.get("partitionBytes", _PARTITION_BYTES)))
        self.filters: list = []
        self.schema = schema

    def pushFilters(self, filters):
        """Keep what headers can answer; hand the rest back to Spark."""
        for one in filters:
            attribute = getattr(one, "attribute", None)
            if (
                isinstance(one, (EqualTo, In, IsNotNull, StringStartsWith))
                and len(attribute) == 1
                and attribute[0] not in ("payload",)
            ):
                self.filters.append(one)
            else:
                yield one

    def partitions(self):
        store, root = fs.FileSystem.from_uri(self.path)
        groups, size = [[]], 0
        for name, length in listed(store, root):
            step = self.bytes if length > self.bytes and splits(store, f"{root}/{name}") else max(1, length)
            for begin in range(0, length, step):
                if groups[-1] and size + min(step, length - begin) > self.bytes:
                    groups.append([])
                    size = 0
                groups[-1].append((name, begin, min(begin + step, length)))
                size += min(step, length - begin)
        return [FileGroup(tuple(group)) for group in groups if group] or [FileGroup(())]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(self.path)
        names = [name.partition(" ")[0] for name in SCHEMA.split(", ")]
        kinds = [pa.int64() if " bigint" in x else pa.binary() if " binary" in x else pa.string()
                 for x in SCHEMA.split(", ")]
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([row[n] for row in rows], k) for n, k in zip(names, kinds, strict=True)], names=names
            )

        for name, begin, end in partition.files:
            with store.open_input_file(f"{root}/{name}") as file:
                file.seek(_next_member(file, begin, end) if begin else 0)
                records = Records(file)
                while records.next() and records.begin < end:
                    row, size = self._row(records)
                    if row:
                        rows.append(row)
                        held += len(row["payload"] or b"") + 500
                    records.leave(size)
                    if held > _BATCH_BYTES:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()

    def _row(self, one: Records) -> tuple[dict | None, int]:
        """Header columns, then the payload if the record passes; and the size of the record."""
        block = one.upto(b"\r\n\r\n")
        warc = _fields(one.data[:block])
        row = {
            "record_id": warc.get("warc-record-id"), "record_type": warc.get("warc-type"),
            "target_uri": warc.get("warc-target-uri"), "date": warc.get("warc-date"),
            "content_type": None, "payload_digest": _plain_digest(warc.get("warc-payload-digest")),
            "payload_bytes": None, "refers_to": warc.get("warc-refers-to"), "payload": None,
        }
        size = block + int(warc.get("content-length", 0))
        late = [x for x in self.filters if x.attribute[0] in ("content_type", "payload_bytes")]
        if not _accepts([x for x in self.filters if x not in late], row):
            return None, size
        start = block
        if warc.get("content-type", "").startswith("application/http") and size > block:
            head = one.data.find(b"\r\n\r\n", block, size)
            while head < 0 and len(one.data) < size and one.more():
                head = one.data.find(b"\r\n\r\n", block, size)
            start = size if head < 0 else head + 4  # a head without a body has no blank line
            http = _fields(one.data[block:start])
            row["content_type"] = http.get("content-type")
            if row["record_type"] == "revisit" and http.get("content-length", "").isdigit():
                row["payload_bytes"] = int(http["content-length"])
        if row["payload_bytes"] is None:
            row["payload_bytes"] = size - start
        if not _accepts(late, row):
            return None, size
        if self.payload and row["record_type"] != "revisit":
            row["payload"] = one.whole(size)[start:]
        return row, size


def listed(store: fs.FileSystem, root: str) -> list[tuple[str, int]]:
    """Archives of a folder with their sizes: those on its lists, or all if it has no list."""
    found = [x for x in store.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=True)) if x.is_file]
    lists = [x for x in found if x.base_name.endswith(".files.json")]
    if not lists:
        return sorted((x.base_name, x.size) for x in found if x.base_name.endswith((".warc", ".warc.gz")))
    out = []
    for one in lists:
        with store.open_input_stream(one.path) as source:
            out += [(name, size) for name, size in json.loads(source.read())]
    return sorted(out)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Rows of the reader's schema to records; the payload of a revisit is not written."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files: list[tuple[str, int]] = []
        out, name = None, ""
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                out.write(member(self._record(row)))
                if out.tell() > _FILE_BYTES:
                    files.append((name, out.tell()))
                    out = out.close()
        if out is not None:
            files.append((name, out.tell()))
            out.close()
        return Written(files)

    @staticmethod
    def _record(row: dict) -> bytes:
        revisit = row["record_type"] == "revisit"
        payload = b"" if revisit else row["payload"] or b""
        digest = row["payload_digest"] or hashlib.sha1(payload).hexdigest()
        uri = row["target_uri"]
        fields = {
            "WARC-Type": row["record_type"], "WARC-Record-ID": row["record_id"], "WARC-Date": row["date"],
            "WARC-Target-URI": None if uri is None else quote(uri, safe="!#$%&'()*+,/:;=?@[]~"),
            "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
            "WARC-Refers-To": row["refers_to"], "WARC-Profile": PROFILE if revisit else None,
            "Content-Type": "application/http; msgtype=response",
        }
        size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
        http = {"Content-Type": row["content_type"] or "application/octet-stream", "Content-Length": str(size)}
        return record(fields, http, payload)

    def commit(self, messages) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files = [tuple(file) for message in messages if message for file in message.files]
        with store.open_output_stream(f"{root}/{uuid.uuid4().hex}.files.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for name, _ in message.files if message else ():
                store.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to a session, with filters taken into the scan."""
    ship(spark).dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def _urn(id) -> F.Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(id.cast("string"), F.lit("")), F.lit(">"))


def page_of(urn: str) -> F.Column:
    """Page id of a record id."""
    number = F.regexp_extract(urn, "^<urn:x-page:(-?[0-9]+)>$", 1)
    return F.when(number != "", number).cast("bigint")


def page_records(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST_REVISIT,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Rows of the reader's schema: of equal payloads the largest page id is the response, the others revisit it.

    Only payloads that occur twice enter the table of groups. It is stored, so the join with the pages
    has plain sides: a small table is broadcast by Spark's own rule, and a payload with a third of all
    pages is split by adaptive execution.
    """
    body = text_or_empty(html)
    rows = pages.select(
        F.col(id).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"), body.alias("html"),
        F.unhex(F.sha2(body, 256)).alias("key"), F.octet_length(body).cast("bigint").alias("size"),
    )
    large = rows.filter(F.col("size") >= least)
    groups = large.groupBy("key").agg(F.max("page").alias("first"), F.count("*").alias("n"))
    groups = stored(groups.filter("n > 1").select("key", "first"), "payloads")
    joined = rows.join(groups, "key", "left")
    revisit = F.coalesce(~F.col("first").eqNullSafe(F.col("page")) & F.col("first").isNotNull(), F.lit(False))
    return joined.select(
        _urn(F.col("page")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.lit("text/html; charset=utf-8").alias("content_type"), F.sha1("html").alias("payload_digest"),
        F.col("size").alias("payload_bytes"), F.when(revisit, _urn(F.col("first"))).alias("refers_to"),
        F.when(~revisit, F.encode("html", "utf-8")).alias("payload"),
    )


def write_warc(rows: DataFrame, path: str) -> None:
    """Append records to the archives of a folder."""
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    return register(spark).read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """Per record its page id, payload size and digest, type, and the page it refers to.

    Responses are checked against their payloads; for revisits headers are enough.
    """
    first = read_warc(spark, path).filter("record_type = 'response'")
    again = read_warc(spark, path, payload=False).filter("record_type = 'revisit'")
    seen = first.select(
        page_of("record_id").alias("page_id"), F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", page_of("refers_to").alias("refers_to"),
    )
    return seen.unionByName(
        again.select(
            page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
            page_of("refers_to").alias("refers_to"),
        )
    )
