"""Compressed containers, as files and as a binary column."""

from __future__ import annotations

import csv
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from titleloom.functions import huffman
from titleloom.plans.sizing import dealt
from titleloom.session import ship

SUFFIX = ".ziphuff"
_BATCH = 10_000
_NAME_CHARS = 180
_TOGETHER, _SMALL = 1000, 1 << 18


def read_containers(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` of container files: one file, or all below a folder, whatever their suffix."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "content")


def container_name(path: Column) -> Column:
    """The name that a row had when its container file was written."""
    name = F.regexp_extract(path, r"([^/]*?)(?:,[0-9]+)?\%s$" % SUFFIX, 1)
    return F.when(name != "", F.url_decode(name))


def read_container_text(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)`` of container files."""
    return read_containers(spark, path).select("path", huffman.decode("content").alias("text"))


def _lines(pieces: Iterator[str]) -> Iterator[str]:
    """Lines with their ends, from text that comes in pieces."""
    rest = ""
    for piece in pieces:
        *whole, rest = (rest + piece).split("\n")
        yield from (line + "\n" for line in whole)
    if rest:
        yield rest


def _texts(contents: list[bytes]) -> Iterator[Iterator[str]]:
    """Texts of containers, in pieces; those of small ones are decoded together."""
    for begin in range(0, len(contents), _TOGETHER):
        own = contents[begin:begin + _TOGETHER]
        small = [i for i, content in enumerate(own) if len(content) < _SMALL]
        known = dict(zip(small, huffman.texts_of([own[i] for i in small])))
        for i, content in enumerate(own):
            yield iter([known.pop(i).decode("utf-8")]) if i in known else huffman.decoded_pieces(content)


def _title_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "row", "id", "url", "title"]
    for batch in batches:
        out = []
        for path, pieces in zip(batch["path"], _texts([bytes(content) for content in batch["content"]])):
            for row, record in enumerate(csv.DictReader(_lines(pieces))):
                out.append((path, row, record.get("id"), record.get("url") or None, record.get("title") or None))
                if len(out) == _BATCH:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        yield pd.DataFrame(out, columns=names)


def container_titles(containers: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(id, url, title, pos)`` from ``(path, content)`` rows that hold CSV text.

    Ids are strings as they stand; a column that the text lacks is NULL. A large container is decoded and parsed in
    pieces by one task, small ones are decoded together. ``tasks`` as for ``dealt``.
    """
    rows = dealt(containers.select("path", "content"), tasks).mapInPandas(
        _title_rows, "path string, row bigint, id string, url string, title string"
    )
    place = F.struct(F.col("path").alias("file"), "row")
    return rows.select("id", "url", "title", place.alias("pos"))


def read_titles_container(spark: SparkSession, path: str) -> DataFrame:
    """``(id, url, title, pos)`` from container files of CSV text."""
    return container_titles(read_containers(spark, path))


def write_containers(rows: DataFrame, path: str) -> None:
    """Write rows with their container column as a Parquet table."""
    rows.write.parquet(path)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: int


class ContainerWriter(DataSourceArrowWriter):
    """One file for each row ``(name, content)``.

    A task writes into a folder of its own below ``_writing``. When the job is committed, each folder is renamed to
    ``part-...``, one operation a task; what failed attempts left goes with ``_writing``. Until then, and after an
    abort, readers see nothing of it.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex

    def _store(self) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
        return store, root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = self._store()
        folder, files = uuid.uuid4().hex, 0
        for batch in iterator:
            names, contents = (batch.column(name).to_pylist() for name in ("name", "content"))
            for name, content in zip(names, contents):
                if content is None:
                    continue
                if not files:
                    store.create_dir(f"{root}/_writing/{self.job}/{folder}", recursive=True)
                # A number keeps rows of one name apart.
                place = f"{root}/_writing/{self.job}/{folder}/{_file_name(name)},{files}{SUFFIX}"
                with store.open_output_stream(place, compression=None) as out:
                    out.write(content)
                files += 1
        return Written(folder, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = self._store()
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if old.base_name.startswith("part-"):
                    store.delete_dir(old.path)
        store.create_dir(root, recursive=True)
        for message in messages:
            if message and message.files:
                store.move(f"{root}/_writing/{self.job}/{message.folder}", f"{root}/part-{message.folder}")
        self._forget(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._forget(*self._store())

    def _forget(self, store: fs.FileSystem, root: str) -> None:
        for place in (f"{root}/_writing/{self.job}", f"{root}/_writing"):
            left = fs.FileSelector(place, allow_not_found=True)
            if place.endswith(self.job) or not store.get_file_info(left):  # other jobs may be writing
                if store.get_file_info(place).type == fs.FileType.Directory:
                    store.delete_dir(place)


def _file_name(name: str | None) -> str:
    """A name as part of a path; one that is too long for that is cut and told apart by its digest."""
    coded = quote(name or "", safe="")
    if coded[:1] in (".", "_"):  # files whose names begin so are hidden from readers
        coded = f"%{ord(coded[0]):02X}{coded[1:]}"
    if len(coded) > _NAME_CHARS:
        coded = coded[:_NAME_CHARS - 65].rsplit("%", 1)[0] + "~" + hashlib.sha256(coded.encode()).hexdigest()
    return coded


class ContainerSource(DataSource):
    """Sink of container files. They are read by Spark's own reader of binary files."""

    @classmethod
    def name(cls) -> str:
        return "containers"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> ContainerWriter:
        return ContainerWriter(dict(self.options), overwrite)


def write_container_files(
    rows: DataFrame, path: str, name: str = "name", content: str = "blob", overwrite: bool = False
) -> None:
    """Write each container of a column as a file, named by another column, in addition to or instead of those there.

    NULL containers give no file. Names need not be unique; ``container_name`` gives them back.
    """
    ship(rows.sparkSession).dataSource.register(ContainerSource)
    named = rows.select(F.col(name).cast("string").alias("name"), F.col(content).alias("content"))
    named.write.format("containers").mode("overwrite" if overwrite else "append").save(path)
