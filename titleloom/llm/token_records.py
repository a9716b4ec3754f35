"""Token ids in length-delimited binary records, with an offset index beside every record file.

Record file: for each document ``length u64 | masked checksum of the length u32 | payload | masked checksum
of the payload u32``, little-endian. Payload: kind of the id u8 (0 null, 1 signed 64-bit, 2 UTF-8), bytes of
the id u32, the id, bytes of a token id u8 (2 or 4), the token ids. The checksum is CRC-32, rotated right by
15 bits plus a constant, so that records that hold records do not check against themselves by accident.
Index file: for each record ``offset u64, payload length u64, tokens before it in the file u64``, so a
reader can fetch records in any order.

Documents are dealt into ranges of the id, and of the place in the input among equal ids, so that an id of very many
rows is several tasks. They are sorted within the ranges; a task encodes and writes one range.
Files carry the name of the attempt that wrote them, and the table ``manifest`` names the files of the
attempts that count, in order, so a repeated task leaves at most a file that nobody reads.

Defined results
    * A null or empty text has no ids but the end id. Null document ids come first.
    * Documents with equal ids follow each other in the order in which they are read, each with its own record.
    * Truncation and padding that a tokenizer file asks for are not applied.
    * An empty table gives no record. Other columns are not read.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titleloom.llm.common import text_or_empty

END_ID = 2
#: Constant that is added to a rotated checksum.
MASK = 0xA282EAD8
#: Entries of each of the two generations of the word cache of a Python worker.
CACHE_WORDS = 300_000
#: Characters of the longest words that are kept there.
LONGEST_KEPT = 64

_HEAD, _CHECK, _ID = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BI")
_CUTS = re.compile(r"(?<=\S)(?=[ \n])")
_FIRST = re.compile(r"[^ \n]*")
#: Characters of the texts that are encoded together; a row counts as some, too.
_LOAD_CHARS, _ROW_CHARS = 1 << 23, 100
_SHUFFLE_READ = 1 << 22

# How byte-level vocabularies write bytes as characters. Printable bytes are themselves, the
# others are the characters from U+0100 on, in the order of the bytes.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [byte for byte in range(256) if byte not in _PRINTABLE]
_BYTE_LETTERS = "".join(chr(byte if byte in _PRINTABLE else 0x100 + _OTHERS.index(byte)) for byte in range(256))
_BLANK = _BYTE_LETTERS[0x20]
#: Letters below this are letters for every version of Unicode.
_PLAIN_LETTERS = "\u0250"
#: Marks that may stand behind letters, and how many of them are looked at apart.
_MARKS, _MARKS_APART = string.punctuation, 3


def masked(data: bytes) -> int:
    """Checksum of the data, rotated and shifted by a constant."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def cuts_before_blanks(tokenizer) -> bool:
    """Whether a text may be cut before every blank that follows another character.

    So it is with byte-level pairs behind the usual pattern, without a normalizer and without own tokens that hold or
    take in white space. Of other tokenizers nothing is assumed.
    """
    parts = json.loads(tokenizer.to_str())
    before, model = parts["pre_tokenizer"] or {}, parts["model"]
    return (
        parts["normalizer"] is None
        and before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
        and model["type"] == "BPE"
        and not any(model.get(key) for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(
            re.search(r"\s", one["content"]) or one["lstrip"] or one["rstrip"] or one["single_word"]
            for one in parts["added_tokens"]
        )
    )


class _Words(dict):
    """Ids of pieces of text by their keys: the younger of two generations, which finds what it does not hold.

    A piece that begins with a line break, or with a blank before white space, is its own key; other pieces stand
    after a blank, which is not part of the key.
    """

    def __init__(self, find, limit: int):
        super().__init__()
        self.find, self.limit = find, limit
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.find(key)
            if len(key) > LONGEST_KEPT:
                return ids
        if len(self) > self.limit:
            self.old.clear()
            self.old.update(self)
            self.clear()
        self[key] = ids
        return ids


class WordEncoder:
    """Encodes texts with a tokenizer, asking it once for a word that comes again.

    A byte-level tokenizer never joins a blank or line break to what stands before it, unless that is white space and
    white space, the end or an own token follows. So a text may be cut before others, and the ids of the parts, one
    after the other, are those of the whole. Texts with such blanks are cut before white space as a whole.
    Two generations of a cache of words bound its memory and keep frequent words. With any other tokenizer
    texts are encoded whole.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks; idle threads would only spin
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = cuts_before_blanks(self.tokenizer)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        own = [one.content for one in self.tokenizer.get_added_tokens_decoder().values()]
        #: A blank or line break with white space before it that more white space, the end or an own token follows.
        self.inside_blanks = re.compile(r"[ \n](?<=\s[ \n])(?:%s)" % "|".join([r"(?!\S)", *map(re.escape, own)]))
        #: Whether letters with marks behind them hold no own token, so that the model may be asked for them.
        self.plain = not any(one.rstrip(_MARKS).isalpha() or not one.strip(_MARKS) for one in own)
        self.model = self.tokenizer.model
        self.young = _Words(self._find, cache_words)
        self.marks: dict[str, bytes] = {}
        self.line = self._ask("\n")

    def _ask(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return array(self.code, found.ids).tobytes()

    def _find(self, key: str) -> bytes:
        """Ids of a piece that is not in the cache.

        Letters alone, and letters with marks behind them, are what the tokenizer's own pattern takes
        apart, so its model is asked for the letters without the pass that looks for the parts.
        """
        line = key[:1] == "\n"
        word = key[1:] if line else key
        letters = word if word.isalpha() else word.rstrip(_MARKS)
        marks = word[len(letters) :]
        if (
            not self.plain or len(marks) > _MARKS_APART
            or not (letters.isalpha() and (letters.isascii() or max(letters) < _PLAIN_LETTERS))
        ):
            return self._ask(key if line or key[:1] == " " else " " + key)
        ids = None if line or not marks else self.young.get(letters) or self.young.old.get(letters)
        if ids is None:
            if not letters.isascii():
                letters = codecs.charmap_decode(letters.encode(), "strict", _BYTE_LETTERS)[0]
            found = self.model.tokenize(letters if line else _BLANK + letters)
            ids = array(self.code, [one.id for one in found]).tobytes()
        if marks:
            last = self.marks.get(marks)
            if last is None:
                last = self.marks[marks] = self._ask(marks)
            ids += last
        return self.line + ids if line else ids

    def _learn(self, keys: set[str]) -> None:
        """Put pieces into the cache."""
        for key in keys:
            self.young[key]

    def encode(self, text: str) -> bytes:
        if not self.by_words:
            return self._ask(text)
        if self.inside_blanks.search(text):
            first, *parts = _CUTS.split(text)
            keys = [part[1:] if part[0] == " " and part[1:2] not in (" ", "\n") else part for part in parts]
        else:
            first, *keys = text.replace("\n", " \n").split(" ")
        known = b"".join(map(self.young.__getitem__, keys))
        return self._ask(first) + known if first else known

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Every different word of the texts is looked up once."""
        if not self.by_words:
            return [self._ask(text) for text in texts]
        begins, rests = [], []
        for text in texts:
            if self.inside_blanks.search(text):
                begins.append(self.encode(text))
                rests.append("")
            else:
                first = _FIRST.match(text)[0]
                begins.append(self._ask(first) if first else b"")
                rests.append(text[len(first) :])
        # Before the first blank of a rest stands an empty string, which is no word.
        column = pa.array(rests, pa.string())
        del rests
        column = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        edges, words = column.offsets.to_numpy(), column.flatten().dictionary_encode()
        del column
        found = pa.array(list(map(self.young.__getitem__, words.dictionary.to_pylist())), pa.binary())
        ids = found.take(words.indices)
        bounds, data = np.frombuffer(ids.buffers()[1], np.int32), ids.buffers()[2]
        spans = zip(begins, bounds[edges[:-1] + 1].tolist(), bounds[edges[1:]].tolist(), strict=True)
        return [begin + data[low:high].to_pybytes() for begin, low, high in spans]


def _id_bytes(value) -> bytes:
    if value is None:
        return _ID.pack(0, 0)
    if isinstance(value, int):
        return _ID.pack(1, 8) + struct.pack("<q", value)
    data = str(value).encode()
    return _ID.pack(2, len(data)) + data


def _read_id(kind: int, data: bytes):
    return None if kind == 0 else struct.unpack("<q", data)[0] if kind == 1 else data.decode()


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
) -> None:
    """Encode and write documents in ascending order of the id under a new folder ``path``."""
    place = F.monotonically_increasing_id().alias("place")
    rows = docs.select(F.col(id).alias("id"), text_or_empty(text).alias("text"), place)
    ordered = rows.repartitionByRange("id", "place").sortWithinPartitions("id", "place").select("id", "text")
    ordered.mapInArrow(
        lambda batches: _write(batches, path, tokenizer, end_id),
        "part int, file string, index string, records bigint, tokens bigint",
    ).write.parquet(f"{path}/manifest")


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _encoded(batches, encoder: WordEncoder) -> Iterator[tuple[object, bytes]]:
    """Document ids and token ids, encoded in loads of a bounded size or of one text."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py()
            grown = len(text) + _ROW_CHARS
            if texts and size + grown > _LOAD_CHARS:
                yield from zip(keys, encoder.encode_all(texts), strict=True)
                keys, texts, size = [], [], 0
            keys.append(key)
            texts.append(text)
            size += grown
    if texts:
        yield from zip(keys, encoder.encode_all(texts), strict=True)


def _write(batches, path: str, tokenizer: str, end_id: int):
    encoder = _encoder(tokenizer)
    end = np.array([end_id], encoder.dtype).tobytes()
    width = bytes([encoder.dtype.itemsize])
    part = TaskContext.get().partitionId()
    name = f"part-{part:06d}-{uuid.uuid4().hex}"
    store, root = fs.FileSystem.from_uri(path)
    index: list[tuple[int, int, int]] = []
    offset = tokens = 0
    out = None
    for key, ids in _encoded(batches, encoder):
        if out is None:
            store.create_dir(root, recursive=True)
            out = store.open_output_stream(f"{root}/{name}.rec")
        payload = b"".join((_id_bytes(key), width, ids, end))
        head = _HEAD.pack(len(payload))
        out.write(b"".join((head, _CHECK.pack(masked(head)), payload, _CHECK.pack(masked(payload)))))
        index.append((offset, len(payload), tokens))
        offset += len(payload) + 16
        tokens += len(ids) // encoder.dtype.itemsize + 1
    if out is None:
        return
    out.close()
    with store.open_output_stream(f"{root}/{name}.idx") as file:
        file.write(np.array(index, "<u8").tobytes())
    row = [[part], [f"{name}.rec"], [f"{name}.idx"], [len(index)], [tokens]]
    types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(row, types, strict=True)], ["part", "file", "index", "records", "tokens"]
    )


def frames(file) -> Iterator[bytes]:
    """Payloads of a record file, checked."""
    while head := file.read(12):
        (length,), (check,) = _HEAD.unpack(head[:8]), _CHECK.unpack(head[8:])
        if masked(head[:8]) != check:
            raise ValueError("the length of a record is damaged")
        payload = file.read(length)
        if len(payload) != length or masked(payload) != _CHECK.unpack(file.read(4))[0]:
            raise ValueError("a record is damaged")
        yield payload


def parse(payload: bytes) -> tuple[object, np.ndarray]:
    """Document id and token ids of a record."""
    kind, size = _ID.unpack_from(payload)
    at = _ID.size + size
    width = payload[at]
    return _read_id(kind, payload[_ID.size : at]), np.frombuffer(payload, f"<u{width}", offset=at + 1)


def fetch(path: str, file: str, index: str, numbers: list[int]) -> list[tuple[object, np.ndarray]]:
    """Records of one file by number, in the order asked for, through its index."""
    store, root = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{root}/{index}") as source:
        entries = np.frombuffer(source.read(), "<u8").reshape(-1, 3)
    out = []
    with store.open_input_file(f"{root}/{file}") as source:
        for offset, length, _ in entries[numbers].tolist():
            source.seek(offset)
            out.append(parse(next(frames(pa.BufferReader(source.read(length + 16))))))
    return out


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The manifest in order, with the number of ids before each file: one row per file."""
    manifest = spark.read.parquet(f"{path}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_records(spark: SparkSession, path: str, with_ids: bool = True, id_type: str = "bigint") -> DataFrame:
    """Records of all files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over ids as 32-bit integers.
    """
    files = shards(spark, path).select("file", "start")
    files = files.repartition(max(1, files.count()), "file")
    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    kinds = [pa.int64() if id_type == "bigint" else pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    if with_ids:
        kinds, names = [*kinds, pa.list_(pa.int32())], [*names, "ids"]

    def read(batches):
        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                start, held, rows = row["start"], 0, []
                with store.open_input_stream(f"{root}/{row['file']}", buffer_size=_SHUFFLE_READ) as file:
                    for payload in frames(file):
                        key, ids = parse(payload)
                        wide = ids.astype("<u4")
                        rows.append((key, start, len(ids), zlib.crc32(wide), wide.astype(np.int32)))
                        start += len(ids)
                        held += wide.nbytes
                        if held > _SHUFFLE_READ or len(rows) >= 5000:
                            yield _batch(rows, kinds, names)
                            held, rows = 0, []
                if rows:
                    yield _batch(rows, kinds, names)

    return files.mapInArrow(read, schema)


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))[: len(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
