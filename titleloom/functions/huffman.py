"""Helpers of the Huffman codec, run inside Arrow-batched functions.

A container is: header length (4 bytes, little-endian), code table as JSON, number of padding bits
(1 byte), code bits with the most significant bit first and zero padding at the end.
"""

from __future__ import annotations

import json
import struct
from collections import Counter, OrderedDict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleloom.functions.automaton import NARROW, WIDE, Automaton, Forest

_SLICE = 1 << 16
#: Bytes of automata that a worker keeps.
_MEMO_LIMIT = 64 << 20
#: Bytes or characters that are coded or decoded together.
_LOAD = 1 << 17
#: Coded bytes from which a table gets an automaton of its own, and most states of one that takes whole bytes.
_OWN_BYTES, _WIDE_STATES = 1 << 14, 1 << 10
_FOREST_STATES = 1 << 13
#: Characters below this are looked up in an array; codes up to this length fit between the bits of a word.
_DENSE, _WORD_CODE = 1 << 12, 57
#: Characters up to which a text alone is packed as a string of bits.
_SHORT = 2000
_COUNT_SLICE = 1 << 20
_COUNTS_HELD = 1 << 18


def code_table(freqs: dict[str, int]) -> dict[str, str]:
    """Prefix code of least total length. Ties go to the lower code point, leaves first."""
    leaves = sorted(freqs, key=lambda ch: (freqs[ch], ch))
    if len(leaves) == 1:
        return {leaves[0]: "0"}
    weight = [freqs[ch] for ch in leaves]
    # Merged weights never fall, so two sorted queues replace a heap.
    single, merged = deque(range(len(leaves))), deque()

    def lightest() -> int:
        if not merged or (single and weight[single[0]] <= weight[merged[0]]):
            return single.popleft()
        return merged.popleft()

    parent: dict[int, tuple[int, str]] = {}
    while len(single) + len(merged) > 1:
        zero, one = lightest(), lightest()
        node = len(weight)
        weight.append(weight[zero] + weight[one])
        parent[zero], parent[one] = (node, "0"), (node, "1")
        merged.append(node)
    codes = [""] * len(weight)
    for node in range(len(weight) - 2, -1, -1):
        above, bit = parent[node]
        codes[node] = codes[above] + bit
    return {ch: codes[i] for i, ch in enumerate(leaves)}


def pack(text: str, codes: dict[str, str]) -> bytes:
    """Padding byte and code bits of a text."""
    table = {ord(ch): code for ch, code in codes.items()}
    out, rest = bytearray(1), ""
    for start in range(0, len(text), _SLICE):
        bits = rest + text[start:start + _SLICE].translate(table)
        whole = len(bits) - len(bits) % 8
        if whole:
            out += int(bits[:whole], 2).to_bytes(whole // 8, "big")
        rest = bits[whole:]
    if rest:
        out[0] = 8 - len(rest)
        out.append(int(rest.ljust(8, "0"), 2))
    return bytes(out)


class _Table:
    """Codes of a scope by code point, as numbers and lengths."""

    def __init__(self, codes: dict[str, str]):
        points = sorted((ord(ch), code) for ch, code in codes.items())
        self.points = np.array([point for point, _ in points], np.int64)
        self.size = np.array([len(code) for _, code in points], np.int64)
        self.bits = np.array([int(code, 2) & (1 << 64) - 1 for _, code in points], np.uint64)
        self.dense = np.full(_DENSE, len(points))
        low = self.points < _DENSE
        self.dense[self.points[low]] = np.flatnonzero(low)

    def look_up(self, points: np.ndarray) -> np.ndarray:
        """Places of the codes of characters; all must have one."""
        if len(points) and points.max() < _DENSE:
            at = self.dense[points]
        else:
            at = np.searchsorted(self.points, points)
        if (at >= len(self.points)).any() or (self.points[at] != points).any():
            raise ValueError("a character has no code")
        return at


def _packed_load(texts: list[str], table: _Table) -> list[bytes]:
    """Padding byte and code bits of texts that are not empty: codes are put into 64-bit words side by side."""
    at = table.look_up(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64))
    size, bits = table.size[at], table.bits[at]
    chars = np.array([len(text) for text in texts])
    upto = np.cumsum(size)
    ends = upto[np.cumsum(chars) - 1]
    total = np.diff(np.r_[0, ends])
    whole = (total + 7) // 8 + 1
    begin = np.cumsum(whole) - whole
    place = upto - size + np.repeat((begin + 1) * 8 - (ends - total), chars)
    word, over = place >> 6, (place & 63) + size - 64
    out = np.zeros(int(place[-1] + size[-1] + 127) >> 6, np.uint64)
    head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    high = np.where(over > 0, bits >> np.maximum(over, 0).astype(np.uint64), bits << np.maximum(-over, 0).astype(np.uint64))
    out[word[head]] = np.bitwise_or.reduceat(high, head)
    rest = np.flatnonzero(over > 0)
    out[word[rest] + 1] |= bits[rest] << (64 - over[rest]).astype(np.uint64)
    data = out.astype(">u8").view(np.uint8)
    data[begin] = (whole - 1) * 8 - total
    joined, ends = data.tobytes(), (begin + whole).tolist()
    return [joined[a:b] for a, b in zip(begin.tolist(), ends)]


def pack_texts(texts: list[str], codes: dict[str, str], table: _Table | None = None) -> list[bytes]:
    """Padding byte and code bits of each text, under one code. Texts that are not empty are expected."""
    if max(map(len, codes.values())) > _WORD_CODE:
        return [pack(text, codes) for text in texts]
    table, out, held, size = table or _Table(codes), [], [], 0
    for text in texts:
        if size + len(text) > _LOAD and held:
            out += _packed_load(held, table)
            held, size = [], 0
        if len(text) > 4 * _LOAD:
            out.append(pack(text, codes))
            continue
        held.append(text)
        size += len(text)
    return out + (_packed_load(held, table) if held else [])


_automata: OrderedDict[bytes, Automaton] = OrderedDict()


def _automaton(header: bytes, codes: dict[str, str] | None = None) -> Automaton:
    """Automaton of a JSON code table; those used last stay, up to a number of bytes."""
    found = _automata.pop(header, None)
    if found is None:
        forest = Forest()
        forest.add(codes or json.loads(header))
        found = forest.automaton(WIDE if len(forest.children) <= _WIDE_STATES else NARROW)
    _automata[header] = found
    while len(_automata) > 1 and sum(one.nbytes() for one in _automata.values()) > _MEMO_LIMIT:
        _automata.popitem(last=False)
    return found


def _loads(packed: list[bytes], places: list[int]) -> Iterator[list[int]]:
    held, size = [], 0
    for i in places:
        if held and size + len(packed[i]) > _LOAD:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(packed[i])
    if held:
        yield held


def unpack_texts(packed: list[bytes], headers: list[bytes]) -> list[bytes]:
    """Texts in UTF-8 of padding bytes and code bits, each under a JSON code table.

    Texts of a table that codes many bytes get an automaton of its own, which takes a byte at a time. The other
    tables share one that takes half a byte at a time and is soon built.
    """
    out: list[bytes] = [b""] * len(packed)
    places: dict[bytes, list[int]] = {}
    for i, header in enumerate(headers):
        places.setdefault(header, []).append(i)
    small: list[tuple[bytes, list[int]]] = []
    for header, own in places.items():
        if header not in _automata and sum(len(packed[i]) for i in own) < _OWN_BYTES:
            small.append((header, own))
            continue
        automaton = _automaton(header)
        for load in _loads(packed, own):
            if len(packed[load[0]]) > _LOAD:
                out[load[0]] = b"".join(automaton.pieces(packed[load[0]], 0, _LOAD))
                continue
            for i, text in zip(load, automaton.decode([packed[i] for i in load], [0] * len(load))):
                out[i] = text
    forest, trees, held = Forest(), [], []
    for header, own in [*small, (b"", [])]:
        if held and (not own or len(forest.children) > _FOREST_STATES):
            for i, text in zip(held, forest.automaton(NARROW).decode([packed[i] for i in held], trees)):
                out[i] = text
            forest, trees, held = Forest(), [], []
        if own:
            trees += [forest.add(json.loads(header))] * len(own)
            held += own
    return out


def header_of(codes: dict[str, str]) -> bytes:
    body = json.dumps(codes).encode("utf-8")
    return struct.pack("<I", len(body)) + body


def container_of(text: str, codes: dict[str, str]) -> bytes:
    return header_of(codes) + pack(text, codes)


def parts_of(blob: bytes) -> tuple[bytes, bytes]:
    """Code table, and padding byte with code bits, of a container."""
    (size,) = struct.unpack_from("<I", blob)
    return bytes(blob[4:4 + size]), bytes(blob[4 + size:])


def decoded_pieces(blob: bytes) -> Iterator[str]:
    """Text of a container in pieces of some code bits."""
    header, packed = parts_of(blob)
    for piece in _automaton(header).pieces(packed, 0, _LOAD):
        yield piece.decode("utf-8", "surrogatepass")


def texts_of(blobs: list[bytes]) -> list[bytes]:
    """Texts of containers in UTF-8."""
    parts = [parts_of(blob) for blob in blobs]
    return unpack_texts([packed for _, packed in parts], [header for header, _ in parts])


def text_of(blob: bytes) -> str:
    return "".join(decoded_pieces(blob))


def _present(work, values: list, *more: list) -> list:
    """``work`` over the rows in which nothing is missing or empty; the others become NULL."""
    rows = [i for i, row in enumerate(zip(values, *more)) if all(x is not None and len(x) for x in row)]
    out: list = [None] * len(values)
    for i, found in zip(rows, work(*[[column[i] for i in rows] for column in (values, *more)])):
        out[i] = found
    return out


def pack_by_table(texts: list[str], tables: list[str], header: bool, known: dict | None = None) -> list[bytes]:
    """Texts coded under the JSON code table of each; ``known`` keeps what was read from the tables."""
    known = {} if known is None else known
    places: dict[str, list[int]] = {}
    for i, table in enumerate(tables):
        places.setdefault(table, []).append(i)
    out: list[bytes] = [b""] * len(texts)
    for table, own in places.items():
        if table not in known:
            codes = json.loads(table)
            known[table] = codes, _Table(codes), header_of(codes)
        codes, numbers, head = known[table]
        for i, coded in zip(own, pack_texts([texts[i] for i in own], codes, numbers)):
            out[i] = head + coded if header else coded
    return out


def shared_coder(tables, header: bool | None):
    """Column function of ``(text or bytes, scope)`` under a broadcast of JSON code tables by scope.

    ``header`` asks for whole containers or for code bits only; None decodes code bits. What is read from the
    tables is kept, so it is bounded as they are.
    """
    kept: dict = {}

    def code(values: list, own: list) -> list:
        if header is None:
            return unpack_texts(values, [table.encode() for table in own])
        return pack_by_table(values, own, header, kept)

    @F.arrow_udf(T.StringType() if header is None else T.BinaryType())
    def run(values: pa.Array, scopes: pa.Array) -> pa.Array:
        known = tables.value
        own = [known.get(scope) for scope in scopes.to_pylist()]
        return pa.array(_present(code, values.to_pylist(), own), pa.string() if header is None else pa.binary())

    return run


@F.arrow_udf(T.BinaryType())
def encode_with(text: pa.Array, table: pa.Array) -> pa.Array:
    """Containers of texts under given JSON code tables; NULL for empty text."""
    work = lambda t, c: pack_by_table(t, c, True)
    return pa.array(_present(work, text.to_pylist(), table.to_pylist()), pa.binary())


@F.arrow_udf(T.BinaryType())
def pack_with(text: pa.Array, table: pa.Array) -> pa.Array:
    """Padding byte and code bits only, for a code table that is kept elsewhere."""
    work = lambda t, c: pack_by_table(t, c, False)
    return pa.array(_present(work, text.to_pylist(), table.to_pylist()), pa.binary())


@F.arrow_udf(T.StringType())
def unpack_with(packed: pa.Array, table: pa.Array) -> pa.Array:
    work = lambda b, c: unpack_texts(b, [one.encode() for one in c])
    return pa.array(_present(work, packed.to_pylist(), table.to_pylist()), pa.string())


def container_alone(text: str) -> bytes:
    """Container of a text under a code of its own."""
    codes = code_table(Counter(text))
    if len(text) < _SHORT:
        return container_of(text, codes)
    return header_of(codes) + pack_texts([text], codes)[0]


@F.pandas_udf(T.BinaryType())
def encode_alone(text: pd.Series) -> pd.Series:
    """Containers of texts, each under a code of its own; NULL for empty text."""
    return pd.Series(
        [container_alone(t) if t else None for t in text], dtype=object
    )


@F.arrow_udf(T.StringType())
def decode(blob: pa.Array) -> pa.Array:
    return pa.array(_present(texts_of, blob.to_pylist()), pa.string())


def _count_into(counts: dict, scope: str | None, texts: list[str]) -> None:
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    if not len(points):
        return
    found = np.bincount(points)
    own = counts.setdefault(scope, {})
    for point in np.flatnonzero(found).tolist():
        own[point] = own.get(point, 0) + int(found[point])


def count_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(scope, ch, n)`` of ``(scope, text)`` rows; texts are taken in slices, counts are held for a task."""
    counts: dict[str | None, dict[int, int]] = {}
    for batch in batches:
        waiting: dict[str | None, list[str]] = {}
        sizes: Counter = Counter()
        for scope, cell in zip(batch.column("scope").to_pylist(), batch.column("text")):
            text = cell.as_py() or ""
            for start in range(0, len(text), _COUNT_SLICE):
                piece = text[start:start + _COUNT_SLICE]
                waiting.setdefault(scope, []).append(piece)
                sizes[scope] += len(piece)
                if sizes[scope] >= _COUNT_SLICE:
                    _count_into(counts, scope, waiting.pop(scope))
                    sizes[scope] = 0
        for scope, texts in waiting.items():
            _count_into(counts, scope, texts)
        if sum(map(len, counts.values())) > _COUNTS_HELD:
            yield _counted(counts)
            counts = {}
    yield _counted(counts)


def _counted(counts: dict) -> pa.RecordBatch:
    rows = [(scope, chr(point), n) for scope, own in counts.items() for point, n in own.items()]
    scopes, chars, numbers = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(scopes, pa.string()), pa.array(chars, pa.string()), pa.array(numbers, pa.int64())],
        names=["scope", "ch", "n"],
    )


def codes_of_scope(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Codes of one scope. Its rows are distinct characters, so Unicode bounds the group."""
    table = code_table(dict(zip(rows["ch"], rows["freq"])))
    out = rows[["scope", "ch", "freq"]].copy()
    out["code"] = out["ch"].map(table)
    out["code_len"] = out["code"].str.len().astype("int32")
    return out
