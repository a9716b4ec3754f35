"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words become numbers, and one automaton holds every run of words of every item. A document is
streamed through it word by word; the automaton's state and the matched length say which items the longest
suffix so far occurs in. Items of fewer words than a window count as one window of their own length.

The automaton grows with the benchmark and not with the corpus. Items are dealt into blocks of bounded
size; with more than one block every document is read against every block and what is found is merged before
anything is cut, so the size of what is broadcast has a bound of its own and results do not depend on it.

Defined results
    * Null and empty texts have no words and no hits. Items without words match nothing.
    * Items are told apart by their id as a string; a null id is the empty string. Rows that repeat an id
      are one item. Repeated windows within and among items are found like any other.
    * Repeated documents get a row each. An empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from titleloom.llm.common import blob, other_columns_aside, stored, text_or_empty

WINDOW = 10
#: Bytes of item texts in one automaton; a word takes some 0.5 KB of a Python worker.
BLOCK_BYTES = 1 << 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Lower case for A to Z, a blank for every ASCII character that no word holds.
_PLAIN = bytes(c if _WORD.fullmatch(bytes([c])) else 32 for c in _LOWER)


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text. Bytes from 0x80 belong to words, so splitting at blanks is splitting at the rest."""
    return text.translate(_PLAIN).split()


class ItemAutomaton:
    """Suffix automaton over several word sequences, with the items that own each window."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: dict[int, set[str]] = {}
        whole: dict[int, dict[int, set[str]]] = {}
        self.shortest = window
        for name, words in items:
            state, passed = 0, []
            for word in words:
                state = self._extend(state, self.vocabulary.setdefault(word, len(self.vocabulary)))
                passed.append(state)
            if len(words) >= window:
                for at in passed:
                    owners.setdefault(at, set()).add(name)
            elif words:
                whole.setdefault(state, {}).setdefault(len(words), set()).add(name)
                self.shortest = min(self.shortest, len(words))
        self._settle(owners, whole)

    def _extend(self, last: int, word: int) -> int:
        """State of the sequence so far plus ``word``."""
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, known, word)
        state = self._state({}, 0, self.length[last] + 1)
        while last != -1 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last != -1:
            target = self.next[last][word]
            fits = self.length[target] == self.length[last] + 1
            self.link[state] = target if fits else self._split(last, target, word)
        return state

    def _state(self, moves: dict[int, int], link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, last: int, target: int, word: int) -> int:
        """Part of ``target`` that holds sequences up to the length of ``last`` plus one."""
        state = self._state(dict(self.next[target]), self.link[target], self.length[last] + 1)
        self.link[target] = state
        while last != -1 and self.next[last].get(word) == target:
            self.next[last][word] = state
            last = self.link[last]
        return state

    def _settle(self, owners: dict, whole: dict) -> None:
        """Owners of every window, and short items that end at every state.

        A state is reached by several lengths. ``ends`` has ``(length, names)`` of short items that end
        there, longest first; those of states up the links are shorter than anything that reaches it.
        """
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for state in reversed(order):  # owners of longer sequences own their suffixes
            up = self.link[state]
            if state in owners and self.length[up] >= self.window:
                owners.setdefault(up, set()).update(owners[state])
        self.ends: dict[int, list[tuple[int, set[str]]]] = {}
        self.window_state = [0] * len(self.link)
        for state in order:
            up = self.link[state]
            if self.length[up] >= self.window:
                self.window_state[state] = self.window_state[up]
            elif self.length[state] >= self.window:
                self.window_state[state] = state
            own = sorted(whole.get(state, {}).items(), reverse=True)
            if own or up in self.ends:
                self.ends[state] = own + self.ends.get(up, [])
        self.owners = {state: owners[state] for state in set(self.window_state) if state in owners}

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint spans of words inside occurrences of windows, and the items that own the windows."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        cut = np.flatnonzero(ids < 0)
        starts = np.concatenate(([0], cut + 1))
        stops = np.concatenate((cut, [len(ids)]))
        long = stops - starts >= self.shortest
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        for start, stop in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            self._stream(ids[start:stop].tolist(), start, spans, names)
        return spans, names

    def _stream(self, ids: list[int], at: int, spans: list, names: set[str]) -> None:
        """Matching lengths of one run of known words."""
        moves, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        seen: set[int] = set()
        for end, word in enumerate(ids, at + 1):
            to = moves[state].get(word)
            if to is None:
                while to is None and state:
                    state = link[state]
                    to = moves[state].get(word)
                matched = length[state]
            state, matched = to or 0, matched + 1
            covered = 0
            if matched >= window:
                covered = window
                seen.add(self.window_state[state])
            for size, owners in self.ends.get(state, ()):
                if size <= matched:
                    covered = max(covered, size)
                    names |= owners
            if covered:
                first = end - covered
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, end))
        for found in seen:
            names |= self.owners[found]


def _blocks(benchmark: DataFrame, id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks that a driver and a worker can hold, one after the other."""
    items = stored(
        benchmark.select(
            F.coalesce(F.col(id).cast("string"), F.lit("")).alias("name"), text_or_empty(text).alias("text")
        ),
        "items",
    )
    size = items.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = -(-size // block_bytes)
    for part in range(parts):
        block = items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(parts)) == part)
        yield [(row["name"], words_of(row["text"].encode())) for row in block.collect()]


def _found(docs: DataFrame, text: str, automaton: ItemAutomaton) -> DataFrame:
    """``docs`` with its text and ``_words``, ``_spans`` (starts and ends in turn) and ``_items``."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    schema = docs.select("*", F.lit(0).alias("_words")).schema
    schema = schema.add("_spans", ArrayType(IntegerType())).add("_items", ArrayType(StringType()))

    def match(batches):
        items = shared.value
        for batch in batches:
            column = batch.column(text)
            counts, spans, names = [], [], []
            for i in range(len(batch)):
                words = words_of(blob(column, i) if column[i].is_valid else b"")
                where, which = items.hits(words)
                counts.append(len(words))
                spans.append([edge for span in where for edge in span])
                names.append(sorted(which))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int32()), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(names, pa.list_(pa.string()))],
                names=[*batch.schema.names, "_words", "_spans", "_items"],
            )

    return docs.mapInArrow(match, schema)


def _merged(spans: list[int]) -> list[int]:
    """Union of spans given as starts and ends in turn."""
    out: list[int] = []
    for first, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and out[-1] >= first:
            out[-1] = max(out[-1], end)
        else:
            out += [first, end]
    return out


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document the id, ``n_words``, ``spans`` (hit words, starts and ends in turn) and ``items`` (sorted ids)."""
    automata = (ItemAutomaton(block, window) for block in _blocks(benchmark, item_id, item_text, block_bytes))
    rows = docs.select(F.col(id).alias("_id"), text_or_empty(text).alias("_text"))
    first = next(automata, None) or ItemAutomaton([], window)
    second = next(automata, None)
    if second is None:
        found = _found(rows, "_text", first).drop("_text")
    else:
        rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        parts = [stored(_found(rows, "_text", one).drop("_text"), "found") for one in (first, second)]
        parts += [stored(_found(rows, "_text", one).drop("_text"), "found") for one in automata]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        found = every.groupBy("_row").agg(
            F.first("_id").alias("_id"),
            F.first("_words").alias("_words"),
            F.flatten(F.collect_list("_spans")).alias("_spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"),
        )

        def merge(batches):
            for batch in batches:
                spans = pa.array(map(_merged, batch.column("_spans").to_pylist()), pa.list_(pa.int32()))
                yield batch.set_column(batch.schema.get_field_index("_spans"), "_spans", spans)

        found = found.mapInArrow(merge, found.schema)
    return found.select(
        F.col("_id").alias(id), F.col("_words").cast("bigint").alias("n_words"),
        F.col("_spans").alias("spans"), F.col("_items").alias("items"),
    )


def match_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Counts per document: hit words, items, a digest of the items, and whether anything was hit."""
    found = matches(docs, benchmark, **options)
    width = F.transform("spans", lambda edge, i: F.when(i % 2 == 1, edge).otherwise(-edge))
    hit = F.aggregate(width, F.lit(0).cast("bigint"), lambda total, edge: total + edge)
    return found.select(
        options.get("id", "doc_id"), "n_words", hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _cleaned(text: bytes, items: ItemAutomaton, total: int, lost: int, most: float) -> tuple[bytes | None, int, int]:
    """The text without hit words, or None when they are too large a share of the ``total``; words and lost words.

    Cutting brings words together that were apart, so this goes on until nothing is hit.
    """
    while True:
        places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
        total = total or len(places)
        spans, _ = items.hits([text[a:b].translate(_LOWER) for a, b in places])
        if not spans:
            return text, total, lost
        lost += sum(end - first for first, end in spans)
        if lost > most * total:
            return None, total, lost
        text = _without(text, places, spans)


def _without(text: bytes, places: list[tuple[int, int]], spans: Iterable[tuple[int, int]]) -> bytes:
    """The text without disjoint spans of its words, which lie at ``places``."""
    kept, upto = [], 0
    for first, end in spans:
        kept.append(text[upto : places[first][0]])
        upto = places[end - 1][1]
    return b"".join([*kept, text[upto:]])


def _cut(rows: DataFrame, text: str, items: ItemAutomaton, most: float) -> DataFrame:
    """``rows``, which end in ``_total`` and ``_lost``, without what the items of the only block hit."""
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def clean(batches):
        items = shared.value
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column, out = batch.column(at), []
            totals, losses = batch.column("_total").to_pylist(), batch.column("_lost").to_pylist()
            keep = []
            for i in range(len(batch)):
                whole = blob(column, i) if column[i].is_valid else None
                rest = whole
                if whole:
                    rest, totals[i], losses[i] = _cleaned(whole, items, totals[i], losses[i], most)
                keep.append(rest is not None or whole is None)
                out.append(None if rest is None else rest.decode())
            columns = [*batch.columns[:-2], pa.array(totals, pa.int64()), pa.array(losses, pa.int64())]
            columns[at] = pa.array(out, column.type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(clean, rows.schema)


def _cut_spans(rows: DataFrame, text: str, most: float) -> DataFrame:
    """``rows``, which end in ``_total``, ``_lost`` and the ``_spans`` of all blocks, with these cut out once."""

    def clean(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column, out, keep = batch.column(at), [], []
            totals, losses = batch.column("_total").to_pylist(), batch.column("_lost").to_pylist()
            for i, found in enumerate(batch.column("_spans").to_pylist()):
                whole, edges = blob(column, i), _merged(found)
                spans = list(zip(edges[::2], edges[1::2], strict=True))
                places = [m.span() for m in _WORD.finditer(whole.translate(_LOWER))]
                totals[i] = totals[i] or len(places)
                losses[i] += sum(end - first for first, end in spans)
                keep.append(losses[i] <= most * totals[i])
                out.append(_without(whole, places, spans).decode() if keep[-1] else None)
            columns = [*batch.columns[:-3], pa.array(totals, pa.int64()), pa.array(losses, pa.int64())]
            columns[at] = pa.array(out, column.type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(clean, rows.drop("_spans").schema)


def _block_spans(rows: DataFrame, text: str, automata: Iterable[ItemAutomaton]) -> DataFrame:
    """``(_row, _spans)`` of the rows that any block hits; a worker holds the automaton of one block at a time."""
    texts, every = rows.select("_row", text), None
    for one in automata:
        part = _found(texts, text, one).filter(F.size("_spans") > 0).select("_row", "_spans")
        part = stored(part, "found")
        every = part if every is None else every.unionByName(part)
    return stored(every.groupBy("_row").agg(F.flatten(F.collect_list("_spans")).alias("_spans")), "spans")


@other_columns_aside
def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    max_coverage: float = 0.5,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with hit spans cut out of ``text``; documents that lose more than ``max_coverage`` of their words go.

    Clean rows pass unchanged. With several blocks a round finds the spans of all of them on the same texts, one
    block after the other, and cuts their union once; texts that were cut go through further rounds until nothing
    is hit. So the result does not depend on the blocks.
    """
    zero = F.lit(0).cast("bigint")
    rows = docs.select("*", zero.alias("_total"), zero.alias("_lost"))

    def automata():
        return (ItemAutomaton(block, window) for block in _blocks(benchmark, item_id, item_text, block_bytes))

    blocks = automata()
    first = next(blocks, None) or ItemAutomaton([], window)
    second = next(blocks, None)
    if second is None:
        return _cut(rows, text, first, max_coverage).drop("_total", "_lost")
    rows = docs.select("*", F.monotonically_increasing_id().alias("_row"), zero.alias("_total"), zero.alias("_lost"))
    rows, blocks, clean = stored(rows, "numbered"), chain((first, second), blocks), None
    while True:
        spans = _block_spans(rows, text, blocks)
        rest = rows.join(spans, "_row", "left_anti").select(*rows.columns)
        clean = rest if clean is None else clean.unionByName(rest)
        if spans.isEmpty():
            return clean.select(*docs.columns)
        hit = rows.join(spans, "_row").select(*rows.columns, "_spans")
        rows, blocks = stored(_cut_spans(hit, text, max_coverage), "cut"), automata()
