"""Runs of repeated words: periods are proposed by a dictionary of basic factors, then extended and deduplicated.

A run is a stretch of consecutive words with smallest period ``p`` that holds at least two periods and ``least``
words, and that no neighbouring word extends under that period. Texts are independent of each other, so the whole
work is one narrow pass; inside a task it is done in arrays over loads of texts.

1. Dictionary of basic factors. For each power of two ``m`` the factors of ``m`` words get names: equal names
   within a text mean equal words. The name of ``2 m`` words at ``i`` comes from those of ``m`` words at ``i`` and
   ``i + m`` by a sort of pairs, so names are exact. Factors that occur once in their text have no equal beyond, and
   drop out of all longer lengths.
2. Progressions. Places of one factor that follow each other within ``m / 2`` lie at one constant distance, the
   factor's own period, and form an arithmetic progression. Within twice the length there are at most a few.
3. Proposals. A run with a period ``p`` from ``m`` to ``2 m - 1`` repeats the factor at its start ``p`` words later.
   That place is the first one of a later progression, or else both progressions end inside the run, and their
   last places are ``p`` apart. So each place proposes its distance to the first places of the progressions that
   follow within ``2 m``, and each progression the distance between last places. Both are few for each place.
4. Extension. Proposals of one distance that touch are one; they are extended word by word to both sides in blocks.
   Stretches that are too short for their period fall out. Of equal stretches the smallest period stays: a
   stretch that has a period and holds two of it has the multiples as well.

Defined results
    * A null text, an empty one and one of white space alone have no words and no runs; ``collapsed`` is empty.
    * Ties, repeated rows and null ids need nothing: there is one result per input row, whatever its id.
    * A very long text is a load of its own; memory grows with it, in proportion, and not with its runs.
    * An empty table gives an empty result. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import blob, text_or_empty

LEAST = 12
_LOAD_BYTES = 4 << 20
_CELLS = 1 << 21
_WIDEST = 4096


def _chunks(size: int, width: int) -> Iterator[slice]:
    step = max(1, _CELLS // width)
    for begin in range(0, size, step):
        yield slice(begin, begin + step)


def _merged(period: np.ndarray, begin: np.ndarray, end: np.ndarray, reach: int = 0) -> tuple[np.ndarray, ...]:
    """Stretches of one period that overlap, touch or lie within ``reach`` as one."""
    order = np.lexsort((begin, period))
    period, begin, end = period[order], begin[order], end[order]
    if not len(period):
        return period, begin, end
    # Ends are comparable across periods once each period has a range of its own.
    span = int(end.max()) + reach + 1
    base = np.cumsum(np.r_[False, period[1:] != period[:-1]]) * span
    furthest = np.maximum.accumulate(end + base)
    fresh = np.flatnonzero(np.r_[True, (begin + base)[1:] > furthest[:-1] + reach])
    return period[fresh], begin[fresh], (furthest - base)[np.r_[fresh[1:], len(period)] - 1]


def _grown(words: np.ndarray, at: np.ndarray, period: np.ndarray, bound: np.ndarray, step: int, width: int, once: bool):
    """Places reached from ``at`` (``step`` 1 or -1) while the word equals the one a period later."""
    at, live = at.copy(), np.arange(len(at))
    while len(live):
        going = []
        for part in _chunks(len(live), width):
            own = live[part]
            place = at[own, None] + step * np.arange(width)
            inside = place < bound[own, None] if step > 0 else place >= bound[own, None]
            place = np.where(inside, place, 0)
            same = inside & (words[place] == words[np.where(inside, place + period[own, None], 0)])
            whole = same.all(1)
            at[own] += step * np.where(whole, width, np.argmin(same, 1))
            going.append(own[whole])
        if once:
            break
        live, width = np.concatenate(going), min(width * 2, _WIDEST)
    return at


def _stretches(words, starts, ends, owner, period, begin, size: int) -> tuple[np.ndarray, ...]:
    """Maximal stretches whose words equal those a period later, around proposals of ``size`` equal words."""
    period, begin, end = _merged(period, begin, begin + size)
    bound = ends[owner[begin]] - period
    # As far as the next proposal of the same stretch, then all of it.
    period, begin, end = _merged(period, begin, _grown(words, end, period, bound, 1, 2 * size, True))
    bound = ends[owner[begin]] - period
    period, begin, end = _merged(period, begin, _grown(words, end, period, bound, 1, 16, False))
    begin = _grown(words, begin - 1, period, starts[owner[begin]], -1, 16, False) + 1
    return _merged(period, begin, end)


def _proposals(place: np.ndarray, name: np.ndarray, size: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """``(begin, period)`` with periods from ``low`` to ``2 * size - 1``, from places sorted by name and place."""
    gap, same = np.diff(place), name[1:] == name[:-1]
    linked = same & (gap <= size // 2)
    of = np.cumsum(np.r_[True, ~linked]) - 1
    head = np.flatnonzero(np.r_[True, ~linked])
    first, last, names = place[head], place[np.r_[head[1:], len(place)] - 1], name[head]
    begins, periods = [], []

    def propose(begin, period):
        fit = (period >= low) & (period < 2 * size)
        begins.append(begin[fit])
        periods.append(period[fit])

    inner = head[np.r_[linked, False][head]]
    propose(place[inner], gap[inner] if len(inner) else inner)
    live = np.arange(len(place))
    ahead = 1
    while len(live):
        live = live[of[live] + ahead < len(head)]
        later = of[live] + ahead
        near = (names[later] == name[live]) & (first[later] - place[live] < 2 * size)
        live, later = live[near], later[near]
        propose(place[live], first[later] - place[live])
        tail = place[live] == last[of[live]]
        propose(place[live[tail]], last[later[tail]] - place[live[tail]])
        ahead += 1
    return np.concatenate(begins), np.concatenate(periods)


def periodic_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """``(begin, end, period)`` of all runs in joined texts that end at ``ends``, sorted by begin and period.

    ``words`` are numbers, equal for equal words. Begin and end are places in the joined texts.
    """
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    owner = np.repeat(np.arange(len(ends)), ends - starts)
    # With 12 words at least, factors of four words already propose all periods up to seven.
    lowest = 4 if least >= 12 else 1
    found = [np.zeros((3, 0), np.int64)]
    place, name, size = np.arange(len(words)), words.astype(np.int64), 1
    names = np.full(len(words) + 1, -1)
    while len(place):
        order = np.lexsort((place, name, owner[place])) if size == 1 else np.argsort(name, kind="stable")
        place, name = place[order], name[order]
        fresh = np.r_[True, (name[1:] != name[:-1]) | (owner[place[1:]] != owner[place[:-1]])]
        alone = fresh & np.r_[fresh[1:], True]
        name = np.cumsum(fresh)[~alone]
        place = place[~alone]
        if not len(place):
            break
        if size >= lowest:
            begin, period = _proposals(place, name, size, 1 if size == lowest else size)
            if len(begin):
                period, begin, end = _stretches(words, starts, ends, owner, period, begin, size)
                whole = end - begin >= np.maximum(period, least - period)
                found.append(np.stack([begin, end + period, period])[:, whole])
        names[:] = -1
        names[place] = name
        place = np.sort(place)
        place = place[place + 2 * size <= ends[owner[place]]]
        second = names[place + size]
        place, second = place[second >= 0], second[second >= 0]
        name = names[place] << 32 | second
        size *= 2
    begin, end, period = np.concatenate(found, 1)
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    smallest = np.r_[True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])][: len(begin)]
    begin, end, period = begin[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def _loads(column: pa.Array) -> Iterator[list[bytes]]:
    held, size = [], 0
    for i in range(len(column)):
        text = blob(column, i)
        if held and size + len(text) > _LOAD_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _of_load(texts: list[bytes], least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    split = [text.split() for text in texts]  # of bytes: exactly U+0020 and U+0009 to U+000D
    sizes = np.array([len(words) for words in split], np.int64)
    ends = np.cumsum(sizes)
    flat = [word for words in split for word in words]
    words = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    begin, end, period = periodic_runs(words, ends, least)
    owner = np.searchsorted(ends, begin, "right")
    dropped = np.zeros(len(flat) + 1, np.int64)
    np.add.at(dropped, begin + period, 1)
    np.add.at(dropped, end, -1)
    kept = np.cumsum(dropped)[:-1] == 0
    count = np.bincount(owner, minlength=len(texts))
    collapsed = []
    for i, own in enumerate(split):
        if count[i]:
            keep = kept[ends[i] - sizes[i] : ends[i]]
            own = [own[j] for j in np.flatnonzero(keep).tolist()]
        collapsed.append(b" ".join(own))
    run = pa.StructArray.from_arrays(
        [pa.array(begin - (ends - sizes)[owner]), pa.array(end - begin), pa.array(period)], ["start", "length", "period"]
    )
    runs = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), run)
    return pa.array(sizes), runs, pa.array(collapsed, pa.string())


def find_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Per input row the id, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` are ``(start, length, period)`` in words, by start, then period. ``collapsed`` has the words that stay
    when each run keeps its first period only, joined by one space.
    """
    rows = docs.select(F.col(id).alias("id"), text_or_empty(text).alias("text"))

    def find(batches):
        for batch in batches:
            at = 0
            for texts in _loads(batch.column("text")):
                n, runs, collapsed = _of_load(texts, least)
                own = batch.column("id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([own, n, runs, collapsed], ["id", "n_words", "runs", "collapsed"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return rows.mapInArrow(find, schema).withColumnRenamed("id", id)


def collapse_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with each text collapsed; a text without runs, and a null one, stays as it is."""
    fields = docs.schema
    place = docs.columns.index(text)

    def collapse(batches):
        for batch in batches:
            at = 0
            for texts in _loads(batch.column(place)):
                own = batch.slice(at, len(texts))
                at += len(texts)
                _, runs, collapsed = _of_load(texts, least)
                has = pa.array(np.diff(runs.offsets.to_numpy()) > 0)
                column = pc.if_else(has, collapsed, own.column(place).cast(pa.string()))
                columns = [column if i == place else own.column(i) for i in range(own.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, own.schema.names)

    return docs.mapInArrow(collapse, fields)
