"""Removal of repeated passages by external induced sorting of suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts somewhere else. What is needed of a
suffix array is the longest common prefix of neighbours, up to ``length`` bytes, at every place where a
repeat may start. It is built from a sample of suffixes, and the others are induced from the sample:

1. Anchors. Every string of ``length`` bytes names one place in it, the smallest hash of ``GRAM`` bytes. Equal
   strings name the same place, so starts of equal strings share an anchor with equal bytes at equal
   distance. Anchors whose bytes occur once are dropped; they start no repeat.
2. Sample. For anchors with equal bytes, the text around them goes to one shard. Their suffixes are sorted
   by Spark's external sort, whose spilled runs are merged through a priority queue, and get the length of
   the common prefix with their neighbour.
3. Induction. The suffix one byte further left is the tuple of that byte and the rank of the suffix behind
   it. So the order of the suffixes at distance ``a + 1`` comes out of that at distance ``a`` by a stable sort by
   one byte, and common prefixes grow by one, with minima over what a byte has separated. A start is a repeat
   where a neighbour shares ``length`` bytes. This goes on leftward until no suffix has a neighbour.
4. Recursion. A shard with many different surroundings of one anchor, such as the rim of a very common
   passage, is divided by distance from the anchor and by the bytes that all starts at these distances
   share, and sorted again in parts; at single distances equal strings are one and the parts end.

Equal surroundings are counted before they move and are sorted once. Texts move twice, in the second case
only those with candidates.

Stretches of a short period (dashes, blanks, one character for megabytes) name an anchor at nearly every byte. There
every start equals the one a period further, so the stretch is one span, found where the text is read, and only
the starts of its first period, which hold every string of the stretch, look for others elsewhere.

Defined results
    * A null text counts as empty. Texts shorter than ``length`` lose nothing.
    * Rows that repeat id and text are repeats of each other as a whole.
    * Matches within a document count, and may overlap. They never cross documents.
    * An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import blob, stored, text_or_empty

LENGTH = 400
GRAM = 48
#: Different surroundings of one anchor that are sorted together; more are divided.
SHARD = 1000
#: Distances from the anchor in a part, at each depth of the recursion.
WIDTHS = (32, 4, 1)

#: Bytes between the places at which stretches of a short period are looked for.
PROBE = 128

_PIECE = 1 << 20
_LOAD_BYTES = 1 << 24
_MULTIPLIER, _MIXER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BATCH_ROWS = 20_000


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all strings of ``GRAM`` bytes: those of 1, 2, 4, ... bytes are put together."""
    parts, size, grown, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    power, left = _MULTIPLIER, GRAM
    while left:
        if left & size:
            end = len(data) - done - size + 1
            grown = parts[: end] if grown is None else grown[:end] * power + parts[done : done + end]
            done += size
            left -= size
        if left:
            parts = parts[:-size] * power + parts[size:]
            power = np.uint64((int(power) ** 2 + 2) % (1 << 64))
            size *= 2
    grown = (grown ^ (grown >> np.uint64(29))) * _MIXER
    return grown ^ (grown >> np.uint64(32))


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _agreement(data: np.ndarray, at: int, period: int, stop: int) -> int:
    """First place from ``at`` on whose byte differs from that a period further, which is before ``stop``."""
    step = 1 << 10
    while at + period < stop:
        upto = min(at + step, stop - period)
        other = data[at:upto] != data[at + period : upto + period]
        if other.any():
            return at + int(other.argmax())
        at, step = upto, step * 2
    return stop - period


def periodic_stretches(data: np.ndarray, hashes: np.ndarray, ends: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """``(begin, end, period)`` of stretches of joined texts in which every start repeats a period further or nearer.

    Periods are at most ``length``. Proposals are places with the hash of a probe; bytes decide. A stretch of fewer
    than ``PROBE + length + period`` bytes may be passed over.
    """
    if len(hashes) <= length:
        return []
    ahead = np.lib.stride_tricks.sliding_window_view(hashes[1:], length)[::PROBE]
    equal = ahead == hashes[: len(hashes) - length : PROBE, None]
    text, out, done = data.tobytes(), [], 0
    for probe in np.flatnonzero(equal.any(1)).tolist():
        at = probe * PROBE
        if at < done:
            continue
        part = int(np.searchsorted(ends, at, "right"))
        start, stop = int(ends[part - 1]) if part else 0, int(ends[part])
        for period in (np.flatnonzero(equal[probe]) + 1).tolist():
            if at + period + length > stop:
                break
            if text[at : at + length] != text[at + period : at + period + length]:
                continue
            end = _agreement(data, at, period, stop) + period
            back = data[start:stop][::-1]
            begin = stop - _agreement(back, stop - at - period, period, stop - start) - period
            if end - begin >= length + 2 * period:
                out.append((begin, end, period))
                done = end - length
                break
    return out


def anchors(data: np.ndarray, ends: np.ndarray, length: int, stretches: list | None = None) -> tuple[np.ndarray, ...]:
    """Anchors of joined texts that end at ``ends``: place, hash, and first and last start that name it.

    With a list of ``stretches``, periodic ones are added to it, and their starts beyond the first period name none.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty.astype(np.uint64), empty, empty
    hashes = _gram_hashes(data)
    low = np.uint64(_PIECE * 2 - 1)
    minima = _window_minima((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - GRAM + 1)
    starts = np.arange(len(minima))
    open_ = ends[np.searchsorted(ends, starts, "right")] >= starts + length
    if stretches is not None:
        stretches += periodic_stretches(data, hashes, ends, length)
        for begin, end, period in stretches:
            open_[begin + period : end - length + 1] = False
    starts = starts[open_]
    if not len(starts):
        return empty, empty.astype(np.uint64), empty, empty
    place = (minima[starts] & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
    last = np.r_[first[1:], len(starts)] - 1
    return place[first], hashes[place[first]], starts[first], starts[last]


def _pieces(texts: list[bytes], length: int, piece: int | None = None) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, or overlapping parts of very long ones, in loads of a bounded size: row, offset and bytes.

    Every start lies in one part: two anchors of one start would make it a repeat of itself.
    """
    piece = piece or _PIECE
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - length + 1), piece - length + 1):
            part = text[begin : begin + piece]
            if size + len(part) > piece and parts:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
            rows.append(row)
            offsets.append(begin)
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, offsets, parts


def _key(id: str, text: str) -> Column:
    """Names a row by its id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"), text_or_empty(text))))


def _anchor_table(rows: DataFrame, length: int, piece: int) -> DataFrame:
    """``(key, gram, place, first, last)`` of every anchor, places within the text.

    Rows without ``gram`` are periodic stretches, from ``first`` to before ``last``.
    """

    def find(batches):
        for batch in batches:
            column, keys = batch.column("text"), batch.column("key")
            texts = [blob(column, i) for i in range(len(batch))]
            for own, offsets, parts in _pieces(texts, length, piece):
                sizes = np.array([len(part) for part in parts])
                ends = np.cumsum(sizes)
                stretches: list[tuple[int, int, int]] = []
                place, gram, first, last = anchors(np.frombuffer(b"".join(parts), np.uint8), ends, length, stretches)
                begins, stops = (np.array([one[i] for one in stretches], np.int64) for i in (0, 1))
                place, first, last = np.r_[place, begins], np.r_[first, begins], np.r_[last, stops]
                gram = np.r_[gram.view(np.int64), np.zeros(len(begins), np.int64)]
                part = np.searchsorted(ends, first, "right")
                shift = np.array(offsets)[part] - (ends - sizes)[part]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(np.array(own)[part])),
                     pa.array(gram, mask=np.arange(len(gram)) >= len(gram) - len(begins)),
                     *[pa.array((x + shift).astype(np.int32)) for x in (place, first, last)]],
                    ["key", "gram", "place", "first", "last"],
                )

    return rows.mapInArrow(find, "key binary, gram bigint, place int, first int, last int")


def _surroundings(candidates: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """The text that the starts of an anchor cover. ``cid`` names equal surroundings, ``back`` is the distance
    from their begin to the anchor, ``at`` their place in the text."""
    schema = "gram bigint, cid binary, back int, " + ("around binary" if with_bytes else "key binary, at int")

    def cut(batches):
        for batch in batches:
            column, keys, out, held = batch.column("text"), batch.column("key").to_pylist(), [], 0
            lists = batch.column("anchors")
            for i, key in enumerate(keys):
                text, found = blob(column, i), lists[i].values
                for begin in range(0, len(found), _BATCH_ROWS):
                    for one in found.slice(begin, _BATCH_ROWS).to_pylist():
                        back, at = one["place"] - one["first"], one["first"]
                        around = text[at : one["last"] + length]
                        cid = hashlib.md5(around + back.to_bytes(4, "little")).digest()
                        out.append((one["gram"], cid, back, *((around,) if with_bytes else (key, at))))
                        held += len(around)
                    if held > _LOAD_BYTES:
                        yield _batch(out, schema)
                        out, held = [], 0
            yield _batch(out, schema)

    return candidates.mapInArrow(cut, schema)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def _padded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix, and their lengths."""
    sizes = np.array([len(x) for x in parts])
    wide = int(sizes.max(initial=0))
    return np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in parts), np.uint8).reshape(len(parts), wide), sizes


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low + 1 : high + 1]`` for each pair."""
    out = values[high]
    far = np.flatnonzero(high - low > 1)
    if len(far):
        bounds = np.column_stack((low[far] + 1, high[far] + 1)).ravel()
        out[far] = np.minimum.reduceat(np.r_[values, 0], bounds)[::2]
    return out


def induced_repeats(
    shard: np.ndarray, right: list[bytes], left: list[bytes], spare: np.ndarray, length: int
) -> list[np.ndarray]:
    """Per sampled suffix, whether the starts 0, 1, 2, ... bytes left of its anchor repeat.

    Suffixes come sorted by ``shard`` and ``right``, the bytes from the anchor on. ``left`` are the bytes before
    the anchor, nearest first. Starts nearer than ``spare`` belong to other anchors and do not count.
    """
    ahead, reach = _padded(right)
    behind, depth = _padded(left)
    repeats = np.zeros((len(right), behind.shape[1] + 1), bool)
    same = ahead[1:] == ahead[:-1]
    common = np.where(same.all(1), ahead.shape[1], np.argmin(same, 1)) if same.shape[1] else np.zeros(len(same), int)
    common = np.r_[-1, np.minimum(common, np.minimum(reach[1:], reach[:-1]))]
    common[1:][shard[1:] != shard[:-1]] = -1  # a suffix without a neighbour before it
    suffix, group = np.arange(len(right)), shard
    for distance in range(behind.shape[1] + 1):
        # Suffixes that stand alone have no repeat here or further left.
        paired = np.r_[common[1:] >= 0, False] | (common >= 0)
        if not paired.any():
            break
        long = common >= length
        long |= np.r_[long[1:], False]
        repeats[suffix[long], distance] = True
        live = np.flatnonzero(paired & (depth[suffix] > distance))
        if not len(live):
            break
        byte = behind[suffix[live], distance].astype(np.int64)
        tuples = group[live] * 256 + byte
        order = np.argsort(tuples, kind="stable") if (tuples[1:] < tuples[:-1]).any() else np.arange(len(live))
        tuples, kept = tuples[order], live[order]
        joined = np.r_[False, tuples[1:] == tuples[:-1]]
        grown = np.full(len(kept), -1)
        at = np.flatnonzero(joined)
        grown[at] = _least_between(common, kept[at - 1], kept[at]) + 1
        suffix, common, group = suffix[kept], grown, np.cumsum(~joined)
    return [row[: d + 1] & (np.arange(d + 1) >= s) for row, d, s in zip(repeats, depth, spare, strict=True)]


def _repeated_starts(shards: DataFrame, length: int) -> DataFrame:
    """``(cid, begin, end)``: runs of repeated starts, counted from the begin of the surroundings."""
    schema = "cid binary, begin int, end int"

    def whole_groups(batches):
        """Rows of complete shards, in loads."""
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= _BATCH_ROWS and row["gram"] != held[-1]["gram"]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def induce(batches):
        for rows in whole_groups(batches):
            gram = np.array([row["gram"] for row in rows])
            shard = np.cumsum(np.r_[False, gram[1:] != gram[:-1]])
            backs = [row["back"] for row in rows]
            left = [row["around"][back - 1 :: -1] if back else b"" for row, back in zip(rows, backs, strict=True)]
            right = [row["around"][back:] for row, back in zip(rows, backs, strict=True)]
            spare = np.array([back - (len(row["around"]) - length) for row, back in zip(rows, backs, strict=True)])
            found = induced_repeats(shard, right, left, spare, length)
            out = []
            for row, back, far in zip(rows, backs, found, strict=True):
                size = len(row["around"]) - length + 1
                starts = np.ones(size, bool) if row["n"] > 1 else far[::-1][:size]
                edge = np.flatnonzero(np.diff(np.r_[False, starts, False].astype(np.int8))).reshape(-1, 2)
                out += [(row["cid"], begin, end) for begin, end in edge.tolist()]
            yield _batch(out, schema)

    return shards.mapInArrow(induce, schema)


def _divided(shards: DataFrame, width: int, length: int) -> DataFrame:
    """Surroundings cut by distance from the anchor, keyed by the bytes that all starts of a part share."""
    schema = "gram bigint, cid binary, back int, around binary, n bigint, whole binary, shift int"

    def divide(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                around, back = row["around"], row["back"]
                nearest = back - (len(around) - length)
                for block in range(nearest // width, back // width + 1):
                    far, near = min(back, block * width + width - 1), max(nearest, block * width)
                    part = around[back - far : back - near + length]
                    core = around[back - block * width : back - block * width + length - width + 1]
                    name = hashlib.md5(core + row["gram"].to_bytes(8, "little", signed=True) + block.to_bytes(4, "little"))
                    cid = hashlib.md5(name.digest() + part + far.to_bytes(4, "little")).digest()
                    gram = int.from_bytes(name.digest()[:8], "little", signed=True)
                    out.append((gram, cid, far, part, row["n"], row["cid"], back - far))
            yield _batch(out, schema)

    return shards.mapInArrow(divide, schema)


def _distinct(rows: DataFrame, n: Column) -> DataFrame:
    """Equal surroundings as one row with the number of their places."""
    return rows.groupBy("gram", "cid").agg(
        F.first("back").alias("back"), F.first("around").alias("around"), F.sum(n).alias("n")
    )


def repeated_spans(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, shard: int = SHARD, piece: int = _PIECE
):
    """``(spans, candidates)``: runs ``(key, begin, end)`` of bytes that repeat, not merged, and the texts that may
    hold some as ``(key, text)``. ``key`` names a row by its id and text."""
    rows = docs.select(_key(id, text).alias("key"), text_or_empty(text).alias("text"))
    found = stored(_anchor_table(rows, length, piece), "anchors")
    stretches, named = found.filter("gram is null"), found.filter("gram is not null")
    repeated = stored(named.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "grams")
    near = stored(named.join(repeated, "gram", "left_semi").unionByName(stretches), "repeated-anchors")
    one = F.when(F.col("gram").isNotNull(), F.struct("gram", "place", "first", "last"))
    lists = stored(near.groupBy("key").agg(F.collect_set(one).alias("anchors")), "lists")
    candidates = stored(rows.join(lists, "key"), "candidates")
    places = stored(_surroundings(candidates, length, False).select("cid", "key", "at"), "places")
    shards = stored(_distinct(_surroundings(candidates, length, True), F.lit(1)), "shards")
    spans = stretches.select("key", F.col("first").alias("begin"), F.col("last").alias("end"))
    for width in (*WIDTHS, None):
        large = shards.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > shard).select("gram")
        large = stored(large, "large")
        rest = None if width is None or large.isEmpty() else shards.join(large, "gram", "left_semi")
        plain = shards if rest is None else shards.join(large, "gram", "left_anti")
        ahead = F.expr("substring(around, back + 1)")
        ordered = plain.repartition("gram").sortWithinPartitions("gram", ahead)
        starts = stored(_repeated_starts(ordered, length), "starts")
        own = places.join(starts, "cid").select(
            "key", (F.col("at") + F.col("begin")).alias("begin"), (F.col("at") + F.col("end") + length - 1).alias("end")
        )
        spans = spans.unionByName(stored(own, "spans"))
        if rest is None:
            break
        divided = stored(_divided(stored(rest, "rest"), width, length), "divided")
        moved = divided.select(F.col("whole").alias("cid"), F.col("cid").alias("part"), "shift")
        places = places.join(moved, "cid").select(
            F.col("part").alias("cid"), "key", (F.col("at") + F.col("shift")).alias("at")
        )
        places = stored(places, "places")
        shards = stored(_distinct(divided, F.col("n")), "shards")
    return spans, candidates.select("key", "text")


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """Text without the spans, the bytes and the maximal runs that were removed."""
    kept, upto, removed, runs = [], 0, 0, 0
    for begin, end in sorted(spans):
        if begin > upto or not runs:
            kept.append(text[upto:begin])
            runs += 1
            upto = begin
        if end > upto:
            removed += end - upto
            upto = end
    return b"".join([*kept, text[upto:]]), removed, runs


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, shard: int = SHARD, piece: int = _PIECE
) -> DataFrame:
    """Per input row the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``.

    ``kept`` holds the remaining bytes, which need not be valid UTF-8, of rows that lost some, and is null elsewhere.
    """
    whole = text_or_empty(text)
    base = stored(
        docs.select(
            F.col(id).alias("id"), _key(id, text).alias("key"),
            F.octet_length(whole).cast("bigint").alias("n_bytes"), F.sha2(whole, 256).alias("sha"),
        ),
        "rows",
    )
    copies = stored(base.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "copies")
    spans, candidates = repeated_spans(docs, id, text, length, shard, piece)
    runs = spans.groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    texts = candidates.dropDuplicates(["key"]).join(stored(runs, "runs"), "key")

    def cut(batches):
        for batch in batches:
            column, keys, out = batch.column("text"), batch.column("key").to_pylist(), []
            for i, own in enumerate(batch.column("spans").to_pylist()):
                rest, removed, count = _cut(blob(column, i), [(one["begin"], one["end"]) for one in own])
                out.append((keys[i], removed, count, rest))
            yield _batch(out, "key binary, n_removed bigint, n_spans bigint, kept binary")

    done = stored(texts.mapInArrow(cut, "key binary, n_removed bigint, n_spans bigint, kept binary"), "cut")
    again = copies.select("key", F.lit(True).alias("again"))
    # Rows that repeat id and text: everything goes, whatever else is known of them.
    all_of_it = F.coalesce("again", F.lit(False)) & (F.col("n_bytes") >= length)
    joined = base.join(done, "key", "left").join(again, "key", "left")
    return joined.select(
        F.col("id").alias(id), "n_bytes",
        F.when(all_of_it, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_of_it, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(all_of_it, F.sha2(F.lit(b""), 256)).when(F.col("kept").isNotNull(), F.sha2("kept", 256))
        .otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(all_of_it, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
