"""Near-duplicates by SimHash, linked through a hierarchical index in Gray order.

Texts become 64-bit fingerprints over word shingles. Equal fingerprints are one node. Of two fingerprints
that differ in at most ``distance`` bits, one of ``distance + 1`` blocks of bits is equal, so every
fingerprint is sent once for each block, keyed by its bits; what meets in a task is sorted by Gray rank
and joined through a forest of masked bit patterns (``gray_index``). Groups that are much larger than the
rest are sorted by Gray rank over all tasks, cut into chunks, and pairs of chunks whose common patterns
differ too much are dropped before their rows move. A task returns a spanning forest of the links that it
found, never all pairs; components are found over those edges.

Defined results
    * Null and empty texts, and texts without words, have fingerprint zero and are linked like any other.
    * A text of fewer words than a shingle is one shingle.
    * Repeated rows get the same fingerprint and component. Null ids never name a component unless it has
      no other.
    * An empty table gives an empty result. Other columns are not read by ``near_duplicates``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import blob, other_columns_aside, stored, text_or_empty
from titleloom.llm.components import components
from titleloom.llm.gray_index import GrayForest, gray_rank, unite
from titleloom.plans.sizing import gathered

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: A group is cut into chunks of this many fingerprints when it holds more than this, and more than twice the mean.
CHUNK = 1024

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK_BYTES = 1 << 22
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in blocks, so that a very long text is never held word by word."""
    begin = 0
    while begin < len(text):
        space = _SPACE.search(text, begin + _BLOCK_BYTES)
        end = space.start() if space else len(text)
        yield text[begin:end].translate(_LOWER).split()
        begin = end


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text: bits that are set in over half of its shingles' XXH64 values."""
    counts, total = np.zeros((8, 256), np.int64), 0
    hashed, last, words = xxhash.xxh64_intdigest, [], []
    for block in _word_blocks(text):
        words = last + block
        if len(words) >= shingle:
            line = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            edges = zip((ends - sizes)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
            values = np.array([hashed(line[a:b], SEED) for a, b in edges], "<u8")
            total += len(values)
            for place, column in enumerate(values.view(np.uint8).reshape(-1, 8).T):
                counts[place] += np.bincount(column, minlength=256)
        last = words[max(0, len(words) - shingle + 1) :]
    if not total:
        return hashed(b" ".join(words), SEED) if words else 0
    return int(_PLACES[(counts @ _BITS).ravel() * 2 > total].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, print)`` with the fingerprint as a signed 64-bit integer."""
    rows = docs.select(F.col(id).alias("id"), text_or_empty(text).alias("text"))

    def compute(batches):
        for batch in batches:
            column = batch.column("text")
            prints = np.array([simhash(blob(column, i), shingle) for i in range(len(batch))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], ["id", "print"])

    return rows.mapInArrow(compute, rows.select("id", F.lit(0).cast("bigint").alias("print")).schema)


def _blocks(distance: int) -> list[tuple[int, int]]:
    """First bit and width of each block, from the top."""
    parts = distance + 1
    edges = [64 * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _turned(code: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", code, bits).bitwiseOR(
        F.call_function("shiftrightunsigned", code, F.lit(64) - bits)
    )


def _views(prints: DataFrame, distance: int) -> DataFrame:
    """A row for each block: which one, its bits, and the code turned so that the block leads."""
    blocks = _blocks(distance)
    view = F.explode(F.array(*[F.struct(F.lit(i).alias("view"), F.lit(a).alias("turn"), F.lit(w).alias("width"))
                               for i, (a, w) in enumerate(blocks)]))
    rows = prints.select("print", view.alias("v")).select(
        "print", "v.view", "v.width", _turned(F.col("print"), F.col("v.turn")).alias("code")
    )
    lead = F.call_function("shiftrightunsigned", F.col("code"), F.lit(64) - F.col("width"))
    return rows.select("view", lead.alias("lead"), "code")


def _rank(code: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _placed(prints: DataFrame, distance: int, chunk: int) -> DataFrame:
    """Rows ``(view, lead, a, b, side, code)``: what is to be joined within, or between two chunks of, a group."""
    rows = _views(prints, distance)
    sizes = rows.groupBy("view", "lead").agg(F.count("*").alias("n"))
    sizes = stored(gathered(sizes, (distance + 1) * prints.count()), "groups")
    mean = sizes.agg(F.avg("n")).first()[0] or 0
    large = stored(sizes.filter(F.col("n") > max(chunk, 2 * mean)).select("view", "lead"), "large-groups")
    keys = ["view", "lead"]
    zero = F.lit(0).cast("bigint")
    plain = rows.join(large, keys, "left_anti") if not large.isEmpty() else rows
    plain = plain.select(*keys, zero.alias("a"), zero.alias("b"), F.lit(0).alias("side"), "code")
    if large.isEmpty():
        return plain
    inside = rows.join(large, keys, "left_semi").orderBy(*keys, _rank(F.col("code")))
    size = int(max(chunk, 2 * mean))
    inside = stored(
        inside.withColumn("chunk", F.floor(F.monotonically_increasing_id() / size)), "chunks"
    )
    nodes = inside.groupBy(*keys, "chunk").agg(F.bit_and("code").alias("low"), F.bit_or("code").alias("high"))
    nodes = stored(nodes.withColumn("mask", F.bitwise_not(F.col("low").bitwiseXOR(F.col("high")))), "chunk-nodes")
    other = nodes.select(*keys, *[F.col(c).alias(f"{c}_b") for c in ("chunk", "low", "mask")])
    differ = F.bit_count(F.col("low").bitwiseXOR(F.col("low_b")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask_b")))
    pairs = nodes.join(other, keys).filter((F.col("chunk") <= F.col("chunk_b")) & (differ <= distance))
    pairs = stored(pairs.select(*keys, F.col("chunk").alias("a"), F.col("chunk_b").alias("b")), "chunk-pairs")
    left = pairs.select(*keys, F.col("a").alias("chunk"), "a", "b", F.lit(0).alias("side"))
    right = pairs.filter("a <> b").select(*keys, F.col("b").alias("chunk"), "a", "b", F.lit(1).alias("side"))
    cut = inside.join(left.unionByName(right), [*keys, "chunk"])
    return plain.unionByName(cut.select(*keys, "a", "b", "side", "code"))


def _joined(batches, blocks: list[tuple[int, int]], distance: int):
    """Links within a task, as edges of a spanning forest."""
    parts = [batch for batch in batches if len(batch)]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    column = {name: table.column(name).to_numpy() for name in ("view", "lead", "a", "b", "side")}
    code = table.column("code").to_numpy().view(np.uint64)
    order = np.lexsort((gray_rank(code), *(column[name] for name in ("side", "b", "a", "lead", "view"))))
    column, code = {name: values[order] for name, values in column.items()}, code[order]
    change = np.zeros(len(code), bool)
    for name in ("view", "lead", "a", "b"):
        change[1:] |= column[name][1:] != column[name][:-1]
    group = np.cumsum(change)
    tree = np.cumsum(change | np.r_[False, column["side"][1:] != column["side"][:-1]])
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    within = column["a"][first] == column["b"][first]
    both = np.flatnonzero(group[first][:-1] == group[first][1:])
    own = np.flatnonzero(within)
    turn = np.array([a for a, _ in blocks], np.uint64)[column["view"]]
    plain = (code >> turn) | (code << ((np.uint64(64) - turn) % np.uint64(64)))
    prints, name = np.unique(plain.view(np.int64), return_inverse=True)
    parent = np.arange(len(prints))
    forest = GrayForest(code, tree)
    forest.join(np.r_[own, both], np.r_[own, both + 1], distance, lambda i, j: unite(parent, name[i], name[j]))
    child = np.flatnonzero(parent != np.arange(len(prints)))
    yield pa.RecordBatch.from_arrays([pa.array(prints[child]), pa.array(prints[parent[child]])], ["a", "b"])


def linked_prints(prints: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints of ``prints`` as their links do."""
    blocks = _blocks(distance)
    placed = _placed(prints, distance, chunk).repartition("view", "lead", "a", "b")
    return placed.mapInArrow(lambda batches: _joined(batches, blocks, distance), "a bigint, b bigint")


def _named_prints(
    docs: DataFrame, id: str, text: str, shingle: int, distance: int, chunk: int
) -> tuple[DataFrame, DataFrame, int]:
    """``(id, print)`` of the documents, ``(print, component_id)``, and the number of documents."""
    marked = stored(fingerprints(docs, id, text, shingle), "fingerprints")
    most = marked.count()
    nodes = stored(gathered(marked.groupBy("print").agg(F.min("id").alias("first")), most), "prints")
    roots = components(stored(linked_prints(nodes.select("print"), distance, chunk), "links"))
    rooted = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    rooted = stored(gathered(rooted, most), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    lowest = stored(gathered(lowest, most), "lowest")
    named = stored(gathered(rooted.join(lowest, "root").select("print", "component_id"), most), "components")
    return marked, named, most


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    chunk: int = CHUNK,
) -> DataFrame:
    """Per document the id, its ``fingerprint`` and ``component_id``, the smallest id that links reach."""
    marked, named, _ = _named_prints(docs, id, text, shingle, distance, chunk)
    return marked.join(named, "print").select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@other_columns_aside
def keep_representatives(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row of ``docs`` for each component, with all columns: that of the smallest id.

    Null ids are larger than others; of equal ids the row whose hash of id and text is smallest stays.
    """
    key = F.md5(F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"), text_or_empty(text)))
    name = F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), key.alias("key"))
    rows = docs.select(name.alias("_name"), F.col(text).alias("_text"))
    marked, named, most = _named_prints(rows, "_name", "_text", shingle, distance, chunk)
    kept = marked.join(named, "print").filter(F.col("id").eqNullSafe(F.col("component_id"))).select("id.key").distinct()
    kept = stored(gathered(kept, most), "kept")
    rows = docs.withColumn("_key", key)
    return rows.join(kept, rows["_key"] == kept["key"], "left_semi").dropDuplicates(["_key"]).drop("_key")
