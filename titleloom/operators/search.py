"""Approximate top-k title search for a batch of queries."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleloom.functions.minhash import DEPTH, SLOT_BYTES, TREES, packed_estimate, packed_signature, prefix
from titleloom.functions.text import tokens
from titleloom.operators.index import Index, forest_keys, with_signature
from titleloom.plans.durable import stored
from titleloom.plans.ranking import top_k
from titleloom.plans.sizing import BROADCAST_BYTES, fits

CANDIDATES = 100
MIN_SIMILARITY = 0.01
NODE = ["tree", "depth", "prefix"]
# Up to this many query sets are looked up among documents by broadcasts.
_FEW_SETS = 4096
# Rows of a range of sorted slots, which a task holds.
_RANGE_ROWS = 200_000
# Above the number of documents of a node.
_TURNS = 1 << 40
# Up to this many keys are turned into a filter of the scan.
_FEW_KEYS = 256
# Bounds for one row of the tables below when broadcast.
_PREFIX_BYTES = 96
_SIGNATURE_BYTES = 1200
_REACHES = pa.schema(
    [("tree", pa.int32()), ("slots", pa.binary()), ("asked", pa.bool_()), ("held", pa.bool_()), ("place", pa.int64()),
     ("to_asked", pa.int32()), ("to_held", pa.int32())]
)
_REACHES_DDL = "tree int, slots binary, asked boolean, held boolean, place bigint, to_asked int, to_held int"


def query_table(spark: SparkSession, *texts: str) -> DataFrame:
    """``(qid, query)`` of texts given by hand, numbered from 0."""
    return spark.createDataFrame(list(enumerate(texts)), "qid bigint, query string")


def _narrowed(table: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """For a handful of wanted keys, filter by their values before joining.

    The values reach the scan, where a saved index skips the row groups that hold none of them.
    ``rows`` bounds how many keys there are.
    """
    if rows > _FEW_KEYS:
        return table
    match = [
        reduce(and_, [F.col(name) == value for name, value in key.asDict().items()])
        for key in wanted.collect()
    ]
    return table.filter(reduce(or_, match, F.lit(False)))


def _is_small(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def _small(table: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """A side of a bounded size for a broadcast; beyond that stored, so that both sides of a join are
    plain and adaptive execution splits hot keys."""
    return F.broadcast(table) if _is_small(rows, row_bytes) else stored(table, "side")


def query_sets(queries: DataFrame) -> DataFrame:
    """``(qid, qset, words)`` of queries with tokens; equal token sets share ``qset``."""
    words = queries.select("qid", F.array_sort(tokens(F.col("query"))).alias("words"))
    key = F.unhex(F.sha2(F.array_join("words", "\u0001"), 256))
    return words.filter(F.size("words") > 0).select("qid", key.alias("qset"), "words")


def _nodes(keys: DataFrame, depths: Column, *keep: str) -> DataFrame:
    """Prefixes of the given numbers of slots of a tree, each with the slot behind it."""
    deep = keys.select(*keep, "tree", "slots", F.explode(depths).alias("depth"))
    behind = F.substring(F.col("slots"), F.col("depth") * SLOT_BYTES + 1, F.lit(SLOT_BYTES))
    return deep.withColumn("prefix", prefix(F.col("slots"), F.col("depth"))).withColumn("next", behind).drop("slots")


def _reaching(met: DataFrame, query_keys: DataFrame, sets: int) -> DataFrame:
    """Add ``reach``, a bound on the slots that a tree shares with any query.

    Prefixes of two and of four slots are looked up in turn; most documents fail the first.
    """
    for depth in (2, 4):
        at, known = f"at{depth}", f"known{depth}"
        asked = query_keys.select("tree", prefix(F.col("slots"), F.lit(depth)).alias(at)).distinct()
        asked = asked.withColumn(known, F.lit(True))
        met = met.withColumn(at, prefix(F.col("slots"), F.lit(depth))).join(
            _small(asked, sets * TREES, _PREFIX_BYTES), ["tree", at], "left"
        )
    reach = F.when(F.col("known4"), DEPTH).when(F.col("known2"), 3).otherwise(1)
    return met.withColumn("reach", reach).drop("at2", "known2", "at4", "known4")


def _reaches(batches):
    """How many slots each row of a sorted range shares with another row that is asked, and that is held.

    The nearest such rows before and behind it share most. Beyond the ends of the range the first and the last row
    stand for them, which share no less, so a number is never too small.
    """
    batches = [batch for batch in batches if len(batch)]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    tree, own = table.column("tree").to_numpy(), np.arange(len(table))
    slots = np.frombuffer(b"".join(table.column("slots").to_pylist()), "<u4").reshape(-1, DEPTH)

    def shared(other: np.ndarray) -> np.ndarray:
        differ = np.c_[slots != slots[other], np.ones(len(other), bool)]
        return np.where(tree == tree[other], np.minimum(differ.argmax(axis=1), DEPTH - 1), 0)

    def reach(kind: str) -> pa.Array:
        is_kind = table.column(kind).to_numpy(zero_copy_only=False)
        before = np.maximum.accumulate(np.where(is_kind, own, 0))
        behind = np.minimum.accumulate(np.where(is_kind, own, len(own) - 1)[::-1])[::-1]
        most = np.maximum(shared(np.r_[0, before[:-1]]), shared(np.r_[behind[1:], len(own) - 1]))
        return pa.array(most, pa.int32())

    columns = [table.column(name).combine_chunks() for name in ("tree", "slots", "asked", "held", "place")]
    whole = pa.Table.from_arrays([*columns, reach("asked"), reach("held")], names=_REACHES.names)
    yield from whole.cast(_REACHES).to_batches(max_chunksize=10_000)


def _meeting(index: Index, query_keys: DataFrame) -> DataFrame:
    """The different slots of trees of queries and documents: which are ``asked`` and ``held``, their ``place`` in sorted
    order, and how many slots they share at most with others that are asked and held."""
    asked = query_keys.select("tree", "slots", F.lit(True).alias("asked"), F.lit(False).alias("held"))
    held = index.keys.select("tree", "slots", F.lit(False).alias("asked"), F.lit(True).alias("held"))
    kinds = asked.unionByName(held).groupBy("tree", "slots").agg(
        F.bool_or("asked").alias("asked"), F.bool_or("held").alias("held")
    )
    slots = stored(kinds, "slots")
    ranges = max(1, -(-slots.count() // _RANGE_ROWS))
    ordered = slots.repartitionByRange(ranges, "tree", "slots").sortWithinPartitions("tree", "slots")
    placed = ordered.withColumn("place", F.monotonically_increasing_id())
    return stored(placed.mapInArrow(_reaches, _REACHES_DDL), "reaches")


def _meeting_nodes(index: Index, query_keys: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of documents and of queries for many queries, without those at which nobody meets.

    A document and a query meet at the last node that both have. So a tree has a node for its whole slots, where these are
    both asked and held, and else as many as it shares slots with others.
    """
    reaches = _meeting(index, query_keys)
    twin = F.when(F.col("asked") & F.col("held"), F.array(F.lit(DEPTH))).otherwise(F.array().cast("array<int>"))

    def depths(shared: str) -> Column:
        above = F.when(F.col(shared) > 0, F.sequence(F.lit(1), F.col(shared))).otherwise(F.array().cast("array<int>"))
        return F.concat(above, twin)

    # Of documents with the same slots the first ones are met at every node.
    first = top_k(index.keys.select("tree", "slots", "pos", "id"), ["tree", "slots"], [F.col("pos"), F.col("id")], k)
    members = _nodes(first.join(reaches, ["tree", "slots"]), depths("to_asked"), "place", "pos", "id")
    asked = stored(_nodes(query_keys.join(reaches, ["tree", "slots"]), depths("to_held"), "qset"), "query-nodes")
    return members, asked


def _deep_nodes(query_nodes: DataFrame, lists: DataFrame, sets: int, k: int) -> DataFrame:
    """Nodes of queries without those that the walk never comes to.

    A node with ``k`` documents fills the list of every query at it, so no query goes on to later trees of that depth,
    nor to shallower nodes, in whatever tree.
    """
    full = lists.groupBy(*NODE).count().filter(F.col("count") >= k).drop("count")
    turn = F.struct("depth", (-F.col("tree")).alias("tree"))
    ends = query_nodes.join(full, NODE, "left_semi").groupBy("qset").agg(F.max(turn).alias("end"))
    ended = query_nodes.join(_small(ends, sets, _PREFIX_BYTES), "qset", "left")
    return ended.filter(F.col("end").isNull() | (turn >= F.col("end"))).drop("end")


def _candidates(index: Index, signed: DataFrame, sets: int, k: int) -> DataFrame:
    """First ``k`` documents per query set in the order in which the forest meets them.

    The forest goes from the longest shared prefix to the shortest, through the trees in turn,
    and within a tree in slot order. A document outside the first ``k`` of a node is preceded by
    ``k`` others at every query of that node, so nodes are cut to ``k`` before queries meet
    documents, and no bucket of documents is ever paired with its queries. A first cut, by the
    prefix that a document can share at most or by its whole slots, trims hot buckets and copies on the map side,
    before a row is repeated per depth. Lists are stored before they are joined, and so are sides that are
    too large for a broadcast: a hot bucket, or a node that many queries ask for, is then split.
    """
    query_keys = forest_keys(signed, "qset")
    if sets > _FEW_SETS or not _is_small(sets * TREES, _PREFIX_BYTES):
        members, query_nodes = _meeting_nodes(index, query_keys, k)
    else:
        every = F.sequence(F.lit(1), F.lit(DEPTH))
        query_nodes = _nodes(query_keys, every, "qset")
        first_slots = query_keys.select("tree", "k0").distinct()
        met = _narrowed(index.keys, first_slots, sets * TREES).join(
            _small(first_slots, sets * TREES, 32), ["tree", "k0"], "left_semi"
        )
        shared = _reaching(met, query_keys, sets).withColumn("shared", prefix(F.col("slots"), F.col("reach")))
        kept = top_k(shared, ["tree", "shared"], [F.col("slots"), F.col("pos"), F.col("id")], k)
        reached = F.sequence(F.lit(1), F.col("reach"))
        members = _nodes(kept.withColumn("place", F.col("slots")), reached, "place", "pos", "id")
    listed = top_k(members, NODE, [F.col("place"), F.col("pos"), F.col("id")], k, rank="turn")
    lists = stored(listed.select(*NODE, "next", "id", "turn"), "lists")
    deep = _deep_nodes(query_nodes, lists, sets, k)
    if not _is_small(sets, TREES * DEPTH * _PREFIX_BYTES):
        deep = stored(deep, "query-nodes")
    # Depth, tree and turn as one number. Who shares the next slot too was met at a deeper node of the tree.
    place = ((DEPTH - F.col("depth")) * TREES + F.col("tree")).cast("bigint") * _TURNS + F.col("turn")
    met = deep.withColumnRenamed("next", "own").join(lists, NODE).filter((F.col("depth") == DEPTH) | (F.col("own") != F.col("next")))
    # Combined before the exchange by query set, which serves the merge over trees and the rank.
    merged = (
        met.select("qset", "id", place.alias("place"))
        .repartition("qset")
        .groupBy("qset", "id")
        .agg(F.min("place").alias("place"))
    )
    ranked = top_k(merged, ["qset"], [F.col("place"), F.col("id")], k, rank="rank")
    depth = DEPTH - F.floor(F.col("place") / (_TURNS * TREES)).cast("int")
    return ranked.select("qset", "id", "rank", depth.alias("depth"))


def _signed_sets(queries: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``(qid, qset)`` of all queries, and ``(qset, trees)`` of the different ones, as stored tables; ``qset`` is a number."""
    asked = stored(query_sets(queries), "query-sets")
    distinct = asked.select("qset", "words").dropDuplicates(["qset"])
    numbered = with_signature(distinct, F.col("words")).select("qset", "trees", F.monotonically_increasing_id().alias("number"))
    signed = stored(numbered, "signed-sets")
    known = stored(asked.select("qid", "qset").join(signed.select("qset", "number"), "qset"), "asked")
    return known.select("qid", F.col("number").alias("qset")), signed.select(F.col("number").alias("qset"), "trees"), signed.count()


def forest_candidates(index: Index, queries: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """``(qid, id, depth, rank)``: the documents that the forest proposes for each query."""
    asked, signed, sets = _signed_sets(queries)
    proposed = _candidates(index, signed, sets, k)
    if not _is_small(sets * k, _PREFIX_BYTES):
        proposed = stored(proposed, "proposed")  # a question that many ask is then split
    return asked.join(proposed, "qset").drop("qset")


def search(
    index: Index,
    queries: DataFrame,
    k: int = CANDIDATES,
    min_sim: float = MIN_SIMILARITY,
    ordered: bool = True,
) -> DataFrame:
    """``(qid, id, title, url, similarity)`` for ``queries(qid, query)``.

    Equal queries are answered once and fanned out at the end. With ``ordered``, the hits of a
    query stand together, best first; queries among themselves are in no order, which saves a
    global sort with its sampling pass. What is used twice is a working table; nothing is cached.
    """
    asked, signed, sets = _signed_sets(queries)
    proposed = stored(_candidates(index, signed, sets, k).select("qset", "id"), "proposed")
    # Ids have any length, so their size is measured.
    small = fits(proposed, F.octet_length("id") + _PREFIX_BYTES, BROADCAST_BYTES)
    documents = _narrowed(index.docs, proposed.select("id"), sets * k)
    described = documents.select("id", "title", "url", "sig").join(
        F.broadcast(proposed) if small else proposed, "id"
    )
    query_sigs = signed.select("qset", packed_signature(F.col("trees")).alias("query_sig"))
    scored = described.join(_small(query_sigs, sets, _SIGNATURE_BYTES), "qset").select(
        "qset",
        "id",
        "title",
        "url",
        packed_estimate(F.col("sig"), F.col("query_sig")).alias("similarity"),
    )
    kept = scored.filter(F.col("similarity") > min_sim)
    if ordered and sets > _FEW_SETS and asked.groupBy("qid").count().filter("count > 1").isEmpty():
        # Every query is one row: it meets its hits in a row, in order, and they are not moved again.
        hit = F.struct((-F.col("similarity")).alias("down"), "id", "title", "url", "similarity")
        best = stored(kept.groupBy("qset").agg(F.array_sort(F.collect_list(hit)).alias("hits")), "best")
        return asked.join(best, "qset").select("qid", F.inline("hits")).drop("down")
    if not (small and _is_small(sets, _SIGNATURE_BYTES)):
        kept = stored(kept, "scored")  # a question that many ask is then split
    hits = asked.join(kept, "qset").select("qid", "id", "title", "url", "similarity")
    if not ordered:
        return hits
    return hits.repartition("qid").sortWithinPartitions("qid", F.desc("similarity"), "id")


def as_json(hits: DataFrame) -> DataFrame:
    """``(qid, result)`` with one JSON object per hit."""
    return hits.select(
        "qid", F.to_json(F.struct("id", "title", "url", "similarity")).alias("result")
    )
