"""Exact top-k by inner product: candidates by descending length, partial sums in rotated space, residual bounds.

1. Lengths. Vectors are stored in order of their length, longest first, in ranges that Spark sorts. So a scan can
   pass over row groups of short vectors, and a task meets its part of the candidates by descending length.
2. Rotation. The tasks sum products of components; the right singular vectors of all vectors are the eigenvectors of
   that sum. Rotated by them, the first ``h`` components hold ``ENERGY`` of the squared length on average.
3. First bounds. Each query meets the ``HEAD`` longest candidates and as many chosen by a hash. Its k-th best score
   there, ``t``, is a lower bound of its k-th best score anywhere. By Cauchy-Schwarz a candidate shorter than
   ``t / |q|``, the reach of the query, cannot be among the best.
4. Blocks. Queries are stored in order of their reach and taken in blocks of a bounded size. A block is broadcast and
   meets all candidates at least as long as its least reach, by a filter of the scan. In a task, queries whose reach
   exceeds the longest candidate of a batch drop out; for the others the partial sum over ``h`` rotated components
   plus the product of the lengths of the rests bounds the score. Pairs whose bound is below ``t`` end there;
   scores of the others are computed in whole numbers, and ``t`` rises as a task finds better candidates.
5. The best of each task are merged by a window over each query: at most ``k`` rows a task and query.

The bounds carry a margin far above rounding, so pruning never decides; scores are exact.

Defined results
    * Vectors are arrays of whole numbers. Null vectors take no part, nor do vectors with a null component.
    * Vectors of different sizes are compared as if zeros followed the shorter one; an empty one scores zero.
    * A query is a row, and never meets itself; another row with the same id or the same vector is a candidate.
    * Equal scores are ordered by id, null ids last. A query with fewer than ``k`` candidates gets all of them.
    * Repeated query ids give a list for each row. An empty table, or no query, gives an empty result.
    * Products that could exceed a long raise an error. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleloom.llm.common import stored

K = 20
#: Candidates of each kind that give the first bounds.
HEAD = 2048
#: Share of the squared lengths in the components of a partial sum.
ENERGY = 0.8
#: Numbers in a broadcast block of queries: 32 MiB.
BLOCK_CELLS = 1 << 22
#: Rotations are found up to this size; larger vectors are compared as they are.
ROTATED = 1024
_MARGIN = 1e-9
_ROWS = 1024
_HELD = 1 << 20


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, with zeros behind the short ones."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class _Space:
    """How vectors are compared: their width, exact products, and the rotation for partial sums."""

    def __init__(self, width: int, exact_floats: bool, rotation: np.ndarray, leading: int):
        self.width, self.exact_floats, self.rotation, self.leading = width, exact_floats, rotation, leading

    def whole(self, column: pa.ListArray) -> np.ndarray:
        numbers = _matrix(column, self.width)
        return numbers.astype(np.float64) if self.exact_floats else numbers

    def rotated(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading rotated components, and the length of the rest."""
        turned = numbers @ self.rotation if len(self.rotation) else numbers.astype(np.float64)
        return np.ascontiguousarray(turned[:, : self.leading]), np.sqrt((turned[:, self.leading :] ** 2).sum(1))

    def pairs(self, queries: np.ndarray, candidates: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Exact scores of given pairs."""
        if len(q) * 8 > len(queries) * len(candidates):
            return (queries @ candidates.T)[q, c]
        out = [np.einsum("ij,ij->i", queries[q[i : i + 65536]], candidates[c[i : i + 65536]]) for i in range(0, len(q), 65536)]
        return np.concatenate(out) if out else np.zeros(0)


def _products(rows: DataFrame, width: int) -> np.ndarray:
    """Sum of products of components over all vectors; each task adds up its own, then rows of the matrix meet."""

    def add_up(batches):
        total = np.zeros((width, width))
        for batch in batches:
            numbers = _matrix(batch.column("vector"), width).astype(np.float64)
            total += numbers.T @ numbers
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total))], ["i", "sums"])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": rows["i"].iloc[:1], "sums": [np.sum(rows["sums"].to_list(), axis=0)]})

    partial = rows.select("vector").mapInArrow(add_up, "i int, sums array<double>")
    found = partial.groupBy("i").applyInPandas(meet, "i int, sums array<double>").collect()
    return np.array([row["sums"] for row in sorted(found, key=lambda row: row["i"])])


def _space(rows: DataFrame) -> _Space | None:
    """Measured over all vectors; None without any."""
    top = rows.agg(F.max("size").alias("size"), F.max("top").alias("top")).first()
    if top["size"] is None:
        return None
    width, bound = max(1, top["size"]), int(top["top"] or 0) ** 2 * max(1, top["size"])
    if bound >= 1 << 63:
        raise ValueError("inner products of these vectors may exceed a long")
    rotation, leading = np.zeros((0, 0)), max(1, width // 2)
    if width <= ROTATED:
        values, turned = np.linalg.eigh(_products(rows, width))
        values, rotation = np.maximum(values[::-1], 0), np.ascontiguousarray(turned[:, ::-1])
        share = np.cumsum(values) / max(values.sum(), 1e-300)
        leading = min(width, int(np.searchsorted(share, ENERGY)) + 1)
    return _Space(width, bound < 1 << 53, rotation, leading)


def _in_order(who: np.ndarray, score: np.ndarray, id: np.ndarray, none: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by query, score and id, cut to ``k`` of each query; and where a query has its k-th."""
    order = np.lexsort((id, none, -score, who))
    who = who[order]
    first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]][: len(who)])
    rank = np.arange(len(who)) - np.repeat(first, np.diff(np.r_[first, len(who)]))
    kept = order[rank < k]
    return kept, np.flatnonzero(rank[rank < k] == k - 1)


class _Search:
    """Best candidates of a block of queries, over the candidates that a task meets."""

    def __init__(self, space: _Space, vectors: np.ndarray, row: np.ndarray, least: np.ndarray, k: int):
        self.space, self.k = space, k
        self.length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        order = np.argsort(reach(least, self.length), kind="stable")
        self.order, self.length, self.vectors = order, self.length[order], vectors[order]
        self.row, self.least = row[order], least[order].astype(np.float64)
        self.lead, self.rest = space.rotated(self.vectors)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def meet(self, vectors: np.ndarray, row: np.ndarray, id: np.ndarray, none: np.ndarray) -> None:
        """Candidates in any order; the longest of them decides which queries take part."""
        lead, rest = self.space.rotated(vectors)
        length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        longest = float(length.max(initial=0))
        within = np.flatnonzero(self.length * longest * (1 + _MARGIN) + _MARGIN >= self.least)
        for begin in range(0, len(within), _ROWS):
            own = within[begin : begin + _ROWS]
            margin = _MARGIN * (1 + self.length[own] * longest)
            bound = self.lead[own] @ lead.T + self.rest[own, None] * rest
            q, c = np.nonzero(bound >= (self.least[own] - margin)[:, None])
            score = self.space.pairs(self.vectors[own], vectors, q, c).astype(np.int64)
            good = (score >= self.least[own][q]) & (row[c] != self.row[own][q])
            q, c, score = own[q[good]], c[good], score[good]
            self.held.append((q, score, id[c], none[c]))
            self.size += len(q)
            if self.size > _HELD:
                self._trim()

    def _trim(self) -> None:
        who, score, id, none = (np.concatenate(x) for x in zip(*self.held, strict=True))
        kept, last = _in_order(who, score, id, none, self.k)
        who, score = who[kept], score[kept]
        self.least[who[last]] = np.maximum(self.least[who[last]], score[last])
        self.held, self.size = [(who, score, id[kept], none[kept])], 0

    def best(self) -> tuple[np.ndarray, ...]:
        """``(place of the query, score, id, whether the id is null)``; ``least`` has risen as far as it can."""
        if not self.held:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        self._trim()
        who, score, id, none = self.held[0]
        return self.order[who], score, id, none


def reach(least: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Least length of a candidate that can reach ``least``."""
    out = np.full(len(least), -np.inf)
    np.divide(least, length, out=out, where=(length > 0) & (least > 0))
    return out


def _columns(batch: pa.RecordBatch, space: _Space) -> Iterator[tuple[np.ndarray, ...]]:
    """Vectors, rows, ids and null ids of a batch, some at a time."""
    for begin in range(0, batch.num_rows, _ROWS):
        part = batch.slice(begin, _ROWS)
        id = part.column("id")
        yield (
            space.whole(part.column("vector")), part.column("row").to_numpy(),
            id.fill_null(0).to_numpy(), id.is_null().to_numpy(zero_copy_only=False),
        )


def _collected(rows: DataFrame, space: _Space) -> list[tuple[np.ndarray, ...]]:
    """A bounded number of rows on the driver."""
    table = rows.select("id", "row", "vector").toArrow().combine_chunks()
    return [part for batch in table.to_batches() for part in _columns(batch, space)]


def _bounds(queries: DataFrame, head, space: _Space, k: int) -> DataFrame:
    """Queries with their first bound and reach."""

    def bound(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                part = batch.slice(begin, _ROWS)
                ((vectors, row, _, _),) = _columns(part, space)
                search = _Search(space, vectors, row, np.full(len(row), -np.inf), k)
                for candidates in head.value:
                    search.meet(*candidates)
                search.best()
                least = np.empty(len(row))
                least[search.order] = search.least
                length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(least), pa.array(reach(least, length))], [*part.schema.names, "least", "reach"]
                )

    return queries.mapInArrow(bound, "id bigint, row bigint, vector array<bigint>, least double, reach double")


def _blocks(sizes: list[tuple[int, int]], limit: int) -> Iterator[tuple[int, int, int]]:
    """First and last range of a block, and into how many parts it is to be cut."""
    first, held = None, 0
    for part, n in sizes:
        if first is not None and held + n > limit:
            yield first, last, 1
            first, held = None, 0
        if n > limit:
            yield part, part, -(-n // limit)
            continue
        first = part if first is None else first
        last, held = part, held + n
    if first is not None:
        yield first, last, 1


def top_products(
    vectors: DataFrame,
    is_query: Column,
    id: str = "vec_id",
    vector: str = "vector",
    k: int = K,
    head: int = HEAD,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """``(query_id, rank, <id>, score)``: the ``k`` best candidates of each row that ``is_query`` marks."""
    spark = vectors.sparkSession
    marked = vectors.select(
        F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<bigint>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    measured = marked.withColumn("length", F.sqrt(squares)).withColumn("size", F.size("vector"))
    measured = measured.withColumn("top", F.array_max(F.transform("vector", lambda x: F.abs(x.cast("decimal(20,0)")))))
    ordered = measured.repartitionByRange(F.desc("length"), F.xxhash64("vector", "id")).sortWithinPartitions(F.desc("length"))
    rows = stored(ordered.withColumn("row", F.monotonically_increasing_id()), "by-length")
    space = _space(rows)
    schema = "query_id bigint, query_row bigint, score bigint, id bigint"
    found = spark.createDataFrame([], schema)
    if space is not None:
        shared = spark.sparkContext.broadcast(
            _collected(rows.orderBy(F.desc("length"), "row").limit(head), space)
            + _collected(rows.orderBy(F.xxhash64("row"), "row").limit(head), space)
        )
        asked = _bounds(rows.filter("asks").select("id", "row", "vector"), _Distinct(shared), space, k)
        asked = asked.repartitionByRange("reach", "row").withColumn("part", F.spark_partition_id())
        asked = stored(asked, "queries")
        sizes = asked.groupBy("part").agg(F.count("*").alias("n"), F.min("reach").alias("reach")).orderBy("part").collect()
        limit = max(1, block_cells // space.width)
        for first, last, pieces in _blocks([(row["part"], row["n"]) for row in sizes], limit):
            least = min(row["reach"] for row in sizes if first <= row["part"] <= last)
            for piece in range(pieces):
                block = asked.filter(F.col("part").between(first, last))
                block = block if pieces == 1 else block.filter(F.pmod(F.xxhash64("row"), F.lit(pieces)) == piece)
                found = found.unionByName(stored(_searched(rows, block, least, space, k, schema), "best"))
    place = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(id), "score")


class _Distinct:
    """The broadcast candidates that give first bounds, each row once."""

    def __init__(self, shared):
        self.shared = shared

    @property
    def value(self) -> list[tuple[np.ndarray, ...]]:
        seen, out = np.zeros(0, np.int64), []
        for vectors, row, id, none in self.shared.value:
            fresh = ~np.isin(row, seen)
            seen = np.r_[seen, row]
            out.append((vectors[fresh], row[fresh], id[fresh], none[fresh]))
        return [part for part in out if len(part[1])]


def _searched(rows: DataFrame, block: DataFrame, least: float, space: _Space, k: int, schema: str) -> DataFrame:
    """Best candidates of a block of queries, per task."""
    table = block.select("id", "row", "vector", "least").toArrow().combine_chunks()
    numbers = np.concatenate([space.whole(batch.column("vector")) for batch in table.to_batches()] or [np.zeros((0, space.width))])
    asking = rows.sparkSession.sparkContext.broadcast(
        (numbers, table["row"].to_numpy(), table["least"].to_numpy(), table["id"].to_numpy())
    )

    def search(batches):
        numbers, row, least, ids = asking.value
        state = _Search(space, numbers, row, least, k)
        for batch in batches:
            for candidates in _columns(batch, space):
                state.meet(*candidates)
        who, score, id, none = state.best()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[who]), pa.array(row[who]), pa.array(score), pa.array(id, mask=none.astype(bool))],
            ["query_id", "query_row", "score", "id"],
        )

    long_enough = rows.filter(F.col("length") >= least * (1 - 1e-6)) if least > 0 else rows
    return long_enough.select("id", "row", "vector").mapInArrow(search, schema)
