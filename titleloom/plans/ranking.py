"""Ranked limits that neither one task nor one hot key has to carry alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALTS = 64
_SMALL_LIMIT = 100_000


def _ranked(df: DataFrame, keys: list, order: list, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k)


def top_k(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows of each key.

    Up to the threshold below which Spark trims every map partition to ``k`` rows before the
    shuffle, one window does it. Beyond it, a window over salted keys trims first.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        df = _ranked(salted, [*keys, "_salt"], order, k).drop("_salt", "_rank")
    out = _ranked(df, keys, order, k)
    return out.withColumnRenamed("_rank", rank) if rank else out.drop("_rank")


def _last_of(narrow: DataFrame, order: str, n: int) -> int:
    return narrow.orderBy(order).limit(n).agg(F.max(order)).first()[0]


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """First ``n`` rows by a unique BIGINT made by ``ordered_ids``.

    The last of these ids is found on the narrow column alone, and rows are then filtered by it where they
    are. A large ``n`` is cut by ranges of ids: counts per range are small and tell where the cut falls.
    """
    narrow, left = df.select(order), n
    if n > _SMALL_LIMIT:
        part = F.shiftrightunsigned(F.col(order), 20)
        sizes = narrow.groupBy(part.alias("_part")).count()
        before = F.sum("count").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        )
        edge = (
            sizes.withColumn("_before", F.coalesce(before, F.lit(0)))
            .filter(F.col("_before") < n)
            .orderBy(F.desc("_part"))
            .first()
        )
        if edge is None:
            return df.limit(0)
        narrow, left = narrow.filter(part == edge["_part"]), n - edge["_before"]
    last = _last_of(narrow, order, left)
    return df.limit(0) if last is None else df.filter(F.col(order) <= last)


def ordered_ids(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number rows in sorted order without a global rank: ids rise but have gaps."""
    return df.orderBy(*order).withColumn(name, F.monotonically_increasing_id())
