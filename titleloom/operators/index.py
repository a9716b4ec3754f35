"""The title index: signatures, and the keys of a prefix forest over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleloom.functions.minhash import first_slot, packed_signature, signed, token_hashes, trees_of
from titleloom.functions.text import has_title, has_tokens, tokens
from titleloom.plans.durable import stored
from titleloom.plans.sizing import dealt


def latest_rows(docs: DataFrame, order: str = "pos") -> DataFrame:
    """``last_documents`` with ``last``, the place of the row that won."""
    titled = docs.filter(has_title(F.col("title"))).filter(has_tokens(F.col("title")))
    latest = titled.groupBy("id").agg(
        F.max_by(F.struct("title", "url"), F.col(order)).alias("won"),
        F.min(order).alias("pos"),
        F.max(order).alias("last"),
    )
    return latest.select(F.col("id").cast("string").alias("id"), "pos", "won.title", "won.url", "last")


def last_documents(docs: DataFrame, order: str = "pos") -> DataFrame:
    """One row per id: the last row that has tokens wins, at the place of the first such row.

    Rows without a real title or without tokens are dropped before, so they overwrite nothing.
    """
    return latest_rows(docs, order).drop("last")


def with_signature(rows: DataFrame, words: Column, tasks: int | None = None) -> DataFrame:
    """Add ``sig`` and ``trees`` of a token set.

    Token hashes are an input of the vectorised function, so each is computed once. ``tasks`` as for ``dealt``.
    """
    added = dealt(rows, tasks).withColumn("_signed", signed(token_hashes(words)))
    return added.select(*rows.columns, "_signed.sig", "_signed.trees")


def forest_keys(rows: DataFrame, *keep: str) -> DataFrame:
    """Eight rows per signature: ``(tree, k0, slots)`` with the 16 slots of the tree."""
    trees = rows.select(*keep, F.posexplode("trees").alias("tree", "slots"))
    return trees.select(*keep, "tree", first_slot(F.col("slots")).alias("k0"), "slots")


@dataclass(frozen=True)
class Index:
    """``docs(id, pos, title, url, sig)`` and ``keys(tree, k0, slots, pos, id)``; ``sig`` has the slots as bytes."""

    docs: DataFrame
    keys: DataFrame

    def save(self, path: str) -> None:
        """Write both tables, each clustered so that a small batch of queries reads few row groups.

        The range of the keys ends in the id: one key value may fill many partitions.
        """
        for name, table, order in (("docs", self.docs, ["id"]), ("keys", self.keys, ["tree", "k0", "id"])):
            clustered = table.repartitionByRange(*order).sortWithinPartitions(*order)
            clustered.write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Index:
        return Index(spark.read.parquet(f"{path}/docs"), spark.read.parquet(f"{path}/keys"))

    def count(self) -> DataFrame:
        """Number of indexed documents."""
        return self.docs.agg(F.count("*").alias("documents"))


def sign_documents(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows with ``sig`` of their titles. ``tasks`` as for ``dealt``."""
    signed_rows = with_signature(rows, tokens(F.col("title")), tasks)
    return signed_rows.select(*rows.columns, packed_signature(F.col("trees")).alias("sig"))


def _signed_documents(docs: DataFrame, order: str) -> DataFrame:
    return sign_documents(last_documents(docs, order))


def keys_of(rows: DataFrame) -> DataFrame:
    """Forest keys, cut from the signatures that a stored table holds."""
    return forest_keys(rows.withColumn("trees", trees_of(F.col("sig"))), "pos", "id")


def _index_of(rows: DataFrame) -> Index:
    return Index(rows, keys_of(rows))


def build_index(docs: DataFrame, order: str = "pos") -> Index:
    """Index ``docs(id, title, url)``; ``order`` is the column that gives the row order.

    Signed documents become a working table, from which a search reads keys and scores. For an index
    that is used again, take ``write_index``.
    """
    return _index_of(stored(_signed_documents(docs, order), "index"))


def write_index(docs: DataFrame, path: str, order: str = "pos") -> Index:
    """Index ``docs`` under ``path``, as ``save`` does, without a cache or a second signing."""
    # Ranges come before signatures: Spark samples what it cuts into ranges.
    ordered = last_documents(docs, order).repartitionByRange("id").sortWithinPartitions("id")
    sign_documents(ordered, tasks=0).write.mode("overwrite").parquet(f"{path}/docs")
    keys = _index_of(docs.sparkSession.read.parquet(f"{path}/docs")).keys
    order = ["tree", "k0", "id"]
    keys.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/keys")
    return Index.load(docs.sparkSession, path)
