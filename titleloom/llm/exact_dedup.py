"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups, keep the smallest id.

Everything is DataFrame functions. The text is scanned twice. The first scan leaves a narrow table of
hashes, which is grouped with partial aggregation. The second takes only rows whose hash occurs more than
once and compares their bytes: the smallest and the largest text of a hash are equal exactly when all are.
A hash that holds different texts is split by SHA-256, and the parts are compared again.

Defined results
    * A null text counts as empty, so null and empty texts and texts of white space alone form groups
      (white space alone becomes one space, which is another text than the empty one).
    * A null id is larger than any other id.
    * Rows that repeat id and text are members like any other; exactly one of them is kept.
    * An empty table gives an empty result. Other columns are not read by ``content_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import SPACES, other_columns_aside, stored, text_or_empty


def normalised(text: str) -> Column:
    """Text with every run of white space as one space."""
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def _differing(docs: DataFrame, text: str, hashed, repeated: DataFrame, keys: list[str]) -> DataFrame:
    """Keys among ``repeated`` under which the bytes of the texts differ."""
    norm = normalised(text)
    rows = docs.select(
        hashed(norm).alias("_hash"), F.unhex(F.sha2(norm, 256)).alias("_sha"), norm.alias("_norm")
    )
    # The join is stored before the aggregation: adaptive execution can then split a hot hash.
    members = stored(rows.join(repeated, keys, "left_semi"), "members")
    sides = members.groupBy(*keys).agg(F.min("_norm").alias("low"), F.max("_norm").alias("high"))
    return stored(sides.filter(F.col("low") != F.col("high")).select(*keys), "differing")


def content_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", hashed=content_hash) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``hashed`` maps a text column to the hash to group by.
    """
    norm = normalised(text)
    base = stored(
        docs.select(
            F.col(id).alias("_id"),
            hashed(norm).alias("_hash"),
            F.unhex(F.sha2(norm, 256)).alias("_sha"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "hashes",
    )
    counts = base.groupBy("_hash").agg(F.count("*").alias("n"))
    repeated = stored(counts.filter("n > 1").select("_hash"), "repeated")
    collided = _differing(docs, text, hashed, repeated, ["_hash"])
    part = F.lit(None).cast("binary")
    if not collided.isEmpty():
        inside = base.join(collided, "_hash", "left_semi").select("_hash", "_sha").distinct()
        if not _differing(docs, text, hashed, stored(inside, "parts"), ["_hash", "_sha"]).isEmpty():
            raise ValueError("different texts agree in the content hash and in SHA-256")
        base = base.join(collided.withColumn("_split", F.lit(True)), "_hash", "left")
        part = F.when(F.col("_split"), F.col("_sha"))
    base = base.withColumn("_part", F.coalesce(part, F.lit(b"")))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_row")))
    groups = stored(
        base.groupBy("_hash", "_part").agg(first.alias("first"), F.count("*").alias("group_size")), "groups"
    )
    return base.join(groups, ["_hash", "_part"]).select(
        F.col("_id").alias(id),
        F.col("first._id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("first._row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


@other_columns_aside
def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    groups = content_groups(docs, id, text)
    kept = stored(groups.filter("kept").select(F.col(id).alias("_id"), F.col("text_sha256").alias("_sha")), "kept")
    sha = F.sha2(normalised(text), 256)
    rows = docs.withColumn("_sha", sha)
    stay = rows.join(kept, (rows["_sha"] == kept["_sha"]) & rows[id].eqNullSafe(kept["_id"]), "left_semi")
    return stay.dropDuplicates([id, "_sha"]).drop("_sha")
