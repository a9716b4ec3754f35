"""Mixing sources to target weights by hash thresholds over histograms.

Every document gets a place: the MD5 of its id and text in hexadecimal digits. Within a source the documents
whose place lies below a threshold are taken, so a smaller budget takes a subset of what a larger one
takes, and a second copy goes to documents that have a first. The threshold is found without sorting: words
are summed by source and leading digits of the place, the bucket in which the budget is used up is refined
by the next digits, and only the rows of that bucket are read again, until it holds one place.

Defined results
    * A null or empty text has size 0: it takes nothing.
    * A null source is a source of its own, after all others.
    * The document at the threshold is taken when that brings the source nearer to its target.
    * Rows that repeat id and text share a place and are taken together.
    * Without words every target is 0. An empty table gives an empty result.
    * Columns of the input that are named like results are replaced by the results in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleloom.llm.common import NOT_SPACES, other_columns_aside, stored, text_or_empty
from titleloom.plans.sizing import fits

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2
#: Hexadecimal digits of a place that one round resolves: 4096 buckets for each source.
DIGITS = 3
_PLACE = 32


def size_of(text: str) -> Column:
    """Words of a text: runs of anything but white space."""
    return F.regexp_count(text_or_empty(text), F.lit(NOT_SPACES)).cast("bigint")


def place_of(id: str, text: str) -> Column:
    """Where a document lies among those of its source."""
    return F.md5(F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"), text_or_empty(text)))


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES
) -> DataFrame:
    """``(source, source_size, target)``: shares by weight, none above ``most`` times its source.

    What sources at their limit leave over goes to the others by weight, again and again. In the end the
    others stand at one common level per weight. Over sources by rising limit per weight, the level that
    remains after those before a source rises up to the answer and falls beyond it, so it is the largest.
    The two windows run over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sums.withColumn("_weight", F.element_at(turn, (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("_limit", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    rest = F.sum("_weight").over(all_rows) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = F.max("_level").over(all_rows)
    return weighed.withColumn("_level", left / rest).select(
        "source", "source_size", F.least(F.col("_limit"), level * F.col("_weight")).alias("target")
    )


def _by_source(rows: DataFrame, sources: DataFrame, small: bool) -> DataFrame:
    """Join on the source, null included. Beyond the checked size adaptive execution splits hot sources."""
    side = sources.withColumnRenamed("source", "_source")
    joined = rows.join(F.broadcast(side) if small else side, rows["source"].eqNullSafe(side["_source"]))
    return joined.drop("_source")


def thresholds(
    sized: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    digits: int = DIGITS,
) -> DataFrame:
    """``(source, source_size, target, copies, edge, with_edge)`` from ``(source, size, place)``.

    Documents of the source get ``copies`` copies, and one more when their place is below ``edge``, or
    equals it and ``with_edge`` holds.
    """
    targets = source_targets(sized, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("copies", whole.cast("int")).select(
        "*",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
        F.lit("").alias("edge"),
        F.lit(0.0).alias("before"),
        F.lit(False).alias("with_edge"),
    )
    state = stored(state.withColumn("open", F.col("budget") > 0), "mix-state")
    small = fits(state, F.length(F.coalesce("source", F.lit(""))) * 4 + 100)
    while not state.filter("open").isEmpty():
        asked = state.filter("open").select("source", "budget", "edge", "before")
        inside = _by_source(sized, asked, small).filter(F.startswith("place", "edge"))
        bucket = F.substring(F.col("place"), F.length("edge") + 1, F.lit(digits))
        sums = inside.groupBy("source", "budget", "edge", "before", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("rows")
        )
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        reach = sums.withColumn("upto", F.col("before") + F.sum("words").over(running))
        cut = reach.filter("upto >= budget and upto - words < budget").select(
            F.col("source").alias("_source"),
            F.concat("edge", "bucket").alias("_edge"),
            (F.col("upto") - F.col("words")).alias("_before"),
            (F.col("upto") - F.col("budget") < F.col("budget") - (F.col("upto") - F.col("words"))).alias("_near"),
            F.col("rows").alias("_rows"),
        )
        found = state.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left")
        hit = F.col("open") & F.col("_edge").isNotNull()
        last = (F.col("_rows") == 1) | (F.length("_edge") >= _PLACE)
        state = stored(
            found.select(
                "source", "source_size", "target", "copies", "budget",
                F.when(hit, F.col("_edge")).otherwise(F.col("edge")).alias("edge"),
                F.when(hit, F.col("_before")).otherwise(F.col("before")).alias("before"),
                F.when(hit & last, F.col("_near")).otherwise(F.col("with_edge")).alias("with_edge"),
                (hit & ~last).alias("open"),
            ),
            "mix-state",
        )
    return state.select("source", "source_size", "target", "copies", "edge", "with_edge")


def copies_of(place: Column) -> Column:
    """Copies of a document, from the columns of ``thresholds``. ``edge`` may be a leading part of one place."""
    low, edge = F.substring(place, F.lit(1), F.length("edge")), F.col("edge")
    more = (low < edge) | ((low == edge) & F.col("with_edge"))
    return F.col("copies") + more.cast("int")


def sized_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Narrow working table ``(id, source, size, place)``; texts are read once."""
    return stored(
        docs.select(
            F.col(id).alias("id"),
            F.col(source).cast("string").alias("source"),
            size_of(text).alias("size"),
            place_of(id, text).alias("place"),
        ),
        "sized",
    )


def mixed_sizes(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Per document ``id, size, source_size, target, taken``; ``options`` as in ``thresholds``."""
    sized = sized_documents(docs, id, text, source)
    cuts = thresholds(sized, **options)
    small = fits(cuts, F.length(F.coalesce("source", F.lit(""))) * 4 + 100)
    taken = (F.col("size") * copies_of(F.col("place"))).cast("bigint")
    return _by_source(sized, cuts, small).select(
        F.col("id").alias(id), "size", "source_size", "target", taken.alias("taken")
    )


@other_columns_aside
def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixture itself: rows of ``docs`` with all columns, each as often as it is taken."""
    cuts = thresholds(sized_documents(docs, id, text, source), **options)
    small = fits(cuts, F.length(F.coalesce("source", F.lit(""))) * 4 + 100)
    names = {name: f"_mix_{name}" for name in ("copies", "edge", "with_edge")}
    side = cuts.select(F.col("source").alias("_mix_source"), *[F.col(a).alias(b) for a, b in names.items()])
    low = F.substring(place_of(id, text), F.lit(1), F.length("_mix_edge"))
    more = (low < F.col("_mix_edge")) | ((low == F.col("_mix_edge")) & F.col("_mix_with_edge"))
    joined = docs.join(
        F.broadcast(side) if small else side,
        F.col(source).cast("string").eqNullSafe(F.col("_mix_source")),
    )
    times = F.array_repeat(F.lit(0), F.col("_mix_copies") + more.cast("int"))
    return joined.withColumn("_mix_copy", F.explode(times)).select(*[docs[name] for name in docs.columns])
