"""Pages that arrive over time, turned into title rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from titleloom.functions.html import h1_source, h1_title, visible_html
from titleloom.functions.urls import normalize_url
from titleloom.operators.pages import accepted_pages
from titleloom.operators.segments import SegmentedIndex
from titleloom.session import ship
from titleloom.sources.tables import PAGE_SCHEMA


def arriving_pages(
    spark: SparkSession, path: str, schema: str = PAGE_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of page rows from Parquet files dropped under ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


class _FirstArrival(StatefulProcessor):
    """Gives the row of the smallest ``page_id`` of a URL that is not remembered, and remembers the URL for a while."""

    def __init__(self, milliseconds: int):
        self.milliseconds = milliseconds

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "page_id bigint", self.milliseconds)

    def handleInputRows(self, key, rows, timers):  # noqa: N802
        first = min(rows, key=lambda row: (row.page_id is None, row.page_id or 0, str(row.h1)))
        if not self.seen.exists():
            self.seen.update((first.page_id,))
            yield Row(page_id=first.page_id, url=first.url, h1=first.h1)

    def close(self) -> None:
        pass


def titles_of(
    pages: DataFrame,
    once: bool = True,
    arrival: str | None = None,
    delay: str = "1 day",
    remember: timedelta | None = None,
) -> DataFrame:
    """``(page_id, url, title)`` of a page stream; with ``once``, the first arrival of a URL counts.

    With an arrival time, URLs are remembered for ``delay`` and state stays bounded. Without one they are remembered
    for good, or by the clock for the time ``remember``, after which a URL's state expires and it counts anew; start
    such a stream inside ``expiring_state``. Only titles, not HTML, go through the state's shuffle.
    """
    keep = [arrival] if arrival else []
    read = accepted_pages(pages).select(
        "page_id",
        normalize_url(F.col("url")).alias("url"),
        h1_source(visible_html(F.col("html")), F.col("html")).alias("h1"),
        *keep,
    )
    rows = read.filter(F.col("url").isNotNull())
    if once and arrival:
        rows = rows.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(["url"])
    elif once and remember:
        ship(pages.sparkSession)
        rows = rows.groupBy("url").transformWithState(
            _FirstArrival(remember // timedelta(milliseconds=1)), rows.schema, "append", "processingTime"
        )
    elif once:
        rows = rows.dropDuplicates(["url"])
    titled = rows.select("page_id", "url", h1_title(F.col("h1")).alias("title"), *keep)
    return titled.filter(F.col("title").isNotNull())


_EXPIRING = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # By the clock there would always be one more batch to run, so a stream of what has arrived would not end.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def expiring_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state where it can expire; start them inside again after a stop.

    State that has expired goes with the next batch that has data.
    """
    earlier = {setting: spark.conf.get(setting, None) for setting in _EXPIRING}
    try:
        for setting, value in _EXPIRING.items():
            spark.conf.set(setting, value)
        yield
    finally:
        for setting, value in earlier.items():
            spark.conf.unset(setting) if value is None else spark.conf.set(setting, value)


def ingest(titles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append title rows to a Parquet table, for all that has arrived so far."""
    return (
        titles.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_index(titles: DataFrame, path: str, checkpoint: str, order: str = "page_id", compact_after: int = 20) -> StreamingQuery:
    """Index ``(page_id, url, title)`` rows as they arrive, for all that has arrived so far.

    A micro-batch becomes a segment of the index below ``path``, once, however often it is delivered. After every
    ``compact_after`` batches the segments are made one.
    """

    def add(rows: DataFrame, batch: int) -> None:
        index = SegmentedIndex(rows.sparkSession, path)
        docs = rows.select(F.col("page_id").alias("id"), F.col(order).alias("pos"), "url", "title")
        if index.add(docs, batch=batch) and batch % compact_after == compact_after - 1:
            index.compact()

    return (
        titles.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
