"""A saved index that grows: segments of new documents, tombstones for what they replace, and compaction.

Below the folder of an index, ``docs``, ``keys`` and ``gone`` hold a part per segment, and ``log`` a row per segment
that is complete. A batch of documents becomes a segment: it is signed, ids that the index has already are
merged with their rows there, and these rows are named in ``gone``. Only the batch is signed and written; of what is
there, ids and places are read. A reader takes the segments of the log and leaves out rows that later ones replaced,
so it sees a batch as a whole or not at all. A batch under a number that the log has is skipped, and the parts of
one that never reached the log are written again, which makes a replay harmless. One writer at a time is expected.

Merging is that of a full build: the content is that of the last row, the place that of the first one. So a search
over segments gives what a search over an index of all batches gives.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleloom.operators.index import Index, keys_of, latest_rows, sign_documents
from titleloom.plans.durable import remove_folder, stored, working_tables
from titleloom.plans.sizing import fits

LOG = "segment bigint, oldest bigint, batch bigint"
_GONE = "id string, old bigint, segment bigint"


class SegmentedIndex:
    """An index below ``path`` that takes batches of documents."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _part(self, table: str, segment: int) -> str:
        return f"{self.path}/{table}/segment={segment}"

    def log(self) -> list:
        """Complete segments in order: number, the oldest segment that still counts with it, and the caller's batch."""
        try:
            rows = self.spark.read.schema(LOG).parquet(f"{self.path}/log").collect()
        except AnalysisException:  # nothing was ever written
            return []
        return sorted(rows, key=lambda row: row["segment"])

    def _live(self, table: str, log: list) -> DataFrame:
        """Rows of a table that no later segment replaced, with their segment."""
        counted = [row["segment"] for row in log if row["segment"] >= log[-1]["oldest"]]
        held = [n for n in counted if self._has(table, n)]
        rows = self.spark.read.option("basePath", f"{self.path}/{table}").parquet(*[self._part(table, n) for n in held])
        rows = rows.withColumn("segment", F.col("segment").cast("bigint"))
        replaced = [n for n in counted if self._has("gone", n)]
        if not replaced:
            return rows
        gone = self.spark.read.schema(_GONE).option("basePath", f"{self.path}/gone").parquet(
            *[self._part("gone", n) for n in replaced]
        )
        gone = gone.select("id", F.col("old").alias("segment"))
        small = fits(gone, F.octet_length("id") + 24)
        return rows.join(F.broadcast(gone) if small else gone, ["id", "segment"], "left_anti")

    def _has(self, table: str, segment: int) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self._part(table, segment))
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def load(self) -> Index:
        """The index as ``search`` takes it."""
        log = self.log()
        if not log:
            raise ValueError(f"no index below {self.path}")
        return Index(*[self._live(table, log).drop("segment", "last") for table in ("docs", "keys")])

    def _write(self, docs: DataFrame, segment: int, oldest: int, batch: int | None, gone: DataFrame | None) -> None:
        """All parts of a segment, and last its row in the log. ``docs`` are signed and in ranges of ids."""
        if gone is not None:
            gone.write.mode("overwrite").parquet(self._part("gone", segment))
        docs.write.mode("overwrite").option("compression", "zstd").parquet(self._part("docs", segment))
        order = ["tree", "k0", "id"]
        keys = keys_of(self.spark.read.parquet(self._part("docs", segment)))
        keys.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(self._part("keys", segment))
        entry = self.spark.createDataFrame([(segment, oldest, batch)], LOG).coalesce(1)
        entry.write.mode("append").parquet(f"{self.path}/log")

    def add(self, docs: DataFrame, order: str = "pos", batch: int | None = None, removed: DataFrame | None = None) -> bool:
        """Index ``docs(id, title, url)`` as a segment; ids in ``removed(id)`` go, unless the batch has them too.

        ``order`` gives the row order over all batches, so that the last row of an id wins whatever batch it came
        with. A ``batch`` that was added before changes nothing; the result tells whether this one did.
        """
        log = self.log()
        if batch is not None and any(row["batch"] == batch for row in log):
            return False
        with working_tables(self.spark):
            self._add(docs, order, batch, removed, log)
        return True

    def _add(self, docs: DataFrame, order: str, batch: int | None, removed: DataFrame | None, log: list) -> None:
        segment = log[-1]["segment"] + 1 if log else 0
        fresh, gone = stored(latest_rows(docs, order), "fresh"), None
        if log:
            ids = fresh.select("id")
            if removed is not None:
                dropped = removed.select(F.col("id").cast("string").alias("id")).distinct()
                ids = ids.unionByName(dropped.join(fresh, "id", "left_anti"))
            there = self._live("docs", log).select("id", "pos", "title", "url", "last", "segment")
            old = stored(there.select("id", "pos", "last", "segment").join(ids, "id", "left_semi"), "replaced")
            gone = old.select("id", F.col("segment").alias("old"))
            known = old.select("id", F.col("pos").alias("old_pos"), F.col("last").alias("old_last"))
            merged = fresh.join(known, "id", "left").withColumn("pos", F.least("pos", "old_pos"))
            later = F.col("old_last") > F.col("last")
            won = merged.filter(F.coalesce(~later, F.lit(True))).select(fresh.columns)
            # Rows that come late: the content is the one that is there.
            lost = there.drop("pos", "segment").join(merged.filter(later).select("id", "pos"), "id")
            fresh = won.unionByName(lost)
        # Ranges come before signatures: Spark samples what it cuts into ranges.
        ordered = fresh.repartitionByRange("id").sortWithinPartitions("id")
        self._write(sign_documents(ordered, tasks=0), segment, log[-1]["oldest"] if log else 0, batch, gone)

    def compact(self) -> None:
        """One segment instead of all. Documents are copied without a shuffle: their files are ranges of ids already.

        Readers of the old segments go on until ``clean`` removes them.
        """
        log = self.log()
        if log and log[-1]["oldest"] < log[-1]["segment"]:
            segment = log[-1]["segment"] + 1
            self._write(self._live("docs", log).drop("segment"), segment, segment, None, None)

    def clean(self) -> None:
        """Remove segments that compaction has replaced. The log keeps their rows, and so the numbers of batches."""
        log = self.log()
        for row in log:
            if row["segment"] < log[-1]["oldest"]:
                for table in ("docs", "keys", "gone"):
                    remove_folder(self.spark, self._part(table, row["segment"]))
