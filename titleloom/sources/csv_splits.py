"""CSV files with line breaks in quotes, read in the byte ranges in which Spark splits text files.

A range cannot tell by itself whether it begins inside quotes. So lines are scanned twice. The first scan
gives one row a range: where a range ends, and whether a record begins in it, for both ways in which it may
begin. A walk over these rows, in the order of the ranges of a file, tells the true way of each. The second
scan puts lines together to records. Lines that continue a record of an earlier range travel, all else stays.

Defined results
    * The first record of a file, which must lie in its first range, names its columns;
      files may have them in different orders. A column that a file lacks is NULL, and so are empty values.
    * Blank lines are passed over.
    * Quotes open a value only at its begin, and are doubled inside. What follows a closing quote belongs to the
      value. Quotes that are never closed run to the end of the file. Line breaks in quotes stay as they are.
    * Bytes that are no UTF-8 become replacement characters, as in Spark's text scan. An empty file has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titleloom.plans.durable import stored
from titleloom.plans.sizing import BROADCAST_BYTES, fits
from titleloom.session import ship

# Values that are whole on a line, and the rest of one that began on an earlier line.
_WHOLE = re.compile(r'(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)(?:,|\Z))*+')
_CLOSED = re.compile(r'[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,|\Z)')
_VALUE = re.compile(r'"([^"]*+(?:""[^"]*+)*+)(?:"([^,]*+)|\Z)|([^,]*+)')
_BLANK = " \t\r\ufeff"
_EDGES = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("shut_then_open", pa.bool_()), ("open_then_open", pa.bool_()),
     ("open_then_begins", pa.bool_()), ("head", pa.string())]
)
_EDGES_DDL = "file string, start bigint, shut_then_open boolean, open_then_open boolean, open_then_begins boolean, head string"
_RECORDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("row", pa.int64()), ("crosses", pa.bool_()), ("record", pa.string())])
_RECORDS_DDL = "file string, start bigint, row bigint, crosses boolean, record string"


def ends_open(line: str, begins_open: bool) -> bool:
    """Whether a line ends inside quotes."""
    if '"' not in line:
        return begins_open
    at = 0
    if begins_open:
        closed = _CLOSED.match(line)
        if not closed:
            return True
        at = closed.end()
    return at < len(line) and _WHOLE.match(line, at).end() < len(line)


def values_of(record: str) -> list[str]:
    """Values of a record."""
    record = record[:-1] if record.endswith("\r") else record
    if '"' not in record:
        return record.split(",")
    values, at = [], 0
    while at <= len(record):
        found = _VALUE.match(record, at)
        inside, behind, plain = found.groups()
        values.append(plain if inside is None else inside.replace('""', '"') + (behind or ""))
        at = found.end() + 1
    return values


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _ranges(batches) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches, cut where the range changes."""
    for batch in batches:
        if not len(batch):
            continue
        edges = [0]
        if len(batch) > 1:
            turn = [pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, len(batch) - 1)) for c in ("file", "start")]
            edges += [i + 1 for i in pc.indices_nonzero(pc.or_(*turn)).to_pylist()]
        for begin, end in zip(edges, [*edges[1:], len(batch)], strict=True):
            part = batch.slice(begin, end - begin)
            yield (part.column("file")[0].as_py(), part.column("start")[0].as_py()), part


def _edges(batches):
    """A row for each range, for both ways in which it may begin, with the first record of a file."""
    rows, here = [], None

    def row() -> dict:
        text = "\n".join(head).strip("\ufeff") if head else None
        return dict(zip(_EDGES.names, (*here, shut, opened, begins, text), strict=True))

    for key, part in _ranges(batches):
        if key != here:
            if here:
                rows.append(row())
            here, shut, opened, begins = key, False, True, False
            head, heading = [], key[1] == 0
        lines = part.column("value")
        if heading:
            for line in lines.to_pylist():
                if head or line.strip(_BLANK):
                    head.append(line)
                    heading = ends_open(line, len(head) > 1)
                    if not heading:
                        break
        for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
            shut, opened = ends_open(line, shut), ends_open(line, opened)
            begins = begins or not opened
    if here:
        rows.append(row())
    if rows:
        yield from pa.Table.from_pylist(rows, _EDGES).to_batches()


def _walked(edges: DataFrame) -> DataFrame:
    """``(file, start, opened, ends, owner)`` of each range: whether it begins and ends inside quotes, and the range in
    which the record began that is open at its begin.

    A range ends one way however it begins, or turns its begin over, or leaves it: so the way of a range is that of the
    last range of the first kind, turned over as often as there were turns since.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sure = F.col("shut_then_open") == F.col("open_then_open")
    turns = F.coalesce(F.sum((F.col("shut_then_open") & ~F.col("open_then_open")).cast("int")).over(before), F.lit(0))
    known = F.last(F.when(sure, F.struct(F.col("shut_then_open").alias("open"), "turns")), ignorenulls=True).over(before)
    since = F.col("turns") - F.coalesce("known.turns", F.lit(0))
    opened = F.coalesce("known.open", F.lit(False)) != (since % 2 == 1)
    ends = F.when(F.col("opened"), F.col("open_then_open")).otherwise(F.col("shut_then_open"))
    owner = F.max(F.when(~F.col("opened") | F.col("open_then_begins"), F.col("start"))).over(before)
    ways = edges.withColumn("turns", turns).withColumn("known", known).withColumn("opened", opened)
    return ways.select("file", "start", "opened", ends.alias("ends"), owner.alias("owner"))


def _records(batches):
    """Lines put together to records; those that cross the edges of ranges come in pieces.

    ``row`` counts the records of a range from 0. What continues a record of an earlier range has -1.
    """
    here = None

    def piece(crosses: bool) -> tuple:
        return (*here, row, crosses, "\n".join(held))

    for key, part in _ranges(batches):
        out = []
        if key != here:
            if here and held:
                out.append(piece(True))
            here, held = key, []
            opened = bool(part.column("opened")[0].as_py())
            row = -1 if opened else 0
        for line in part.column("value").to_pylist():
            held.append(line)
            opened = ends_open(line, opened)
            if opened:
                continue
            if row < 0 or len(held) > 1 or line.strip(_BLANK):
                out.append(piece(row < 0))
                row += 1
            held = []
        if out:
            yield _batch(out)
    if here and held:
        yield _batch([piece(True)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RECORDS, strict=True)], schema=_RECORDS)


def _with_state(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines with ``opened`` of their range, in their order."""
    inside = stored(ranges.filter("opened").select("file", "start", "opened"), "csv-opened")
    if fits(inside, F.length("file") + 16, BROADCAST_BYTES):
        return lines.join(F.broadcast(inside), ["file", "start"], "left").select("file", "start", "opened", "value")
    placed = lines.withColumn("place", F.monotonically_increasing_id()).join(inside, ["file", "start"], "left")
    placed = placed.repartition("file", "start").sortWithinPartitions("file", "start", "place")
    return placed.select("file", "start", "opened", "value")


def _parsed(columns: list[str], names: Column, record: Column) -> Column:
    """Values of ``columns`` in a record, by the names in the first record of its file."""

    @F.pandas_udf("array<string>")
    def parse(heads: pd.Series, records: pd.Series) -> pd.Series:
        places, rows = {}, []
        for head, text in zip(heads, records, strict=True):
            if head not in places:
                order = values_of(head)
                places[head] = [order.index(c) if c in order else -1 for c in columns]
            found = values_of(text)
            rows.append([(found[i] or None) if 0 <= i < len(found) else None for i in places[head]])
        return pd.Series(rows, dtype=object)

    return parse(names, record)


def read_csv_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``columns`` as strings, and ``pos``, which orders rows as they stand in the files, from CSV files with a header.

    Files are read in the splits of Spark's text scan (``spark.sql.files.maxPartitionBytes``), once to see where
    quotes are open and once for the records, and a third time for pieces where records cross splits.
    """
    lines = _lines(ship(spark), path)
    edges = stored(lines.mapInArrow(_edges, _EDGES_DDL), "csv-edges")
    ranges = stored(_walked(edges), "csv-ranges")
    records = _with_state(lines, ranges).mapInArrow(_records, _RECORDS_DDL)
    whole = records.filter("not crosses").select("file", "start", "row", "record")
    open_ranges = ranges.filter("opened or ends")
    if not open_ranges.isEmpty():
        pieces = stored(records.filter("crosses"), "csv-pieces")
        owned = pieces.join(ranges, ["file", "start"]).select(
            "file",
            F.when(F.col("row") < 0, F.col("owner")).otherwise(F.col("start")).alias("begin"),
            F.struct("start", "row", "record").alias("piece"),
        )
        # One group is one record. Its begin is the piece with a number.
        joined = owned.groupBy("file", "begin").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
        crossing = joined.select(
            "file", F.col("begin").alias("start"), F.array_max("pieces.row").alias("row"),
            F.array_join("pieces.record", "\n").alias("record"),
        )
        whole = whole.unionByName(crossing)
    heads = edges.filter("head is not null").select("file", "head")
    usual = heads.groupBy("head").count().orderBy(F.desc("count"), "head").first()
    usual = usual["head"] if usual else ",".join(columns)
    others = stored(heads.filter(F.col("head") != usual), "csv-heads")
    if others.isEmpty():
        named = whole.withColumn("head", F.lit(usual))
    else:
        named = whole.join(others, "file", "left").withColumn("head", F.coalesce("head", F.lit(usual)))
    rows = named.filter("start > 0 or row > 0").select(
        _parsed(columns, F.col("head"), F.col("record")).alias("values"), F.struct("file", "start", "row").alias("pos")
    )
    return rows.select(*[F.col("values")[i].alias(c) for i, c in enumerate(columns)], "pos")
