"""CSV, text and page scans; title, text and JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleloom.sources.csv_splits import read_csv_records

TITLE_COLUMNS = ["id", "url", "title"]
PAGE_SCHEMA = "page_id bigint, url string, html string"
#: Bytes of text that a task writes, so that a file read whole is a row that workers can hold several copies of.
_FILE_BYTES = 16 << 20


def read_titles_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``(id, url, title, pos)`` from CSV files with a header, in any column order.

    Ids are strings as they stand. ``pos`` orders rows as they stand in the files. Values may hold doubled
    quotes, and line breaks with ``multi_line``. A large file is read in splits by many tasks either way;
    without ``multi_line`` that takes one scan, and no table is written.
    """
    if multi_line:
        return read_csv_records(spark, path, TITLE_COLUMNS)
    raw = spark.read.csv(path, header=True, escape='"', nullValue="", inferSchema=False)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(F.col("id").cast("string").alias("id"), "url", "title", place.alias("pos"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)``: one row per UTF-8 file."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def append_titles(titles: DataFrame, path: str) -> None:
    """Append ``(url, title)`` rows to a Parquet table, in one commit."""
    titles.select("url", "title").write.mode("append").parquet(path)


def append_titles_jdbc(titles: DataFrame, table: str, options: dict[str, str]) -> None:
    """Append ``(url, title)`` rows to a database table; connections are the connector's."""
    titles.select("url", "title").write.format("jdbc").options(dbtable=table, **options).mode(
        "append"
    ).save()


def write_text(texts: DataFrame, path: str, text: str = "text", by: str | None = None) -> None:
    """Write a text column as plain UTF-8 files, each text with a line end; ``by`` names a column for subfolders.

    Texts whose partitions hold much more than ``_FILE_BYTES`` are dealt over as many tasks as their size asks for.
    """
    keep = [by] if by else []
    rows = texts.select(F.col(text).alias("value"), *keep)
    held = rows.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("value") + 1).alias("held"))
    most, total = held.agg(F.max("held"), F.sum("held")).first()
    if (most or 0) > _FILE_BYTES:
        rows = rows.repartition(-(-total // _FILE_BYTES))
    (rows.write.partitionBy(by) if by else rows.write).text(path)


def write_json(hits: DataFrame, path: str) -> None:
    """Write search hits as JSON lines."""
    hits.write.json(path)
