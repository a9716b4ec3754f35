"""Pages of search results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titleloom.functions.text import result_label

PAGE_SIZE = 10


def numbered(results: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """Add ``position`` (from 1) and ``page`` (from 0) within each query."""
    order = Window.partitionBy("qid").orderBy(F.desc("similarity"), "id")
    placed = results.withColumn("position", F.row_number().over(order))
    return placed.withColumn("page", F.floor((F.col("position") - 1) / size).cast("int"))


def paginate(results: DataFrame, page: int, size: int = PAGE_SIZE) -> DataFrame:
    """Rows of one page of every query, with their labels. Pages count from 0.

    A search has at most its candidate limit of rows per query, which bounds the window.
    """
    shown = numbered(results, size).filter(F.col("position") <= (page + 1) * size)
    return shown.filter(F.col("page") == page).withColumn(
        "label", result_label(F.col("similarity"), F.col("title"))
    )


def page_counts(results: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """``(qid, results, pages)``."""
    return results.groupBy("qid").agg(
        F.count("*").alias("results"), F.ceil(F.count("*") / size).cast("bigint").alias("pages")
    )
