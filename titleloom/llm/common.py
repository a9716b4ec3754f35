"""What several operators share."""

from __future__ import annotations

from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleloom.plans.durable import stored, working_path
from titleloom.session import ship

__all__ = ["blob", "other_columns_aside", "stored", "table", "text_or_empty", "working_path"]

#: Characters that separate words in the contracts that speak of white space: U+0020 and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, with this package on the executors."""
    return ship(spark).read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    """A text column as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def blob(column: pa.Array, i: int) -> bytes:
    """UTF-8 bytes of one string of an Arrow column; null is empty."""
    value = column[i].as_buffer()
    return value.to_pybytes() if value is not None else b""


def other_columns_aside(function):
    """For functions that take and return the columns of a table: columns of the input that begin with an underscore,
    as working columns do, have other names inside and their own in the result."""

    @wraps(function)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        named = {x for x in (*args, *options.values()) if isinstance(x, str)}
        taken, aside = {name.lower() for name in docs.columns}, {}
        for name in docs.columns:
            if name.startswith("_") and name not in named:
                other = "aside" + name
                while other.lower() in taken:
                    other = "x" + other
                taken.add(other.lower())
                aside[name] = other
        out = function(docs.withColumnsRenamed(aside), *args, **options)
        return out.withColumnsRenamed({other: name for name, other in aside.items()})

    return run
