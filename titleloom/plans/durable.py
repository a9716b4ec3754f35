"""Intermediate tables that outlive the loss of executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from titleloom.session import ship

#: Folder of a local session without a setting, and the working tables made so far, by application.
_own: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for working tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own, once per session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _own:
            _own[application] = tempfile.mkdtemp(prefix="titleloom-")
            atexit.register(shutil.rmtree, _own[application], ignore_errors=True)
        folder = _own[application]
    return folder.rstrip("/")


def working_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark reaches by its path; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reaches by it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Working tables made inside are removed at the end. Results read from them, so write those inside."""
    made = _made.setdefault(spark.sparkContext.applicationId, [])
    begin = len(made)
    try:
        yield
    finally:
        for path in made[begin:]:
            remove_folder(spark, path)
        del made[begin:]


def clear_working_tables(spark: SparkSession) -> None:
    """Remove all working tables that this application has made."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        remove_folder(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a working table and go on from there.

    The plan starts anew at the table, and Catalyst knows its true size for later joins.
    """
    return stored_at(df, working_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """The same at a path; a table that an earlier attempt left there is written over."""
    spark = ship(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
