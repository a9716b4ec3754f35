"""Session settings that the jobs rely on, and shipping of this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()
#: Bytes of rows that Python gets at a time, where the session does not say. A worker holds several copies of them.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH = 4 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package, once per application, and bound the batches of a session that sets no bound.

    Not needed where the package is installed on the cluster or passed with ``--py-files``, and the bound is set.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(_BATCH))
    if context.applicationId not in _shipped:
        archive = os.path.join(tempfile.mkdtemp(prefix="titleloom-code-"), "titleloom.zip")
        with zipfile.ZipFile(archive, "w") as bundle:
            for source in sorted(_PACKAGE.rglob("*.py")):
                bundle.write(source, source.relative_to(_PACKAGE.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark


def build_session(app: str = "titleloom", **settings: str) -> SparkSession:
    """Session with adaptive execution. Master, memory and partition counts stay the cluster's.

    Extra settings are given as keyword arguments with ``__`` for a dot.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return ship(builder.getOrCreate())
