"""Plans by size: broadcasts behind a check of the measured size, small inputs dealt over all cores, small results gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.session import ship

BROADCAST_BYTES = 64 << 20
_SALTS = 32
_DEALT_BYTES_A_CORE, _DEALT_BYTES = 32 << 20, 8 << 30
#: Rows of a few keys and numbers that one task writes.
ROWS_A_FILE = 1 << 20


def fits(df: DataFrame, row_bytes: Column, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all rows of a stored table stay within ``limit`` bytes."""
    total = df.agg(F.sum(row_bytes.cast("bigint"))).first()[0]
    return (total or 0) <= limit


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, spread: Column, small: bool
) -> DataFrame:
    """Left join of a big table to one row per key.

    A small table is broadcast. Otherwise the key is salted, so that a key with a third of all
    rows is spread over many tasks; ``spread`` is what the salt is taken from.
    """
    if small:
        return rows.join(F.broadcast(table), key, "left")
    salts = F.array(*[F.lit(i) for i in range(_SALTS)])
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(_SALTS)).cast("int"))
    copies = table.withColumn("_salt", F.explode(salts))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def estimated_bytes(rows: DataFrame) -> int:
    """Size that Spark estimates for a plan."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dealt(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows of a small input over all cores, for a step behind it that takes long for each row.

    A small table is often one file with one row group, hence one task. ``tasks`` is the number to deal over; 0
    leaves rows where they are. By default that is done for inputs which Spark estimates above 32 MiB a core, or 8 GiB:
    they have splits enough, and are never shuffled for this.
    """
    cores = ship(rows.sparkSession).sparkContext.defaultParallelism
    if tasks is None:
        tasks = 2 * cores if estimated_bytes(rows) < min(cores * _DEALT_BYTES_A_CORE, _DEALT_BYTES) else 0
    return rows.repartition(tasks) if tasks else rows


def gathered(rows: DataFrame, most_rows: int) -> DataFrame:
    """Narrow rows, ``most_rows`` at most, in the tasks that they fill, but in one for each core at least.

    For working tables behind a shuffle. Where Spark does not join small partitions itself, every partition writes a
    file, however few rows it has, and Hadoop's local store starts two processes of the executor for each file.
    """
    cores = ship(rows.sparkSession).sparkContext.defaultParallelism
    return rows.coalesce(max(cores, -(-most_rows // ROWS_A_FILE)))
