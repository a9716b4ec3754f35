"""Tables that lie in hash buckets of their key, so that joins by it do not move them."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from titleloom.plans.sizing import estimated_bytes

_BUCKET_BYTES = 32 << 20


def bucket_count(source: DataFrame) -> int:
    """As many buckets as a shuffle has partitions, and fewer for a small source.

    With as many, what an aggregate has shuffled meets the buckets as it is.
    """
    most = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, -(-estimated_bytes(source) // _BUCKET_BYTES)))


class BucketedTable:
    """Rows in ``buckets`` hash buckets of ``key`` under a folder of Parquet files; rows can be appended.

    Spark knows of the buckets through an entry of its catalog. ``close`` takes the entry away and leaves the
    files; a new object with the same path, schema and count reads them again, in another session too.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int):
        self.spark, self.schema, self.key, self.buckets = spark, schema, key, buckets
        self.name = f"titleloom_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
        place = json.dumps(path)
        spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"
            f" LOCATION {place}"
        )

    def append(self, rows: DataFrame) -> None:
        """Add rows; each bucket gets one more file."""
        dealt = rows.select(*self.schema.names).repartition(self.buckets, self.key)
        dealt.write.insertInto(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
