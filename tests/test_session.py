import pyarrow as pa

from titleloom.session import _BATCH_BYTES, ship


def _most_bytes(df):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    return max(r.n for r in df.mapInArrow(sizes, "n bigint").collect())


def test_python_gets_bounded_batches(spark):
    other = spark.newSession()
    rows = other.range(4000, numPartitions=1).selectExpr("repeat('abcdefghij', 500) as text")
    ship(other)
    assert _most_bytes(rows) < 5 << 20
    own = spark.newSession()
    own.conf.set(_BATCH_BYTES, str(64 << 20))
    assert ship(own).conf.get(_BATCH_BYTES) == str(64 << 20)
