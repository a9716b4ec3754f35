from pyspark.sql import functions as F

from titleloom.plans import durable, ranking, sizing


def test_top_k_of_a_hot_key(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"), "id"
    )
    for k in (3, 1500):
        got = ranking.top_k(rows, ["key"], [F.col("id")], k, rank="rank").toPandas()
        want = rows.toPandas().sort_values("id").groupby("key").head(k)
        assert set(got.id) == set(want.id) and got["rank"].max() == min(k, 2000)
    assert ranking.top_k(rows, ["key"], [F.desc("id"), F.col("key")], 1100).count() == 1100 + 4000


def test_small_top_k_trims_before_the_shuffle(spark):
    plan = ranking.top_k(spark.range(100).withColumn("key", F.col("id") % 3), ["key"], [F.col("id")], 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_first_rows(spark, monkeypatch):
    rows = ranking.ordered_ids(spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")), [F.col("v")], "pos")
    rows = durable.stored(rows, "t")
    monkeypatch.setattr(ranking, "_SMALL_LIMIT", 10)
    for n in (0, 5, 11, 500, 999, 1000, 5000):
        got = ranking.first_rows(rows, "pos", n).toPandas()
        assert sorted(got.v) == list(range(min(n, 1000))), n


def test_lookup_join_both_ways(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    table = spark.createDataFrame([("hot", 1), ("3", 2)], "key string, v int")
    results = [
        {(r.id, r.v) for r in sizing.lookup_join(rows, table, "key", F.col("id"), small).collect()} for small in (True, False)
    ]
    assert results[0] == results[1] and len(results[0]) == 100
    salted = sizing.lookup_join(rows, table, "key", F.col("id"), False)
    assert set(salted.columns) == {"id", "key", "v"}


def test_fits(spark):
    rows = spark.range(10)
    assert sizing.fits(rows, F.lit(10), 100) and not sizing.fits(rows, F.lit(11), 100)
    assert sizing.fits(rows.limit(0), F.lit(10))


def test_shared_folder_is_the_configured_one(spark):
    assert durable.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = durable.stored(spark.range(3).select(F.col("id").alias("x")), "three")
    assert stored.count() == 3 and durable.shared_dir(spark) in stored.inputFiles()[0]
