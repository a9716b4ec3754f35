import pytest
from pyspark.sql import functions as F

import titleloom as tl
from titleloom.operators.segments import SegmentedIndex
from titleloom.streaming.titles import arriving_pages, ingest_index, titles_of

SCHEMA = "id string, pos bigint, title string, url string"


def rows_of(batch, n, shift=0):
    """Titles of which some come again in later batches, with other words or none."""
    words = ["uno", "dos", "tres", "quatro", "cinco", "seis"]
    rows = []
    for i in range(n):
        own = (i * 7 + batch * shift) % 40
        title = " ".join([words[(own + k * (1 + batch)) % 6] for k in range(3)] + [f"w{(own * 3 + batch) % 11}"])
        rows.append((f"id{own}", batch * 1000 + i, "  " if own % 13 == 5 else title, f"u{batch}/{own}"))
    return rows


def contents(index):
    docs = index.docs.select("id", "pos", "title", "url", "sig").collect()
    keys = index.keys.select("id", "pos", "tree", "k0", "slots").collect()
    return sorted(map(repr, docs)), sorted(map(repr, keys))


def test_batches_equal_a_full_build(spark, tmp_path):
    batches = [rows_of(0, 25), rows_of(1, 20, 3), rows_of(2, 30, 5), [("id1", 5, "an earlier row that comes late", "u")], rows_of(4, 1)]
    index, everything = SegmentedIndex(spark, str(tmp_path / "index")), []
    asked = spark.createDataFrame([(i, row[2]) for i, row in enumerate(batches[0] + batches[2])], "qid bigint, query string")
    for number, batch in enumerate(batches):
        everything += batch
        assert index.add(spark.createDataFrame(batch, SCHEMA), batch=number)
        full = tl.build_index(spark.createDataFrame(everything, SCHEMA))
        assert contents(index.load()) == contents(full)
        if number in (1, 3):
            index.compact()
            assert contents(index.load()) == contents(full)
        if number == 3:
            index.clean()
            assert contents(index.load()) == contents(full)
    hits = lambda x: sorted(map(repr, tl.search(x, asked).collect()))
    assert hits(index.load()) == hits(full)


def test_a_batch_counts_once(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    first, second = (spark.createDataFrame(rows_of(n, 20, 3), SCHEMA) for n in (0, 1))
    assert index.add(first, batch=7) and index.add(second, batch=8)
    before = contents(index.load())
    index.compact()
    index.clean()
    assert not index.add(first, batch=7) and not index.add(second, batch=8)
    assert contents(index.load()) == before


def test_parts_without_a_log_row_do_not_count(spark, tmp_path, monkeypatch):
    """A writer that dies before the log is written leaves nothing that a reader sees, and its batch can come again."""
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    first, second = (spark.createDataFrame(rows_of(n, 20, 3), SCHEMA) for n in (0, 1))
    index.add(first)
    before = contents(index.load())
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda *args: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            index.add(second)
    assert (tmp_path / "index" / "keys" / "segment=1").exists()
    assert contents(index.load()) == before
    index.add(second)
    assert contents(index.load()) == contents(tl.build_index(first.unionByName(second)))


def test_removed_ids(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    index.add(spark.createDataFrame([("a", 0, "one two", None), ("b", 1, "three", None), ("c", 2, "four", None)], SCHEMA))
    gone = spark.createDataFrame([("a",), ("b",), ("x",), (None,)], "id string")
    index.add(spark.createDataFrame([("b", 3, "five", None)], SCHEMA), removed=gone)
    rows = lambda: sorted((row.id, row.pos, row.title) for row in index.load().docs.collect())
    assert rows() == [("b", 1, "five"), ("c", 2, "four")]
    assert {row.id for row in index.load().keys.collect()} == {"b", "c"}
    index.add(spark.createDataFrame([("a", 9, "again", None)], SCHEMA))
    assert rows() == [("a", 9, "again"), ("b", 1, "five"), ("c", 2, "four")]


def test_no_index_and_empty_batches(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    with pytest.raises(ValueError):
        index.load()
    index.compact()
    index.add(spark.createDataFrame([], SCHEMA))
    assert index.load().docs.count() == 0
    index.add(spark.createDataFrame(rows_of(0, 3), SCHEMA))
    index.add(spark.createDataFrame([], SCHEMA))
    assert index.load().docs.count() == 3


def test_only_the_batch_is_signed(spark, tmp_path):
    """What is there is read by id, place and text, not by signature, and filters reach the scan of the keys."""
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    for n in (0, 1):
        index.add(spark.createDataFrame(rows_of(n, 20, 3), SCHEMA))
    plan = index.load().keys.filter("tree = 3 AND k0 = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(tree,3)" in plan and "EqualTo(k0,5)" in plan and "SortMergeJoin" not in plan


def test_streamed_batches(spark, tmp_path):
    """Pages that come in several files, indexed in several batches, and delivered again."""
    pages = [(i, f"http://a.com/{i % 30}", 200, "text/html", f"<h1>title {i % 7} of {i % 5}</h1>") for i in range(60)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, status int, content_type string, html string")
    frame.repartition(6).write.parquet(str(tmp_path / "pages"))
    arriving = arriving_pages(spark, str(tmp_path / "pages"), frame.schema, files_per_batch=1)
    path = str(tmp_path / "index")
    for marks in ("marks", "other-marks"):
        ingest_index(titles_of(arriving, once=False), path, str(tmp_path / marks), compact_after=4).awaitTermination()
        index = SegmentedIndex(spark, path)
        assert len(index.log()) > 3 and {row["oldest"] for row in index.log()} != {0}
        titles = tl.extract_titles(frame).select(F.col("page_id").alias("id"), F.col("page_id").alias("pos"), "url", "title")
        assert contents(index.load()) == contents(tl.build_index(titles))
