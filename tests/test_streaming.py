import time
from datetime import timedelta

import titleloom as tl
from titleloom.streaming.titles import arriving_pages, expiring_state, ingest, titles_of

PAGES = "page_id bigint, url string, html string"


def drop(spark, folder, rows):
    spark.createDataFrame(rows, PAGES).coalesce(1).write.mode("append").parquet(str(folder))


def test_two_drops_equal_one_batch(spark, tmp_path):
    first = [(i, f"http://a.com/{i}", f"<h1>t{i} &amp;</h1>") for i in range(5)] + [(9, "http://a.com/9", "<p>")]
    second = [(i, f"http://a.com/{i}", f"<h1>t{i}</h1>") for i in range(5, 8)]
    for rows in (first, second):
        drop(spark, tmp_path / "in", rows)
        stream = titles_of(arriving_pages(spark, str(tmp_path / "in"), files_per_batch=1))
        ingest(stream, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    batch = tl.extract_titles(spark.read.parquet(str(tmp_path / "in")))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_a_url_counts_once_over_arrivals(spark, tmp_path):
    drops = [
        [(1, "http://a.com/1", "<h1>first</h1>"), (2, "http://a.com/2/", "<p>no title</p>")],
        [(3, "http://a.com/1#x", "<h1>again</h1>"), (4, "http://a.com/2", "<h1>late</h1>"), (5, "http://a.com/3", "<h1>new</h1>")],
    ]
    for rows in drops:
        drop(spark, tmp_path / "in", rows)
        stream = titles_of(arriving_pages(spark, str(tmp_path / "in")))
        ingest(stream, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.page_id, r.title) for r in got} == {(1, "first"), (5, "new")}


def test_arrival_time_bounds_the_state(spark, tmp_path):
    schema = PAGES + ", at timestamp"
    rows = spark.sql(
        "select * from values (1L, 'http://a.com/1', '<h1>a</h1>', timestamp'2024-01-01 00:00:00'),"
        " (2L, 'http://a.com/1', '<h1>b</h1>', timestamp'2024-01-01 00:10:00') as t(page_id, url, html, at)"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = titles_of(arriving_pages(spark, str(tmp_path / "in"), schema), arrival="at", delay="1 hour")
    ingest(stream, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    assert [r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["http://a.com/1"]


def test_urls_are_forgotten_after_a_time(spark, tmp_path):
    """Within the time a URL counts once; behind it the URL counts anew, and state has shrunk."""

    def arrive(rows, remember):
        drop(spark, tmp_path / "in", rows)
        with expiring_state(spark):
            stream = titles_of(arriving_pages(spark, str(tmp_path / "in")), remember=remember)
            query = ingest(stream, str(tmp_path / "out"), str(tmp_path / "marks"))
        query.awaitTermination()
        return query.recentProgress[-1].stateOperators[0].numRowsTotal

    setting = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    many = [(i, f"http://a.com/{i}", f"<h1>t{i}</h1>") for i in range(40)]
    wait = timedelta(seconds=20)
    began = time.monotonic()
    assert arrive([*many, (90, "http://a.com/0#x", "<h1>copy</h1>")], wait) >= 40
    ended = time.monotonic()
    arrive([(100, "http://a.com/1", "<h1>soon</h1>")], wait)
    soon = time.monotonic() - began < 20
    time.sleep(max(0, 24 - (time.monotonic() - ended)))
    left = arrive([(101, "http://a.com/2", "<h1>late</h1>"), (102, "http://b.com", "<h1>new</h1>")], wait)
    got = [(r.page_id, r.title) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("page_id").collect()]
    assert got[:40] == [(i, f"t{i}") for i in range(40)]
    assert got[-2:] == [(101, "late"), (102, "new")]
    assert len(got) == 42 or not soon
    assert left < 40
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == setting
