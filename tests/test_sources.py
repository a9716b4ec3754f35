import csv
import io
import random
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

import titleloom as tl
from titleloom.functions import huffman
from titleloom.operators.index import last_documents
from titleloom.sources import containers, csv_splits, tables

CSV = (
    "id,title,url\n"
    "1,Uno dos,http://a.com/1\n"
    '1,"Tres, ""cuatro""\nlinea",\n'
    "1,   ,http://a.com/2\n"
    "2,None,http://a.com/3\n"
    "3,none,http://a.com/4\n"
    "4,,http://a.com/5\n"
)
WANTED = [
    ("1", "Uno dos", "http://a.com/1"),
    ("1", 'Tres, "cuatro"\nlinea', None),
    ("1", "   ", "http://a.com/2"),
    ("2", "None", "http://a.com/3"),
    ("3", "none", "http://a.com/4"),
    ("4", None, "http://a.com/5"),
]


def check(frame):
    rows = frame.orderBy("pos").collect()
    assert [(r.id, r.title, r.url) for r in rows] == WANTED
    kept = {(r.id, r.title, r.url) for r in last_documents(frame).collect()}
    assert kept == {("1", 'Tres, "cuatro"\nlinea', None), ("3", "none", "http://a.com/4")}


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text(CSV)
    check(tables.read_titles_csv(spark, str(tmp_path / "t.csv")))
    kept = pd.read_csv(tmp_path / "t.csv").dropna(subset=["title"])
    assert list(kept["id"]) == [1, 1, 1, 3]


def test_ids_of_any_kind(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,title,url\nx-1,Uno dos,u\n007,\"a \"\"b\"\"\",u\n")
    for multi_line in (True, False):
        rows = tables.read_titles_csv(spark, str(tmp_path / "t.csv"), multi_line).collect()
        assert [(r.id, r.title) for r in rows] == [("x-1", "Uno dos"), ("007", 'a "b"')]


def test_large_csv_is_read_in_splits(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,title,url\n" + "".join(f"{i},title {i},u\n" for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = tables.read_titles_csv(spark, str(tmp_path / "t.csv"), multi_line=False)
        assert rows.rdd.getNumPartitions() > 4 and rows.count() == 50_000
        ids = [r.id for r in rows.orderBy("pos").select("id").collect()]
        assert ids == [str(i) for i in range(50_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_container_without_a_column(spark, tmp_path):
    text = "id,title\n5,Uno\n"
    (tmp_path / "t.bin").write_bytes(huffman.container_of(text, huffman.code_table(Counter(text))))
    row = containers.read_titles_container(spark, str(tmp_path)).first()
    assert (row.id, row.title, row.url) == ("5", "Uno", None)


def test_csv_container(spark, tmp_path):
    (tmp_path / "t.bin").write_bytes(huffman.container_of(CSV, huffman.code_table(Counter(CSV))))
    check(containers.read_titles_container(spark, str(tmp_path)))
    row = containers.read_container_text(spark, str(tmp_path)).first()
    assert row.text == CSV and row.path.endswith("t.bin")


def test_container_in_many_batches(spark, tmp_path, monkeypatch):
    text = "id,url,title\n" + "".join(f"{i},u{i},título {i}\n" for i in range(25_000))
    (tmp_path / "t.bin").write_bytes(huffman.container_of(text, huffman.code_table(Counter(text))))
    rows = containers.read_titles_container(spark, str(tmp_path))
    assert rows.count() == 25_000
    assert rows.orderBy(F.desc("pos")).first().title == "título 24999"


def test_file_order_gives_row_order(spark, tmp_path):
    for name, title in (("a", "viejo"), ("b", "nuevo")):
        (tmp_path / f"{name}.csv").write_text(f"id,title,url\n7,{title} {'x' * (90 if name == 'b' else 5)},u\n")
    docs = last_documents(tables.read_titles_csv(spark, str(tmp_path)))
    assert docs.first().title.startswith("nuevo")
    assert tl.build_index(tables.read_titles_csv(spark, str(tmp_path))).count().first()[0] == 1


def test_text_round_trip(spark, tmp_path):
    texts = spark.createDataFrame([("uno\ndos ñ",)], "text string")
    tables.write_text(texts.coalesce(1), str(tmp_path / "out"))
    row = tables.read_text(spark, str(tmp_path / "out")).first()
    assert row.text == "uno\ndos ñ\n"


def test_append(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u", "t")], "page_id long, url string, title string")
    for _ in range(2):
        tables.append_titles(rows, str(tmp_path / "titles"))
    got = spark.read.parquet(str(tmp_path / "titles"))
    assert got.columns == ["url", "title"] and got.count() == 2


def test_stored_containers(spark, tmp_path):
    docs = tl.compress_alone(spark.createDataFrame([("p", "hola")], "path string, text string"))
    containers.write_containers(docs.select("path", "blob"), str(tmp_path / "c"))
    back = tl.decompress_column(spark.read.parquet(str(tmp_path / "c")))
    assert back.first().text == "hola"


def test_json_lines(spark, tmp_path):
    hits = spark.createDataFrame([(1, "2", "t", "u", 0.5)], "qid long, id string, title string, url string, similarity double")
    tables.write_json(hits, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().similarity == 0.5


def written_csv(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def test_line_breaks_in_quotes_across_splits(spark, tmp_path):
    """One file in many tasks gives what one reader of the whole file gives."""
    pick = random.Random(3)
    word = lambda: "".join(pick.choice('ab",\n é') for _ in range(pick.choice([0, 3, 9, 60])))
    rows = [[str(n), word(), word()] for n in range(600)]
    rows[300][1] = '"x,\n' * 3000  # longer than several splits
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(written_csv([["id", "title", "url"], *rows]).encode())
    turned = [[r[2], "-", r[0], r[1]] for r in rows[:200]]
    (tmp_path / "in" / "b.csv").write_bytes(("\ufeff\n" + written_csv([["url", "more", "id", "title"], *turned], "\r\n")).encode())
    (tmp_path / "in" / "empty.csv").write_bytes(b"")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
    try:
        lines = spark.read.text(str(tmp_path / "in" / "a.csv"), lineSep="\n")
        assert lines.rdd.getNumPartitions() > 10
        got = tables.read_titles_csv(spark, str(tmp_path / "in")).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = [tuple(v or None for v in (r[0], r[2], r[1])) for r in rows + rows[:200]]
    assert [(r.id, r.url, r.title) for r in got] == wanted


def test_values_and_open_quotes():
    pick = random.Random(5)
    for _ in range(3000):
        record = [("".join(pick.choice('ab",\n') for _ in range(pick.randint(0, 6)))) for _ in range(3)]
        text = written_csv([record])[:-1]
        state = False
        lines = text.split("\n")
        for line in lines[:-1]:
            state = csv_splits.ends_open(line, state)
            assert state
        assert not csv_splits.ends_open(lines[-1], state)
        assert csv_splits.values_of(text) == record
    assert csv_splits.values_of('a"b,"c"d,"e\n') == ['a"b', "cd", "e\n"]
    assert not csv_splits.ends_open('a"b,c', False) and csv_splits.ends_open('a,"b,c', False)


def test_a_quote_that_is_never_closed(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,title,url\n1,a,u\n2,"b,u\n3,c,u\n')
    rows = tables.read_titles_csv(spark, str(tmp_path / "t.csv")).orderBy("pos").collect()
    assert [(r.id, r.title, r.url) for r in rows] == [("1", "a", "u"), ("2", "b,u\n3,c,u", None)]


def test_text_files_stay_small_enough_to_be_read_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "_FILE_BYTES", 2000)
    rows = [("de" if i % 3 else None, f"text {i} " + "x" * (i % 90)) for i in range(400)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    path = str(tmp_path / "texts")
    tables.write_text(docs, path, by="lang")
    back = tables.read_text(spark, path).collect()
    assert max(len(r.text) for r in back) < 3000
    assert sorted(line for r in back for line in r.text.splitlines()) == sorted(text for _, text in rows)
    tables.write_text(docs.limit(0), str(tmp_path / "none"))
