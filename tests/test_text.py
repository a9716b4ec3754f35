import random

import pandas as pd
from pyspark.sql import functions as F

from titleloom.functions import text

AWKWARD = [
    "  Hola  Mundo ", "a b", "a b", "a\u001cb", "a\u0085b", "a　b", "Hola, hola", "",
    "   ", "ΟΔΟΣ οδος", "İstanbul", "Straße", "﻿x", "a​b", "😀 😀 x", "\t\n\r", "a b",
]


def rows(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, s string")


def random_strings(count):
    draw = random.Random(7)
    alphabet = "abAB ñÑéÉ\t\n  \u001f.,-'\"ßΣς😀"
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 12))) for _ in range(count)]


def test_tokens_equal_python_split(spark):
    values = AWKWARD + random_strings(400)
    got = rows(spark, values).select("n", text.tokens(F.col("s")).alias("t"), text.has_tokens(F.col("s")).alias("h"))
    for row in got.collect():
        expected = set(values[row.n].lower().split())
        assert set(row.t) == expected and len(row.t) == len(expected), values[row.n]
        assert row.h == bool(expected)


def test_tokens_of_null(spark):
    row = rows(spark, [None]).select(text.tokens(F.col("s")).alias("t"), text.has_tokens(F.col("s")).alias("h")).first()
    assert row.t == [] and row.h is False


def test_missing_titles_are_those_of_a_csv_reader(spark, tmp_path):
    values = text.NA_TITLES + ["none", "NONE", " NA", "0", "nan.", "Null", "x"]
    path = tmp_path / "t.csv"
    path.write_text("id,title\n" + "".join(f"{i},{v}\n" for i, v in enumerate(values)))
    kept = set(pd.read_csv(path).dropna(subset=["title"])["id"])
    got = rows(spark, values).filter(text.has_title(F.col("s"))).select("n").collect()
    assert {r.n for r in got} == kept


def test_strip_equals_python(spark):
    values = AWKWARD + random_strings(200)
    for row in rows(spark, values).select("n", text.strip(F.col("s")).alias("t")).collect():
        assert row.t == values[row.n].strip()


def test_newlines(spark):
    got = rows(spark, ["a\r\nb\rc\n\r"]).select(text.unix_newlines(F.col("s"))).first()[0]
    assert got == "a\nb\nc\n\n"


def test_printable_char(spark):
    got = rows(spark, ["\n", "\t", " ", "x"]).orderBy("n").select(text.printable_char(F.col("s"))).collect()
    assert [r[0] for r in got] == [r"'\n'", r"'\t'", "' '", "'x'"]


def test_labels_round_as_python_does(spark):
    values = [(k, k / 128, f"t{k}") for k in range(129)] + [(200, 0.5, None)]
    got = spark.createDataFrame(values, "k int, sim double, title string").select(
        "k", "sim", text.result_label(F.col("sim"), F.col("title")).alias("label"), "title"
    )
    for row in got.collect():
        assert row.label == f"[{row.sim * 100:.1f}%] {row.title or 'Sin Título'}"
