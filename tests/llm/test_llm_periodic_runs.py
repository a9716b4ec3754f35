from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from llm_cases import no_documents, odd_documents
from pyspark.sql import functions as F

from titleloom.llm.periodic_runs import collapse_runs, find_runs, periodic_runs
from titleloom.llm.queries import looped


def plain_runs(words, least=12):
    """Every period at every place."""
    found = {}
    for period in range(1, len(words)):
        at = 0
        while at + period < len(words):
            begin = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            end = at + period
            if at > begin and end - begin >= max(least, 2 * period):
                found.setdefault((begin, end), period)
            at += 1
    return sorted((begin, end - begin, period) for (begin, end), period in found.items())


def plain_collapse(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def random_words(rng):
    letters, n = rng.choice([1, 2, 2, 3, 8, 40]), rng.randrange(0, 110)
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3) if n else 0):
        begin, period = rng.randrange(n), rng.randrange(1, 40)
        for i in range(begin + period, min(n, begin + rng.randrange(1, 100))):
            words[i] = words[i - period]
    return words


@pytest.mark.parametrize("least", [2, 12, 17])
def test_runs_equal_those_of_every_period_at_every_place(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 5))]
        ends = np.cumsum([len(words) for words in texts])
        begin, end, period = periodic_runs(np.array(sum(texts, []), np.int64), ends, least)
        got = [(b, e - b, p) for b, e, p in zip(begin.tolist(), end.tolist(), period.tolist(), strict=True)]
        want = [(b + int(e) - len(words), n, p) for words, e in zip(texts, ends, strict=True) for b, n, p in plain_runs(words, least)]
        assert got == sorted(want, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("period", [1, 2, 3, 7, 1000, 49_999])
def test_long_periodic_texts_are_one_run(period):
    words = np.arange(100_000) % period
    begin, end, found = periodic_runs(words, np.array([len(words)]))
    assert (begin.tolist(), end.tolist(), found.tolist()) == ([0], [100_000], [period])


def test_rows_and_collapsed_texts(spark):
    docs = odd_documents(spark).unionByName(odd_documents(spark).withColumn("text", F.concat_ws("\t \n", "text", "text", "text")))
    assert find_runs(docs).count() == docs.count()
    by_text = {(doc["doc_id"], doc["text"]) for doc in docs.collect()}
    small = {(i, text) for i, text in by_text if len(text or "") < 5000}
    rows = spark.createDataFrame(sorted(small, key=repr), "doc_id bigint, text string")
    for text, row in zip(rows.select("text").toPandas()["text"], find_runs(rows).collect(), strict=True):
        words = (text or "").split()
        runs = plain_runs(words)
        assert row["n_words"] == len(words)
        assert [tuple(run) for run in row["runs"]] == sorted(runs, key=lambda run: (run[0], run[2]))
        assert row["collapsed"] == plain_collapse(words, runs)


def test_only_the_characters_of_the_contract_separate_words(spark):
    text = " ".join(["a b c\x1cd"] * 12)
    (row,) = find_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert (row["n_words"], [tuple(run) for run in row["runs"]], row["collapsed"]) == (12, [(0, 12, 1)], "a b c\x1cd")


def test_collapse_keeps_columns_and_other_texts(spark):
    docs = odd_documents(spark).withColumn("collapsed", F.lit(1)).withColumn("runs", F.lit(2)).withColumn("n_words", F.lit(3))
    again = docs.filter("doc_id = 4").withColumn("text", F.array_join(F.array_repeat("text", 3), " "))
    done = collapse_runs(docs.unionByName(again))
    assert done.schema.simpleString() == docs.schema.simpleString()
    want = docs.union(docs.filter("doc_id = 4")).withColumn(
        "text", F.when(F.col("doc_id") == 10, "Ünï cödé \U0001f600").otherwise(F.col("text"))
    )
    assert sorted(map(repr, done.collect())) == sorted(map(repr, want.collect()))


def test_no_rows(spark):
    assert find_runs(no_documents(spark)).collect() == []
    assert collapse_runs(no_documents(spark)).collect() == []


def test_the_query_rewrites_a_tenth_of_the_texts(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 60))) for i in range(200)] + [(None, "a b"), (1, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def plain(i, text):
        h = zlib.crc32(str(i).encode())
        words = (text or "").split()
        n, g = len(words), h // 10
        if i is None or h % 10 or not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))

    want = [(i, plain(i, text)) for i, text in rows]
    assert sum(a != b for a, b in zip(want, rows, strict=True)) > 5
    assert [tuple(row) for row in looped(docs).collect()] == want
