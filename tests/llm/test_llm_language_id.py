import random
import zlib

import pytest
from llm_cases import no_documents, odd_documents
from pyspark.sql import functions as F

from titleloom.llm import language_id
from titleloom.llm.language_id import features, identify_languages, keep_identified

SYLLABLES = {
    "en": "th he in er an re on at en nd ti es or te of", "de": "en er ch de ei ie in te ge un nd st ic be es",
    "fr": "es le en de re nt on er te la ou it eu qu ai", "es": "de en es el la os ar ue ra re er as on st ci", "fi": "en ta in an is tä ää la aa ka ll yt mi si ut",
}


def sentences(rng, lang, n):
    own = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(own) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    rows = [(i, sentences(rng, lang, rng.randrange(20, 80)), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=600))]
    return spark.createDataFrame([*rows, (9000, None, "en"), (9001, "1 2 %", "en"), (9002, "", "fi")], "doc_id bigint, text string, lang string")


def test_held_out_accuracy(corpus):
    found = identify_languages(corpus).join(corpus, "doc_id").collect()
    assert len(found) == 603
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1
        if row.doc_id >= 9000:
            assert (row.lang_pred, row.score) == ("und", 0.0)
    judged = [r for r in found if r.held_out and r.doc_id < 9000]
    assert sum(r.lang_pred == r.lang for r in judged) >= 0.97 * len(judged)


def test_labels_of_held_out_rows_change_nothing(corpus):
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = corpus.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    first = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(corpus).collect()}
    assert first == {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(other.repartition(3)).collect()}


def test_features_of_long_texts(monkeypatch):
    text = ("Ab cé 12, " * 500).encode()
    whole = features(text)
    monkeypatch.setattr(language_id, "_PIECE", 37)
    assert (features(text) == whole).all()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = identify_languages(docs).collect()
    assert len(found) == docs.count()
    undetermined = sorted(repr(r.doc_id) for r in found if r.lang_pred == "und")
    plain = [repr(r.doc_id) for r in docs.collect() if not any(c.isalpha() for c in r.text or "")]
    assert undetermined == sorted(plain)
    kept = keep_identified(docs, least=0.0)
    assert kept.columns == docs.columns and kept.count() == len(found) - len(plain)


def test_few_languages(spark):
    docs = odd_documents(spark)
    assert {r.lang_pred for r in identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert {r.lang_pred for r in identify_languages(docs.withColumn("lang", F.lit("en"))).collect()} == {"und", "en"}
    assert identify_languages(no_documents(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert keep_identified(unlabelled).count() == keep_identified(docs, least=0.0).count()
