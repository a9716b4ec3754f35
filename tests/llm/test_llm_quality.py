import math
import random

import numpy as np
import pytest
from llm_cases import no_documents, odd_documents, words

from titleloom.llm import quality_resampling
from titleloom.llm.quality_resampling import kth_largest, ngram_counts, resample


def test_threshold_is_exact(spark):
    rng = random.Random(12)
    values = [rng.choice([rng.gauss(0, 1), 3.5, -1e-300, 1e12]) for _ in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    for k in (1, 7, 500, 1999, 2000, 5000):
        assert kth_largest(rows, "v", k) == sorted(values, reverse=True)[min(k, 2000) - 1]
    assert kth_largest(rows, "v", 0) is None


def test_counts_of_long_texts(monkeypatch):
    text = b"Ab, c d! ab  c " * 300
    whole = ngram_counts(text)
    assert whole.sum() == 2 * 300 * 7 - 1
    monkeypatch.setattr(quality_resampling, "_PIECE", 50)
    assert (ngram_counts(text) == whole).all()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(13)
    rows = [(i, words(rng, 60) if i % 5 else "%%% " + " ".join(rng.choice(["$$$", "&&&", "###", "zq"]) for _ in range(60))) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(0, 500, 3)] + [(1, 0), (None, 1), (99999, 1)], "doc_id bigint, quality int")
    return docs, labels


def test_junk_goes_first(corpus):
    docs, labels = corpus
    rows = {r.doc_id: r for r in resample(docs, labels, share=0.8).collect()}
    assert len(rows) == 500 and sum(r.selected for r in rows.values()) == 400
    unlabelled = [r for i, r in rows.items() if i % 3]
    good, junk = [r.selected for r in unlabelled if r.doc_id % 5], [r.selected for r in unlabelled if not r.doc_id % 5]
    assert np.mean(good) > 0.95 and np.mean(junk) < 0.1
    again = resample(docs.repartition(2), labels, share=0.8).collect()
    assert {r.doc_id: r.selected for r in again} == {i: r.selected for i, r in rows.items()}


def test_weights_are_ratios_of_models(corpus):
    docs, labels = corpus
    rows, good = docs.collect(), {r.doc_id for r in labels.filter("quality = 1").collect()}
    counts = {r.doc_id: ngram_counts(r.text.encode()) for r in rows}
    raw, target = sum(counts.values()), sum(counts[i] for i in counts if i in good)
    chance = [np.log((c + 1) / (c.sum() + len(c))) for c in (raw, target)]
    for r in resample(docs, labels).collect():
        want = counts[r.doc_id] @ (chance[1] - chance[0]) / counts[r.doc_id].sum()
        assert math.isclose(r.log_weight, want, rel_tol=1e-9, abs_tol=1e-12)


def test_odd_rows(spark, corpus):
    docs = odd_documents(spark)
    found = resample(docs, corpus[1], share=0.5).collect()
    assert len(found) == docs.count() and sum(r.selected for r in found) >= docs.count() / 2
    assert all(r.log_weight == 0 for r in found if r.doc_id in (1, 2, 3))
    assert {r.log_weight for r in resample(docs, corpus[1].limit(0)).collect()} == {0.0}
    assert resample(no_documents(spark), corpus[1]).count() == 0
