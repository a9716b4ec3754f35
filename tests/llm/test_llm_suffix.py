import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import no_documents, odd_documents, plain_rows, words

from titleloom.llm import suffix_dedup
from titleloom.llm.suffix_dedup import anchors, remove_repeats


def plain_repeats(texts, length):
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for text in texts:
        covered = np.zeros(len(text) + 1, int)
        for i in range(len(text) - length + 1):
            if starts[text[i : i + length]] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        covered = np.cumsum(covered)[:-1] > 0
        kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
        runs = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        out.append((len(text), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_equal_strings_name_equal_places():
    rng = random.Random(9)
    passage = words(rng, 200).encode()
    for lead in (b"", b"q" * 37, words(rng, 300).encode()):
        data = np.frombuffer(lead + passage, np.uint8)
        place, gram, first, last = anchors(data, np.array([len(data)]), 400)
        inside = [(p - len(lead), g) for p, g, a, b in zip(place, gram, first, last, strict=True) if a >= len(lead)]
        named = {s: (p, g) for p, g, a, b in zip(place, gram, first, last, strict=True) for s in range(a, b + 1)}
        assert sorted(named) == list(range(len(data) - 399))
        if not lead:
            whole = {p: g for p, g in inside}
        assert set(inside) <= set(whole.items())


@pytest.mark.parametrize("shard", [1000, 2])
def test_passages_with_many_surroundings(spark, shard):
    rng = random.Random(10)
    passage, other = words(rng, 120), words(rng, 90)
    texts = []
    for i in range(40):
        a, b = sorted(rng.sample(range(len(passage)), 2))
        texts.append(words(rng, 30) + passage[a:b] + words(rng, 20) + (other if i % 3 else "") + words(rng, 5))
    texts += [passage + passage, "x" * 1500, "ab" * 700, "ab" * 250, other, other, "é" * 399, "é" * 199 + "x", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = plain_repeats([(t or "").encode() for t in texts], 400)
    found = remove_repeats(docs, shard=shard).drop("kept")
    assert plain_rows(found) == sorted(((i, *w) for i, w in enumerate(want)), key=repr)


def test_odd_rows(spark, monkeypatch):
    docs = odd_documents(spark)
    rows = docs.collect()
    want = plain_repeats([(r.text or "").encode() for r in rows], 400)
    found = remove_repeats(docs)
    assert plain_rows(found.drop("kept")) == sorted(((r.doc_id, *w) for r, w in zip(rows, want, strict=True)), key=repr)
    for row in found.filter("kept is not null").collect():
        assert hashlib.sha256(row.kept).hexdigest() == row.kept_sha256


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(11)
    text = (words(rng, 400) * 2).encode()
    whole = [(a, b, g) for _, g, a, b in zip(*anchors(np.frombuffer(text, np.uint8), np.array([len(text)]), 400), strict=True)]
    named = {s: g for a, b, g in whole for s in range(a, b + 1)}
    monkeypatch.setattr(suffix_dedup, "_PIECE", 1 << 10)
    again = {}
    for _, offsets, parts in suffix_dedup._pieces([text], 400):
        ends = np.cumsum([len(p) for p in parts])
        for _, g, a, b in zip(*anchors(np.frombuffer(b"".join(parts), np.uint8), ends, 400), strict=True):
            at = int(np.searchsorted(ends, a, "right"))
            shift = offsets[at] - (ends[at] - len(parts[at]))
            again.update({int(s + shift): g for s in range(a, b + 1)})
    assert sorted(again) == sorted(named)


@pytest.mark.parametrize("piece", [1 << 10, 1423])
def test_nothing_repeats_at_edges_of_pieces(spark, piece):
    rng = random.Random(12)
    once, shared = words(rng, 3000), words(rng, 300)
    texts = [once, words(rng, 700) + shared + words(rng, 500), words(rng, 400) + shared, words(rng, 150)[:piece]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = plain_repeats([t.encode() for t in texts], 400)
    assert want[0][1] == 0
    found = remove_repeats(docs, piece=piece).drop("kept")
    assert plain_rows(found) == sorted(((i, *w) for i, w in enumerate(want)), key=repr)


def periodic_texts(rng):
    line, block = "-" * 60 + "\n", words(rng, 60)[:300]
    rows = "|" + "-" * 70 + "+" + "-" * 70 + "|\n"
    return [
        "x" * 5000, "x" * 400, "x" * 399 + "y", "ab" * 3000, "b" + "ab" * 200, line * 90, "q" + line * 7, rows * 40, rows * 3,
        block * 12, block[50:] + block[:50], words(rng, 300) + "=" * 2500 + words(rng, 200), "=" * 450 + words(rng, 90),
        "ab" * 900 + "abc" * 900 + "c" * 700, line * 20 + rows * 20 + line * 20, (words(rng, 8) + "." * 700) * 6, "z" * 1201,
    ]


@pytest.mark.parametrize("piece", [1 << 20, 2048])
def test_short_periods(spark, piece):
    texts = periodic_texts(random.Random(13))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = plain_repeats([t.encode() for t in texts], 400)
    found = remove_repeats(docs, piece=piece).drop("kept")
    assert plain_rows(found) == sorted(((i, *w) for i, w in enumerate(want)), key=repr)


def test_stretches_leave_few_anchors():
    rng = random.Random(14)
    for text in ("-" * (1 << 20), ("-" * 79 + "\n") * 13000, words(rng, 300) + "\0" * 500_000):
        data = np.frombuffer(text.encode(), np.uint8)
        stretches = []
        place, _, first, last = anchors(data, np.array([len(data)]), 400, stretches)
        assert len(stretches) == 1
        begin, end, period = stretches[0]
        assert text[begin : end - period] == text[begin + period : end] and end == len(text)
        assert (last - first + 400).sum() < 80_000 and len(place) < 200


def test_a_long_text_of_one_character(spark):
    docs = spark.createDataFrame([(1, "-" * 10_000_000), (2, "-" * 400 + "a"), (3, "-" * 399)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()}
    assert found[1][1:] == (10_000_000, 10_000_000, 1)
    assert found[2][1:] == (401, 400, 1) and found[3][1:] == (399, 0, 0)


def test_empty(spark):
    assert remove_repeats(no_documents(spark)).count() == 0
