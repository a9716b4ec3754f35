import heapq
import math
import random
import struct
import json
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import titleloom as tl
from titleloom.functions import huffman
from titleloom.operators import codec

TEXTS = "doc_id bigint, scope string, text string"


def least_bits(freqs):
    """Total bits of an optimal code, with a heap over weights."""
    heap = list(freqs)
    if len(heap) == 1:
        return heap[0]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def random_text(draw):
    alphabet = draw.choice(["ab", "abcdefgh \n", "añ😀\"\\\t", "".join(chr(c) for c in range(32, 800))])
    weights = [1 / (i + 1) for i in range(len(alphabet))]
    return "".join(draw.choices(alphabet, weights, k=draw.randint(1, 400)))


@pytest.mark.parametrize("text, bits, padding", [("aaaa", 4, 4), ("aab", 3, 5), ("abracadabra", 23, 1)])
def test_sizes(text, bits, padding):
    codes = huffman.code_table(Counter(text))
    assert sum(len(codes[c]) for c in text) == bits
    packed = huffman.pack(text, codes)
    assert packed[0] == padding and len(packed) == 1 + (bits + padding) // 8


def test_one_symbol():
    assert huffman.code_table({"a": 4}) == {"a": "0"}


def test_code_properties():
    draw = random.Random(1)
    for _ in range(200):
        freqs = Counter(random_text(draw))
        codes = huffman.code_table(freqs)
        total = sum(freqs.values())
        bits = sum(freqs[c] * len(code) for c, code in codes.items())
        assert bits == least_bits(freqs.values())
        ordered = sorted(codes.values())
        assert not any(b.startswith(a) for a, b in zip(ordered, ordered[1:]))
        if len(freqs) > 1:
            assert sum(2.0 ** -len(code) for code in codes.values()) == 1
            entropy = -sum(f / total * math.log2(f / total) for f in freqs.values())
            assert entropy - 1e-9 <= bits / total < entropy + 1


def test_ties_do_not_depend_on_input_order():
    items = [(c, 1 + i % 3) for i, c in enumerate("zyxwvutsrqp")]
    assert huffman.code_table(dict(items)) == huffman.code_table(dict(reversed(items)))


def test_long_codes_round_trip():
    # Fibonacci weights give the deepest tree.
    freqs, a, b = {}, 1, 1
    for i in range(60):
        freqs[chr(65 + i)] = a
        a, b = b, a + b
    codes = huffman.code_table(freqs)
    assert max(map(len, codes.values())) == 59
    text = "".join(freqs) * 3
    assert huffman.text_of(huffman.container_of(text, codes)) == text


def test_texts_longer_than_a_slice(monkeypatch):
    monkeypatch.setattr(huffman, "_SLICE", 7)
    monkeypatch.setattr(huffman, "_MEMO_LIMIT", 5)
    draw = random.Random(4)
    for _ in range(50):
        text = random_text(draw)
        blob = huffman.container_of(text, huffman.code_table(Counter(text)))
        assert huffman.text_of(blob) == text


def test_layout():
    codes = {"a": "0", "ñ": "10", "b": "11"}
    blob = huffman.container_of("abñ", codes)
    size = struct.unpack("<I", blob[:4])[0]
    assert json.loads(blob[4:4 + size]) == codes
    assert blob[4 + size] == 3 and blob[5 + size:] == bytes([0b01110000])


def test_char_frequencies(spark):
    docs = spark.createDataFrame([(1, "x", "a\r\nb"), (2, "x", "ñ😀ñ"), (3, "y", ""), (4, "y", None), (5, "y", "zz\r")], TEXTS)
    got = {(r.scope, r.ch): r.freq for r in tl.char_frequencies(docs, "scope").collect()}
    assert got == {("x", "a"): 1, ("x", "\n"): 1, ("x", "b"): 1, ("x", "ñ"): 2, ("x", "😀"): 1, ("y", "z"): 2, ("y", "\n"): 1}
    assert {r.scope for r in tl.char_frequencies(docs).collect()} == {"all"}


def corpus(spark):
    draw = random.Random(6)
    rows = [(i, draw.choice("xyz"), random_text(draw)) for i in range(60)]
    rows += [(100, "x", ""), (101, "x", None), (102, "w", ""), (103, "x", "l1\r\nl2\rl3")]
    return spark.createDataFrame(rows, TEXTS)


def test_codes_and_listing(spark):
    docs = corpus(spark)
    freqs = tl.char_frequencies(docs, "scope")
    codes = tl.huffman_codes(freqs)
    for scope in "xyz":
        rows = codes.filter(F.col("scope") == scope).collect()
        assert {r.ch: r.code for r in rows} == huffman.code_table({r.ch: r.freq for r in rows})
        bits = codec.coded_bits(codes).filter(F.col("scope") == scope).first().coded_bits
        assert bits == least_bits([r.freq for r in rows]) == sum(r.freq * r.code_len for r in rows)
    listed = [(r.scope, r.code_len) for r in tl.code_listing(codes).collect()]
    assert listed == sorted(listed)
    assert "'\\n'" in {r.char for r in tl.code_listing(codes).collect()}


def test_report_equals_real_containers(spark):
    docs = corpus(spark).filter("text is not null")
    codes = tl.huffman_codes(tl.char_frequencies(docs, "scope"))
    report = {r.scope: r for r in tl.compression_report(docs, codes, "scope").collect()}
    texts = {}
    for row in docs.orderBy("doc_id").collect():
        texts.setdefault(row.scope, []).append(row.text)
    for scope in "xyz":
        raw = "".join(texts[scope])
        text = raw.replace("\r\n", "\n").replace("\r", "\n")
        blob = huffman.container_of(text, huffman.code_table(Counter(text)))
        assert report[scope].original_bytes == len(raw.encode())
        assert report[scope].compressed_bytes == len(blob)
        assert report[scope].saving_pct == pytest.approx((1 - len(blob) / len(raw.encode())) * 100)
    assert report["w"].original_bytes == 0 and report["w"].saving_pct is None


@pytest.mark.parametrize("broadcast", [True, False])
def test_round_trip(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(codec, "fits", lambda *a, **k: False)
    docs = corpus(spark)
    codes = tl.huffman_codes(tl.char_frequencies(docs, "scope")).persist()
    packed = tl.compress_column(docs, codes, "scope")
    assert packed.columns == [*docs.columns, "blob"]
    got = tl.decompress_column(packed, name="back").collect()
    assert len(got) == docs.count()
    for row in got:
        text = row.text.replace("\r\n", "\n").replace("\r", "\n") if row.text else None
        assert row.back == text
        assert (row.blob is None) == (not row.text)


@pytest.mark.parametrize("broadcast", [True, False])
def test_round_trip_without_headers(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(codec, "fits", lambda *a, **k: False)
    docs = corpus(spark)
    codes = tl.huffman_codes(tl.char_frequencies(docs, "scope")).persist()
    packed = tl.compress_column(docs, codes, "scope", header=False)
    got = tl.decompress_column(packed, name="back", codes=codes, scope="scope").collect()
    assert len(got) == docs.count()
    for row in got:
        assert row.back == (row.text.replace("\r\n", "\n").replace("\r", "\n") if row.text else None)
    bits = codec.coded_bits(codes).agg(F.sum("coded_bits")).first()[0]
    size = packed.agg(F.sum(F.octet_length("blob")), F.count("blob")).first()
    assert bits / 8 <= size[0] <= bits / 8 + 2 * size[1]


def test_alone(spark):
    got = tl.decompress_column(tl.compress_alone(corpus(spark)), name="back").collect()
    for row in got:
        assert row.back == (row.text.replace("\r\n", "\n").replace("\r", "\n") if row.text else None)
        if row.text:
            text = row.back
            assert bytes(row.blob) == huffman.container_of(text, huffman.code_table(Counter(text)))


def test_counts_in_small_slices(spark, monkeypatch):
    draw = random.Random(4)
    rows = [(draw.choice(["a", "b", None]), random_text(draw)) for _ in range(60)] + [("a", ""), ("a", None)]
    batch = lambda part: pa.RecordBatch.from_arrays(
        [pa.array([s for s, _ in part], pa.string()), pa.array([t for _, t in part], pa.string())], ["scope", "text"]
    )
    monkeypatch.setattr(huffman, "_COUNT_SLICE", 37)
    monkeypatch.setattr(huffman, "_COUNTS_HELD", 50)
    found = Counter()
    for out in huffman.count_characters(map(batch, (rows[:20], rows[20:]))):
        for scope, ch, n in zip(*(column.to_pylist() for column in out.columns)):
            found[scope, ch] += n
    wanted = Counter((scope, ch) for scope, text in rows for ch in text or "")
    assert found == wanted


def test_a_large_text_gives_few_rows(spark):
    text = "añ😀\r\n" * 400_000
    docs = spark.createDataFrame([(text,)], "text string")
    counted = tl.char_frequencies(docs)
    assert {r.ch: r.freq for r in counted.collect()} == {c: 400_000 for c in "añ😀\n"}
    assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()
    back = tl.decompress_column(tl.compress_alone(docs), name="back").select(F.col("back") == F.replace("text", F.lit("\r\n"), F.lit("\n")))
    assert back.first()[0]


def test_texts_are_not_shuffled(spark):
    docs = corpus(spark)
    codes = tl.huffman_codes(tl.char_frequencies(docs, "scope")).persist()
    packed = tl.compress_column(docs, codes, "scope")
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert "Exchange" not in tl.compress_alone(docs)._jdf.queryExecution().executedPlan().toString()
