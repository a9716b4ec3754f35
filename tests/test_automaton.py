import json
import random
from collections import Counter


import pytest

from titleloom.functions import automaton, huffman
from titleloom.functions.automaton import NARROW, WIDE, Forest

ALPHABETS = ["a", "ab", "abcdefgh", "abcdefgh \n", "añ😀\"\\\t", "".join(chr(c) for c in range(32, 500)), "".join(chr(0x4E00 + c) for c in range(128))]


def random_text(draw, n):
    alphabet = draw.choice(ALPHABETS)
    weights = None if draw.random() < 0.4 else [1 / (i + 1) for i in range(len(alphabet))]
    return "".join(draw.choices(alphabet, weights, k=n))


def walked(packed, codes):
    """Bit by bit."""
    chars, out, at = {code: ch for ch, code in codes.items()}, [], ""
    bits = "".join(f"{byte:08b}" for byte in packed[1:])
    for bit in bits[:len(bits) - packed[0]]:
        at += bit
        if at in chars:
            out.append(chars[at])
            at = ""
    return "".join(out).encode()


@pytest.mark.parametrize("guesses", [0, 16])
@pytest.mark.parametrize("segment", [1, 3, 128])
@pytest.mark.parametrize("width", [WIDE, NARROW])
def test_texts_under_many_codes(monkeypatch, width, segment, guesses):
    """Without guesses every state is followed through every segment."""
    monkeypatch.setattr(automaton, "SEGMENT", segment)
    monkeypatch.setattr(automaton, "_GUESSES", guesses)
    draw = random.Random(segment)
    for _ in range(12):
        forest, packed, trees, texts = Forest(), [], [], []
        for _ in range(draw.randint(1, 5)):
            text = random_text(draw, draw.choice([1, 5, 60, 700]))
            codes = huffman.code_table(Counter(text))
            tree = forest.add(codes)
            for part in (text, text[: len(text) // 2 + 1], text[::-1]):
                texts.append(part.encode())
                packed.append(huffman.pack(part, codes))
                trees.append(tree)
        assert forest.automaton(width).decode(packed, trees) == texts


def test_bits_that_no_code_begins_with_end_a_text():
    codes = {"a": "00", "b": "01"}
    forest = Forest()
    forest.add(codes)
    packed = b"\0" + bytes([0b00010010, 0b00000000])
    assert forest.automaton(WIDE).decode([packed], [0]) == [walked(packed, codes)] == [b"aba"]


def test_codes_that_never_meet():
    """Codes of equal lengths stay out of step, and so does this one of lengths two and four."""
    draw = random.Random(8)
    even = {"a": "00", "b": "01", "c": "10", "d": "1100", "e": "1101", "f": "1110", "g": "1111"}
    for codes in (even, {chr(65 + i): f"{i:03b}" for i in range(8)}, {chr(0x4E00 + i): f"{i:011b}" for i in range(2048)}):
        text = "".join(draw.choices(list(codes), k=20_000))
        forest = Forest()
        forest.add(codes)
        for width in (WIDE, NARROW):
            assert forest.automaton(width).decode([huffman.pack(text, codes)], [0]) == [text.encode()]


def test_pieces_end_with_whole_symbols():
    text = random_text(random.Random(3), 5000)
    codes = huffman.code_table(Counter(text))
    forest = Forest()
    forest.add(codes)
    packed = huffman.pack(text, codes)
    for size in (1, 7, 1000, 10**6):
        pieces = list(forest.automaton(WIDE).pieces(packed, 0, size))
        assert len(pieces) == -(-(len(packed) - 1) // size)
        assert "".join(piece.decode() for piece in pieces) == text


def test_no_work_for_each_byte(monkeypatch):
    """The number of steps of a walk does not grow with the text."""
    steps = []
    text = "".join(random.Random(1).choices("abcdefg", [40, 20, 10, 5, 3, 2, 1], k=400_000))
    codes = huffman.code_table(Counter(text))
    forest = Forest()
    forest.add(codes)
    machine = forest.automaton(WIDE)
    first = machine._first
    monkeypatch.setattr(machine, "_first", lambda *args: (steps.append(int(args[3].max())), first(*args)))
    assert machine.decode([huffman.pack(text, codes)], [0]) == [text.encode()]
    assert steps == [automaton.SEGMENT]


def test_packing_together_equals_packing_alone(monkeypatch):
    monkeypatch.setattr(huffman, "_LOAD", 300)
    draw = random.Random(2)
    for _ in range(40):
        texts = [random_text(draw, draw.choice([1, 2, 90, 2000])) for _ in range(6)]
        codes = huffman.code_table(Counter("".join(texts)))
        packed = huffman.pack_texts(texts, codes)
        assert packed == [huffman.pack(text, codes) for text in texts]
        header = json.dumps(codes).encode()
        assert huffman.unpack_texts(packed, [header] * 6) == [text.encode() for text in texts]
    with pytest.raises(ValueError):
        huffman.pack_texts(["ab"], {"a": "0", "c": "1"})


def test_many_tables_and_few_kept(monkeypatch):
    monkeypatch.setattr(huffman, "_FOREST_STATES", 40)
    monkeypatch.setattr(huffman, "_OWN_BYTES", 100)
    monkeypatch.setattr(huffman, "_MEMO_LIMIT", 1)
    draw = random.Random(5)
    texts = [random_text(draw, draw.choice([1, 30, 900])) for _ in range(60)]
    blobs = [huffman.container_alone(text) for text in texts]
    assert huffman.texts_of(blobs) == [text.encode() for text in texts]
    assert [huffman.text_of(blob) for blob in blobs] == texts
    assert len(huffman._automata) == 1
