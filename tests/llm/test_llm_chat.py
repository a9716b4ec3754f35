import hashlib
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from titleloom.llm.chat_format import (
    END, TEXT, TURN, digest_formatted, escape, format_conversations, loss_mask, parse_turns, render, unescape,
)
from titleloom.llm.queries import tokenizer_path

PIECES = ["<", "|", "\\", "[", "]", "INST", "/", "s", ">", "end|>", TURN, TEXT, END, "</s>", "[/INST]", "<|endoftext|>", "a", "\n", " ", "é", "\U0001f600"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@given(TEXTS)
def test_escapes_are_reversible(text):
    safe = escape(text)
    assert unescape(safe) == text
    assert not any(mark in safe for mark in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|x", "a\nb", ""]), TEXTS), max_size=5))
def test_rendering_is_reversible(turns):
    formatted, spans = render(turns)
    assert parse_turns(formatted) == turns
    assert [unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_mask_of_many_spans():
    rng = random.Random(7)
    edges = sorted(rng.sample(range(500), 40))
    spans = list(zip(edges[::2], edges[1::2], strict=True))
    cuts = sorted({0, 500, *edges, *rng.sample(range(500), 100)})
    starts, ends = np.array(cuts[:-1]), np.array(cuts[1:])
    want = [any(a <= s and e <= b for a, b in spans) for s, e in zip(starts, ends, strict=True)]
    assert loss_mask(starts, ends, spans).tolist() == want


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations(spark):
    rng = random.Random(8)
    rows = [
        (1, 0, "system", "be"), (1, 2, "assistant", " hi\n"), (1, 1, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "!x"),
        (2, 0, None, "a"), (2, 0, "assistant", "é\U0001f600" * 3), (2, 0, "assistant", "é\U0001f600" * 3), (2, None, "user", "first"),
        (None, 1, "assistant", "<|end|></s>"), (3, 0, "user", "only"), (4, 0, "assistant", "word " * 100_000),
    ]
    rows += [(i, t, rng.choice(["user", "assistant"]), "".join(rng.choices(PIECES, k=9))) for i in range(10, 40) for t in range(4)]
    df = spark.createDataFrame([(*r, "f", "m") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string, loss_mask string")
    formatted = format_conversations(df.repartition(6), tokenizer_path())
    found = {r.conv_id: r for r in digest_formatted(formatted).collect()}
    grouped = {}
    for conv, turn, role, text in rows:
        grouped.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    assert set(found) == set(grouped)
    for conv, own in grouped.items():
        turns = [(role.decode(), text.decode()) for _, _, role, text in sorted(own)]
        loss = "".join(text for role, text in turns if role == "assistant")
        row = found[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
        assert row.formatted_chars == len(render(turns)[0])


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert digest_formatted(format_conversations(none, tokenizer_path())).count() == 0
