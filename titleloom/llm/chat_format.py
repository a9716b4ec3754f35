"""Chat formatting with loss masks aligned by offsets.

Turns of a conversation are sorted and rendered into one string between control tokens. The whole string is
encoded once with character offsets. Spans of assistant texts are sorted, and so are token spans, so a
binary search for every token's start finds the only turn that can hold it.

    <|turn|>role<|text|>text<|end|>        for every turn, one after the other

Control tokens are added to the vocabulary, so the tokenizer cuts there and no token straddles a text's edge.
Inside roles and texts a backslash is put behind the first character of what could be read as a control
string, here or in other common templates; one that already has backslashes there gets one more. Taking one
away gives the text back.

Defined results
    * A null role or text counts as empty. Turns with equal numbers are in the order of role and text; a
      null turn comes first. Rows with a null conversation id are one conversation.
    * Repeated rows are turns like any other. Only texts of the role ``assistant`` are under the mask.
    * An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import text_or_empty

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"

# Beginnings and rests of control strings of this and other common templates.
_CONTROL = r"\||/?s>|/?INST\]"
_ESCAPE = re.compile(rf"([<\[])(\\*)(?={_CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={_CONTROL})")
_RENDERED = re.compile(rf"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)
_FLUSH_CHARS = 1 << 18

FORMATTED = (
    "conv_id bigint, formatted string, input_ids array<int>, token_starts array<int>, token_ends array<int>, "
    "loss_mask array<boolean>"
)
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the spans of its assistant texts."""
    parts, spans, size = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == ASSISTANT:
            spans.append((size + len(head), size + len(head) + len(body)))
        parts += (head, body, END)
        size += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    return [(unescape(role), unescape(text)) for role, text in _RENDERED.findall(formatted)]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie inside a span; tokens and spans are sorted."""
    if not spans:
        return np.zeros(len(starts), bool)
    begin, stop = np.array(spans, np.int64).T
    at = np.searchsorted(begin, starts, "right") - 1
    return (at >= 0) & (ends <= stop[at]) & (ends > starts)


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """Text under the mask. Tokens that follow each other are put together before it is unescaped."""
    starts, ends = starts[mask], np.maximum.accumulate(ends[mask])
    if not len(starts):
        return ""
    first = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    last = np.r_[first[1:], len(starts)] - 1
    return "".join(unescape(formatted[a:b]) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True))


_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    """The tokenizer with control tokens, once for each Python worker."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks; idle threads would only spin
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (TURN, TEXT, END)])
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Conversations from sorted rows, one at a time."""
    turns: list[tuple[str, str]] = []
    last: int | None = None
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if turns and conv != last:
                yield last, turns
                turns = []
            last = conv
            turns.append((role, text))
    if turns:
        yield last, turns


def _encoded(rendered: list[tuple], tokenizer) -> pa.RecordBatch:
    found = tokenizer.encode_batch([text for _, text, _ in rendered], add_special_tokens=False)
    columns: list[list] = [[], [], [], [], [], []]
    for (conv, text, spans), one in zip(rendered, found, strict=True):
        offsets = np.array(one.offsets, np.int32).reshape(-1, 2)
        starts, ends = offsets[:, 0], offsets[:, 1]
        row = conv, text, np.array(one.ids, np.int32), starts, ends, loss_mask(starts, ends, spans)
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    ints = pa.list_(pa.int32())
    kinds = [pa.int64(), pa.string(), ints, ints, ints, pa.list_(pa.bool_())]
    names = [field.split()[0] for field in FORMATTED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def format_conversations(
    turns: DataFrame,
    tokenizer: str,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: the rendered string, token ids, their offsets, and the loss mask."""
    rows = turns.select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        text_or_empty(role).alias("role"), text_or_empty(text).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def encode(batches):
        words, waiting, size = _tokenizer(tokenizer), [], 0
        for conv, own in _conversations(batches):
            rendered, spans = render(own)
            waiting.append((conv, rendered, spans))
            size += len(rendered)
            if size > _FLUSH_CHARS:
                yield _encoded(waiting, words)
                waiting, size = [], 0
        if waiting:
            yield _encoded(waiting, words)

    return ordered.mapInArrow(encode, FORMATTED)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digest_formatted(formatted: DataFrame) -> DataFrame:
    """Per conversation counts and digests of its turns and of the text under the mask, from the output alone."""

    def digest(batches):
        for batch in batches:
            rows = []
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                formatted = batch.column("formatted")[i].as_py()
                tokens = [
                    batch.column(name)[i].values.to_numpy(zero_copy_only=False)
                    for name in ("token_starts", "token_ends", "loss_mask")
                ]
                turns, loss = parse_turns(formatted), masked_text(formatted, *tokens)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((conv, len(turns), _sha(whole), len(loss), _sha(loss), len(formatted)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.string() if " string" in x else pa.int64() for x in DIGESTS.split(", ")]
            names = [x.split()[0] for x in DIGESTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return formatted.mapInArrow(digest, DIGESTS)
