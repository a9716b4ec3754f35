import hashlib
import random
import re

import pytest
from llm_cases import no_documents, odd_documents, plain_rows

from titleloom.llm.decontamination import ItemAutomaton, decontaminate, match_report, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_matches(words, items, window=10):
    hit, names = set(), set()
    for name, own in items:
        size = min(window, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                hit.update(range(i, i + size))
                names.add(name)
    return hit, names


@pytest.mark.parametrize("seed", range(30))
def test_automaton_against_all_windows(seed):
    rng = random.Random(seed)
    window = rng.choice([2, 3, 5])
    letters = [b"a", b"b", b"c"][: rng.choice([2, 3])]
    items = [(str(i), [rng.choice(letters) for _ in range(rng.randrange(0, 9))]) for i in range(rng.randrange(1, 6))]
    automaton = ItemAutomaton(items, window)
    for _ in range(30):
        words = [rng.choice([*letters, b"z"]) for _ in range(rng.randrange(0, 25))]
        spans, names = automaton.hits(words)
        hit, want = plain_matches(words, items, window)
        assert {i for a, b in spans for i in range(a, b)} == hit
        assert names == want


def test_words():
    text = "A-b_c 1²³ Ünï x y `z{ \x7f"
    assert [w.decode() for w in words_of(text.encode())] == plain_words(text)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_odd_rows(spark, block_bytes):
    docs = odd_documents(spark)
    passage = docs.filter("doc_id = 4").first().text.split()
    items = [
        (1, " ".join(passage[5:30])), (2, " ".join(passage[40:44]).upper()), (3, None), (4, ""), (None, " ".join(passage[50:65])),
        (1, " ".join(passage[60:80])), (6, "ünï cödé"), (7, "nothing of this kind occurs"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    named = [("" if i is None else str(i), plain_words(t)) for i, t in items]
    want = []
    for row in docs.collect():
        words = plain_words(row.text)
        hit, names = plain_matches(words, named)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        want.append((row.doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    assert plain_rows(match_report(docs, bench, block_bytes=block_bytes)) == sorted(want, key=repr)
    cleaned = decontaminate(docs, bench, max_coverage=0.5, block_bytes=block_bytes)
    assert cleaned.columns == docs.columns
    rest = cleaned.collect()
    assert not any(plain_matches(plain_words(r.text), named)[0] for r in rest)
    assert {w[0] for w in want if not w[5]} <= {r.doc_id for r in rest}


def plain_cut(text, items, most, window=10):
    """The text after rounds of cutting the union of all hits, or None when too much went."""
    total, lost = len(plain_words(text)), 0
    while True:
        places = [m.span() for m in WORD.finditer(text)]
        hit, _ = plain_matches(plain_words(text), items, window)
        if not hit:
            return text
        lost += len(hit)
        if lost > most * total:
            return None
        kept, upto = "", 0
        for i in sorted(hit):
            if i - 1 not in hit:
                kept += text[upto : places[i][0]]
            upto = places[i][1]
        text = kept + text[upto:]


def test_blocks_cut_what_one_block_cuts(spark):
    rng = random.Random(15)
    rows, items = [], []
    for i in range(60):
        own = [f"w{i}x{k}" for k in range(60)]
        first = rng.randrange(0, 15)
        items += [(f"a{i}", " ".join(own[first : first + 15])), (f"b{i}", " ".join(own[first + 10 + i % 7 : first + 24 + i % 7]))]
        if i % 5 == 0:  # words that only the first cut brings together
            items.append((f"c{i}", " ".join(own[max(0, first - 6) : first] + own[first + 24 + i % 7 :][:8])))
        rows.append((i, "; ".join(own[: 45 + i % 10])))
    rows += [(60, None), (61, ""), (62, rows[0][1]), (62, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    named = [(i, plain_words(t)) for i, t in items]
    want = [(i, t if t is None else plain_cut(t, named, 0.5)) for i, t in rows]
    want = sorted(((i, t) for i, t in want if t is not None or i == 60), key=repr)
    assert 5 < len(want) < 64
    for block_bytes in (1 << 20, 3000):
        assert plain_rows(decontaminate(docs, bench, block_bytes=block_bytes)) == want


def test_empty(spark):
    docs, none = odd_documents(spark), spark.createDataFrame([], "item_id bigint, text string")
    assert match_report(docs, none).filter("contaminated").count() == 0
    assert decontaminate(docs, none).count() == docs.count()
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert match_report(no_documents(spark), some).count() == 0
