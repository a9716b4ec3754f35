import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from llm_cases import no_documents, odd_documents, plain_rows, words

from titleloom.llm import simhash_dedup
from titleloom.llm.components import components
from titleloom.llm.simhash_dedup import keep_representatives, linked_prints, near_duplicates, simhash
from titleloom.plans.durable import shared_dir


def plain_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + 4]).encode(), 42) for i in range(max(1, len(own) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Lowest index that each one reaches over links of at most four bits."""
    codes = np.array(prints, np.uint64)
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[:i]) <= 4):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_fingerprints(monkeypatch):
    rng = random.Random(3)
    texts = [words(rng, n) for n in (0, 1, 2, 3, 4, 5, 60)] + ["A B\vc D\x85e", "ÄÖ X y Z w"]
    assert [simhash(t.encode()) for t in texts] == [plain_print(t) for t in texts]
    monkeypatch.setattr(simhash_dedup, "_BLOCK_BYTES", 40)
    assert [simhash(t.encode()) for t in texts] == [plain_print(t) for t in texts]


@pytest.mark.parametrize("chunk", [1024, 8])
def test_links_of_dense_groups(spark, chunk):
    rng = random.Random(4)
    codes = {0}
    for size in [300] + [20] * 30:
        centre = rng.getrandbits(64)
        for _ in range(size):
            codes.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7))))
    codes = sorted(codes)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    edges = linked_prints(spark.createDataFrame([(c,) for c in signed], "print bigint"), chunk=chunk)
    found = {r.node: r.root for r in components(edges).collect()}
    want = plain_components(codes)
    groups, ours = {}, {}
    for i, code in enumerate(signed):
        groups.setdefault(want[i], set()).add(code)
        ours.setdefault(found.get(code, code), set()).add(code)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def test_components_of_paths(spark):
    path = [(i, i + 1) for i in range(40)]
    edges = spark.createDataFrame([*path, (40, 3), (100, 101), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    prints = [plain_print(r.text) for r in rows]
    root = plain_components(prints)
    want = [(r.doc_id, f"{p:016x}", rows[root[i]].doc_id) for i, (r, p) in enumerate(zip(rows, prints, strict=True))]
    assert plain_rows(near_duplicates(docs)) == sorted(want, key=repr)
    kept = keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted({repr(rows[i].doc_id) for i in set(root)})


def test_empty(spark):
    assert near_duplicates(no_documents(spark)).count() == 0
    assert keep_representatives(no_documents(spark)).count() == 0


def test_small_working_tables_are_few_files(spark):
    """However many partitions shuffles have. A file for each of them costs a task and two processes."""
    docs = spark.createDataFrame([(i, words(random.Random(i // 3), 30)) for i in range(900)], "doc_id bigint, text string")
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    folder = Path(shared_dir(spark).removeprefix("file:"))
    known = set(folder.iterdir()) if folder.exists() else set()
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        kept = keep_representatives(docs).collect()
        found = {r.node: r.root for r in components(spark.range(500).selectExpr("id AS a", "id + 1000 AS b")).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(r.doc_id for r in kept) == list(range(0, 900, 3))
    assert found == {i + 1000: i for i in range(500)}
    files = {path.name: len(list(path.glob("part-*"))) for path in set(folder.iterdir()) - known}
    names = ("prints", "groups", "edges", "lowest", "rooted", "components", "kept")
    assert {name for name in names if any(path.startswith(f"{name}-") for path in files)} == set(names)
    most = spark.sparkContext.defaultParallelism
    assert not {path: n for path, n in files.items() if path.startswith(names) and n > most}
