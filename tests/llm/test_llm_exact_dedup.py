import hashlib
import re
from collections import defaultdict

from llm_cases import SCHEMA, no_documents, odd_documents, plain_rows
from pyspark.sql import functions as F

from titleloom.llm.exact_dedup import content_groups, exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    out = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for at, doc in enumerate(sorted(ids, key=lambda i: (i is None, i))):
            out.append((doc, keep, len(ids), at == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert plain_rows(content_groups(docs)) == want


def test_hash_collisions_are_split_by_bytes(spark):
    rows = [(i, t) for i, t in enumerate(["a b", "a  b", "c", "a\tb", "d", "c", "e", None, ""])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = content_groups(docs, hashed=lambda text: F.substring(F.unhex(F.md5(text)), 1, 0))
    assert plain_rows(found) == expected(rows)


def test_rows_that_stay(spark):
    docs = odd_documents(spark)
    kept = exact_dedup(docs)
    assert kept.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in docs.collect()})


def test_empty(spark):
    assert content_groups(no_documents(spark)).count() == 0
