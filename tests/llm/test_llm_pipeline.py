import random
import re
import zlib
from collections import Counter

import numpy as np
from llm_cases import odd_documents, plain_rows, words
from test_llm_decontamination import plain_matches, plain_words
from test_llm_mixing import reshared
from test_llm_simhash import plain_components, plain_print

import corpus_pipeline
from titleloom.llm.common import working_path
from titleloom.llm.language_id import identify_languages
from titleloom.llm.queries import tokenizer_path


def corpus(spark):
    rng = random.Random(14)
    docs = odd_documents(spark)
    rows = [(100 + i, words(rng, 40 + i), rng.choice(["en", "de"]), f"s{i % 3}", 1) for i in range(60)]
    more = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.select(more.columns).unionByName(more)
    passage = docs.filter("doc_id = 13").first().text.split()
    items = [(1, " ".join(passage[40:60])), (2, " ".join(rows[3][1].split()[2:9])), (3, " ".join(rows[5][1].split()[:38]))]
    folder = working_path(spark, "corpus")
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, [(str(i), plain_words(t)) for i, t in items]


def test_stages_against_plain_versions(spark):
    from tokenizers import Tokenizer

    folder, items = corpus(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        outputs[name] = docs
        if name != "token_records":
            assert docs.columns == columns

    scores = {(r.doc_id, r.lang_pred, r.score) for r in identify_languages(before).collect()}
    rejected = {i for i, lang, score in scores if lang == "und" or score < 0.3}
    kept = outputs["language_id"]
    wanted = Counter(repr(tuple(r)) for r in before.collect() if any(c.isalpha() for c in r.text or "") and r.doc_id not in rejected - {None})
    assert Counter(repr(tuple(r)) for r in kept.collect()) == wanted

    rows = sorted(kept.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    root = plain_components([plain_print(r.text) for r in rows])
    single = outputs["simhash_dedup"].collect()
    assert sorted(repr(r.doc_id) for r in single) == sorted(repr(rows[i].doc_id) for i in set(root))

    clean = {r.doc_id: r for r in outputs["decontamination"].collect()}
    for row in single:
        hit, _ = plain_matches(plain_words(row.text), items)
        if not hit:
            assert clean[row.doc_id].text == row.text
        elif row.doc_id in clean:
            left = plain_words(clean[row.doc_id].text)
            assert not plain_matches(left, items)[0] and len(left) <= len(plain_words(row.text)) - len(hit)
            assert clean[row.doc_id].n_chars == len(clean[row.doc_id].text)
        else:
            assert len(hit) > 0.5 * len(plain_words(row.text))

    mixed = outputs["source_mixture"].collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in clean.values():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for r in mixed:
        assert tuple(r) == tuple(clean[r.doc_id])
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    target = reshared(dict(sizes))
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in sizes)

    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, want = 0, []
    for r in sorted(mixed, key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert plain_rows(docs) == sorted(want, key=repr)
    assert plain_rows(corpus_pipeline.run(spark, folder)) == plain_rows(docs)


def test_no_documents(spark):
    folder, _ = corpus(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
    assert docs.count() == 0


CLASHES = ["_key", "_hash", "_sha", "_norm", "_row", "_total", "_lost", "_spans", "_words", "_items", "_id", "_text", "_name", "_source", "_weight", "_limit",
           "_level", "_edge", "_mix_source", "_mix_copies", "_mix_edge", "_mix_with_edge", "_mix_copy", "_lang_pred", "_lang_score", "_part", "_split", "aside_key", "key"]


def test_columns_named_like_working_columns(spark):
    """Each stage gives the same rows, and carries such columns along."""
    from pyspark.sql import functions as F

    from titleloom.llm.decontamination import decontaminate
    from titleloom.llm.exact_dedup import exact_dedup

    folder, _ = corpus(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    odd = docs.withColumns({name: F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for name in CLASHES})
    stages = [lambda docs, stage=stage: stage(spark, docs, folder) for _, stage in corpus_pipeline.STAGES[:-1]]
    stages += [exact_dedup, lambda docs: decontaminate(docs, benchmark, block_bytes=60)]
    for stage in stages:
        plain, carried = stage(docs), stage(odd)
        assert carried.columns == odd.columns
        rows = carried.collect()
        assert Counter(repr(tuple(r)) for r in plain.collect()) == Counter(repr(tuple(r)[: len(docs.columns)]) for r in rows)
        assert all(r[name] == name + ("-" if r.doc_id is None else str(r.doc_id)) for r in rows for name in CLASHES)
