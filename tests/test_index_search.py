import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import titleloom as tl
from titleloom.functions import text
from titleloom.functions.minhash import DEPTH, MAX_HASH, TREES
from titleloom.operators import index as index_module
from titleloom.operators.index import Index, forest_keys, last_documents
from titleloom.operators.search import as_json

TITLES = "id bigint, pos bigint, url string, title string"


def titles(spark, values):
    return spark.createDataFrame([(i, i, f"http://a.com/{i}", t) for i, t in enumerate(values)], TITLES)


def ask(spark, *queries):
    return spark.createDataFrame(list(enumerate(queries)), "qid bigint, query string")


def test_last_row_with_tokens_wins(spark):
    rows = [(1, 0, "u0", "Uno dos"), (1, 1, None, "Tres"), (1, 2, "u2", "   "), (2, 3, "u3", "None"),
            (3, 4, "u4", "none"), (4, 5, "u5", None), (5, 6, "u6", "")]
    got = last_documents(spark.createDataFrame(rows, TITLES)).collect()
    assert sorted((r.id, r.pos, r.title, r.url) for r in got) == [("1", 0, "Tres", None), ("3", 4, "none", "u4")]


def test_count(spark):
    assert tl.build_index(titles(spark, ["a", "b", "", "  ", "NA"])).count().first()[0] == 2


def test_same_words_are_fully_similar(spark):
    index = tl.build_index(titles(spark, ["Uno dos TRES", "otra cosa"]))
    got = tl.search(index, ask(spark, "tres uno  uno DOS", "")).collect()
    assert [(r.qid, r.id, r.title, r.similarity) for r in got] == [(0, "0", "Uno dos TRES", 1.0)]


def test_no_tokens_no_rows(spark):
    index = tl.build_index(titles(spark, ["a b"]))
    assert tl.search(index, ask(spark, "", "  ", None)).count() == 0
    assert tl.forest_candidates(index, ask(spark, " ")).count() == 0


def test_copies_are_cut_at_the_limit_in_row_order(spark):
    index = tl.build_index(titles(spark, ["same title"] * 150))
    got = [int(r.id) for r in tl.search(index, ask(spark, "same title")).collect()]
    assert sorted(got) == list(range(100))
    got = [int(r.id) for r in tl.search(index, ask(spark, "same title"), k=7).collect()]
    assert sorted(got) == list(range(7))


def test_more_candidates_than_the_group_limit(spark):
    index = tl.build_index(titles(spark, ["same title"] * 1300))
    assert tl.search(index, ask(spark, "same title"), k=1200).count() == 1200


def slots_of(sig):
    """Slots of a packed signature."""
    return np.frombuffer(sig, ">u4").astype(np.int64)


def made_index(spark, signatures):
    trees = lambda s: [np.array(t).astype(">u4").tobytes() for t in np.split(np.array(s), TREES)]
    rows = [(str(i), i, f"t{i}", f"u{i}", b"".join(trees(s)), trees(s)) for i, s in enumerate(signatures)]
    docs = spark.createDataFrame(
        rows, "id string, pos bigint, title string, url string, sig binary, trees array<binary>"
    )
    return Index(docs.drop("trees"), forest_keys(docs, "pos", "id"))


def test_two_equal_slots_are_needed(spark):
    query = "uno dos tres"
    sig = slots_of(tl.build_index(titles(spark, [query])).docs.first().sig).tolist()
    other = [(v + 1) % MAX_HASH for v in sig]
    one, two, no_key = list(other), list(other), list(other)
    one[0] = sig[0]
    two[0], two[5] = sig[0], sig[5]
    no_key[5], no_key[7] = sig[5], sig[7]
    got = tl.search(made_index(spark, [one, two, no_key]), ask(spark, query)).collect()
    assert [(r.id, r.similarity) for r in got] == [("1", 2 / 128)]


def forest_order(query, documents, k):
    """Candidates as a forest meets them: longest prefix first, trees in turn, slots, then age."""
    met = []
    for depth in range(DEPTH, 0, -1):
        for tree in range(TREES):
            cut = slice(tree * DEPTH, tree * DEPTH + depth)
            whole = slice(tree * DEPTH, (tree + 1) * DEPTH)
            found = [i for i, d in enumerate(documents) if (d[cut] == query[cut]).all()]
            for i in sorted(found, key=lambda i: (tuple(documents[i][whole]), i)):
                if i not in met:
                    met.append(i)
                if len(met) == k:
                    return met
    return met


@pytest.mark.parametrize("k", [1, 3, 20, 100])
def test_candidates_equal_a_forest_walk(spark, k):
    # Three values per slot: long shared prefixes, many ties, and hot first slots.
    draw = np.random.RandomState(k)
    query = "palabra de busca"
    sig = slots_of(tl.build_index(titles(spark, [query])).docs.first().sig)
    documents = []
    for _ in range(150):
        keep = draw.rand(128) < draw.choice([0.2, 0.6, 0.95])
        documents.append(np.where(keep, sig, draw.randint(0, 3, size=128)))
    documents += [documents[3]] * 40
    got = tl.forest_candidates(made_index(spark, documents), ask(spark, query), k).orderBy("rank").collect()
    assert [int(r.id) for r in got] == forest_order(sig, documents, k)


def test_hot_bucket_and_repeated_queries(spark):
    """A third of all documents and of all queries are copies; results stay whole."""
    draw = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    values = ["hot title of all"] * 400 + [" ".join(draw.choices(words, k=5)) for _ in range(800)]
    draw.shuffle(values)
    index = tl.build_index(titles(spark, values))
    queries = ["hot title of all"] * 30 + values[:60]
    got = tl.search(index, ask(spark, *queries)).toPandas()
    hot = [i for i, v in enumerate(values) if v == "hot title of all"][:100]
    for qid in range(30):
        assert sorted(int(i) for i in got[got.qid == qid].id) == hot
    sigs = {int(r.id): slots_of(r.sig) for r in index.docs.select("id", "sig").collect()}
    documents = [sigs[i] for i in range(len(values))]
    for qid in (30, 41, 57):
        met = forest_order(documents[qid - 30], documents, 100)
        kept = {i for i in met if (documents[i] == documents[qid - 30]).mean() > 0.01}
        assert {int(i) for i in got[got.qid == qid].id} == kept


def test_large_query_batches_take_joins_without_broadcast(spark, monkeypatch):
    from titleloom.operators import search as module

    values = [f"title number {i % 17} of {i % 5}" for i in range(60)]
    index = tl.build_index(titles(spark, values))
    small = set(tl.search(index, ask(spark, *values)).collect())
    proposed = set(tl.forest_candidates(index, ask(spark, *values), 7).collect())
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    assert set(tl.search(index, ask(spark, *values)).collect()) == small
    assert set(tl.forest_candidates(index, ask(spark, *values), 7).collect()) == proposed


def test_large_query_batches_keep_documents_trimmed(spark, monkeypatch):
    """Documents that share one slot of a tree with a query are met once, however many queries there are."""
    from titleloom.operators import search as module

    query = "asked for"
    sig = slots_of(tl.build_index(titles(spark, [query])).docs.first().sig)
    first = np.arange(128) % DEPTH == 0
    index = made_index(spark, [np.where(first, sig, (sig + 1 + i) % MAX_HASH) for i in range(200)])
    listed = []
    top = module.top_k
    monkeypatch.setattr(module, "top_k", lambda df, keys, *a, **b: listed.append((keys, df)) or top(df, keys, *a, **b))
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    tl.forest_candidates(index, ask(spark, query, *[f"asked {i}" for i in range(200)])).count()
    members = next(df for keys, df in listed if keys == module.NODE)
    keys = members.select("id", "tree").distinct().count()
    assert keys > 500 and members.count() <= 4 * keys


def test_nothing_stays_cached(spark):
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = cached()
    hits = tl.search(tl.build_index(titles(spark, ["a b", "a c"])), ask(spark, "a b", "c"))
    assert hits.count() > 0 and cached() == before


def test_written_index_is_the_saved_one(spark, tmp_path):
    rows = titles(spark, [f"uno dos {i % 9}" for i in range(50)])
    tl.build_index(rows).save(str(tmp_path / "saved"))
    written = tl.write_index(rows, str(tmp_path / "written"))
    saved = Index.load(spark, str(tmp_path / "saved"))
    for name in ("docs", "keys"):
        ours, theirs = getattr(written, name), getattr(saved, name)
        assert sorted(map(str, ours.select(theirs.columns).collect())) == sorted(map(str, theirs.collect()))


def test_ids_of_any_kind(spark):
    rows = [(f"doc-{i}" * 20, i, None, f"uno {i % 3}") for i in range(9)]
    index = tl.build_index(spark.createDataFrame(rows, "id string, pos bigint, url string, title string"))
    got = tl.search(index, ask(spark, "uno 1")).collect()
    assert [r.id for r in got][:3] == [f"doc-{i}" * 20 for i in (1, 4, 7)] and got[0].url is None


def test_order_and_json(spark):
    index = tl.build_index(titles(spark, ["a b c", "a b d", "a b c"]))
    hits = tl.search(index, ask(spark, "a b c", "c b", "d"))
    rows = hits.collect()
    for qid in range(3):
        got = [(r.qid, -r.similarity, r.id) for r in rows if r.qid == qid]
        assert got == sorted(got) and got
    changes = sum(a.qid != b.qid for a, b in zip(rows, rows[1:]))
    assert changes == 2
    hits = tl.search(index, ask(spark, "a b c"))
    assert as_json(hits).first().result == '{"id":"0","title":"a b c","url":"http://a.com/0","similarity":1.0}'


def test_saved_index_answers_alike(spark, tmp_path):
    index = tl.build_index(titles(spark, [f"uno dos {i % 9}" for i in range(50)]))
    index.save(str(tmp_path / "index"))
    queries = ask(spark, "uno dos 3", "dos")
    saved = tl.search(Index.load(spark, str(tmp_path / "index")), queries)
    assert set(saved.collect()) == set(tl.search(index, queries).collect()) != set()


def test_one_query_skips_row_groups_of_a_saved_index(spark, tmp_path):
    index = tl.build_index(titles(spark, [f"palabra{i} de prueba" for i in range(300)]))
    index.save(str(tmp_path / "index"))
    saved = Index.load(spark, str(tmp_path / "index"))
    hits = tl.search(saved, tl.query_table(spark, "palabra7 de prueba"), k=20)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert hits.first().id == "7" and hits.count() <= 20
    assert hits.collect() == tl.search(index, tl.query_table(spark, "palabra7 de prueba", "x"), k=20).collect()


def test_recall_against_all_pairs(spark, small_tables):
    from titleloom.sources.tables import read_table

    pages = tl.extract_titles(read_table(spark, small_tables, "pages"))
    rows = pages.select(F.col("page_id").alias("id"), F.col("page_id").alias("pos"), "url", "title")
    index = tl.build_index(rows)
    got = tl.search(index, rows.select(F.col("id").alias("qid"), F.col("title").alias("query"))).toPandas()
    sigs = {r.id: slots_of(r.sig) for r in index.docs.select("id", "sig").collect()}
    wanted = {(int(q), d) for q in sigs for d in sigs if (sigs[q] == sigs[d]).mean() >= 0.5}
    found = set(zip(got.qid, got.id))
    assert len(wanted & found) >= 0.9 * len(wanted)


def test_paging(spark):
    rows = [(1, str(i), f"t{i}", "u", (i + 1) / 128) for i in range(21)] + [(2, "x", None, "u", 0.0625)]
    results = spark.createDataFrame(rows, "qid bigint, id string, title string, url string, similarity double")
    sizes = [tl.paginate(results.filter("qid = 1"), page).count() for page in range(4)]
    assert sizes == [10, 10, 1, 0]
    first = tl.paginate(results, 0).orderBy("qid", "position").collect()
    assert [r.position for r in first] == [*range(1, 11), 1]
    assert first[0].label == "[16.4%] t20" and first[-1].label == "[6.2%] Sin Título"
    assert {(r.qid, r.results, r.pages) for r in tl.page_counts(results).collect()} == {(1, 21, 3), (2, 1, 1)}


def test_many_queries_meet_the_same_documents(spark, monkeypatch):
    """Whatever the ranges of sorted slots, every query meets what a walk through the forest meets, in that order."""
    from titleloom.operators import search as module

    draw = random.Random(5)
    values = ["hot title of all"] * 90 + [" ".join(draw.choices("abcdefgh", k=draw.randint(1, 4))) for _ in range(250)]
    index = tl.build_index(titles(spark, values))
    sigs = {int(r.id): slots_of(r.sig) for r in index.docs.select("id", "sig").collect()}
    queries = values[80:140] + ["a z", "y", "hot title"]
    asked = tl.build_index(titles(spark, queries))
    own = {int(r.id): slots_of(r.sig) for r in asked.docs.select("id", "sig").collect()}
    monkeypatch.setattr(module, "_FEW_SETS", 1)
    for rows, k in ((40, 12), (1 << 20, 100)):
        monkeypatch.setattr(module, "_RANGE_ROWS", rows)
        got = tl.forest_candidates(index, ask(spark, *queries), k).orderBy("qid", "rank").toPandas()
        for qid in (0, 9, 10, 25, 40, 60, 61, 62):
            assert [int(i) for i in got[got.qid == qid].id] == forest_order(own[qid], [sigs[i] for i in range(len(values))], k)
        monkeypatch.setattr(module, "_FEW_SETS", 1 << 20)
        few = tl.forest_candidates(index, ask(spark, *queries), k).collect()
        monkeypatch.setattr(module, "_FEW_SETS", 1)
        assert sorted(map(tuple, got.itertuples(index=False))) == sorted(map(tuple, few))


def test_nodes_at_which_nobody_meets_are_not_made(spark, monkeypatch):
    from titleloom.operators import search as module

    values = [f"w{i} x{i} y{i}" for i in range(60)]
    index = tl.build_index(titles(spark, values))
    listed = []
    top = module.top_k
    monkeypatch.setattr(module, "top_k", lambda df, keys, *a, **b: listed.append((keys, df)) or top(df, keys, *a, **b))
    monkeypatch.setattr(module, "_FEW_SETS", 1)
    tl.forest_candidates(index, ask(spark, *values)).count()
    members = next(df for keys, df in listed if keys == module.NODE)
    assert members.count() <= 3 * TREES * len(values)  # of 16 nodes a tree


def test_order_of_many_queries(spark, monkeypatch):
    """Hits of a query stand together, best first, and a query id that comes twice has the hits of both rows."""
    from titleloom.operators import search as module

    index = tl.build_index(titles(spark, ["a b c", "a b d", "a b c", "b c d"]))
    asked = ask(spark, "a b c", "c b", "d", "c  B", None)
    twice = asked.unionByName(asked.selectExpr("qid", "'d' as query"))
    wanted = [tl.search(index, queries).collect() for queries in (asked, twice)]
    monkeypatch.setattr(module, "_FEW_SETS", 1)
    for queries, want in zip((asked, twice), wanted):
        rows = tl.search(index, queries).collect()
        assert sorted(rows) == sorted(want)
        for qid in {r.qid for r in rows}:
            got = [(-r.similarity, r.id) for r in rows if r.qid == qid]
            assert got == sorted(got)
        assert sum(a.qid != b.qid for a, b in zip(rows, rows[1:])) == len({r.qid for r in rows}) - 1


def test_a_written_index_signs_documents_once(spark, tmp_path, monkeypatch):
    """Spark reads what it cuts into ranges once more for a sample; signatures must not be part of that."""
    notes = tmp_path / "notes"
    notes.mkdir()

    @F.arrow_udf("array<string>")
    def noted(words: pa.Array) -> pa.Array:
        import uuid

        (notes / uuid.uuid4().hex).write_text(str(len(words)))
        return words

    monkeypatch.setattr(index_module, "tokens", lambda title: noted(text.tokens(title)))
    tl.write_index(titles(spark, [f"title {i % 70}" for i in range(200)]).repartition(4), str(tmp_path / "index"))
    assert sum(int(note.read_text()) for note in notes.iterdir()) == 200
