import pytest
from llm_cases import no_documents, odd_documents

from titleloom.llm.mixing import mix, mixed_sizes


def reshared(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, free = share * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in list(free):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                free.discard(s)
    return target


def check(rows):
    sizes, taken, biggest = {}, {}, {}
    for row, source in rows:
        sizes[source] = sizes.get(source, 0) + row.size
        taken[source] = taken.get(source, 0) + row.taken
        biggest[source] = max(biggest.get(source, 0), row.size)
        assert 0 <= row.taken <= 2 * row.size
    target = reshared(sizes)
    for row, source in rows:
        assert row.source_size == sizes[source]
        assert row.target == pytest.approx(target[source])
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 2 * biggest[source]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    sources = {}
    for r in docs.collect():
        sources.setdefault((r.doc_id, len((r.text or "").split())), r.source)
    found = mixed_sizes(docs).collect()
    assert len(found) == docs.count()
    check([(r, sources[r.doc_id, r["size"]]) for r in found if True])


@pytest.mark.parametrize("digits", [1, 3])
def test_sources_come_near_their_targets(spark, digits):
    rows = [(i, "w " * (1 + i * 7919 % 400), f"s{i % 5 * (i % 3 > 0)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    source = {i: s for i, _, s in rows}
    found = mixed_sizes(docs, digits=digits).collect()
    assert {r.doc_id: r.taken for r in found} == {r.doc_id: r.taken for r in mixed_sizes(docs.coalesce(2)).collect()}
    check([(r, source[r.doc_id]) for r in found])


def test_mixture_repeats_rows(spark):
    docs = odd_documents(spark)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert words == sum(r.taken for r in mixed_sizes(docs).collect())


def test_empty(spark):
    assert mixed_sizes(no_documents(spark)).count() == 0
    assert mix(no_documents(spark)).count() == 0
