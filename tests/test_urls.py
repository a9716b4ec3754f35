import random
from urllib.parse import urldefrag, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from titleloom.functions import urls

BASE = "http://a.com/x/y"
CASES = [
    ("/z", "http://a.com/z"),
    ("z#top", "http://a.com/x/z"),
    ("../z/", "http://a.com/z"),
    ("//b.com/q", "http://b.com/q"),
    ("?p=1", "http://a.com/x/y?p=1"),
    ("", "http://a.com/x/y"),
    (None, "http://a.com/x/y"),
    ("http://a.com//", "http://a.com/"),
    ("mailto:m@a.com", None),
    ("javascript:void(0)", None),
    ("http://[bad", None),
    ("http://a.com:8080/z", "http://a.com:8080/z"),
    ("/q?a=1&amp;b=2", "http://a.com/q?a=1&b=2"),
    ("#here", "http://a.com/x/y"),
    ("/des,***%%%", "http://a.com/des,***%%%"),
    ("HTTP://A.com/Q", "http://A.com/Q"),
]


def expected(base, link):
    """The four steps with the standard library."""
    try:
        full = urldefrag(urljoin(base, link) if link else base)[0]
        full = full[:-1] if full.endswith("/") else full
        return full if urlparse(full).scheme in ("http", "https") else None
    except ValueError:
        return None


def resolve(spark, pairs):
    frame = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "n int, b string, h string")
    both = urls.resolve_links(frame, "b", "h", "v").withColumn("u", urls.normalize_url(F.col("b"), F.col("h")))
    assert both.columns == ["n", "b", "h", "v", "u"]
    rows = both.collect()
    assert all(r.u == r.v for r in rows)
    return {r.n: r.u for r in rows}


def test_links(spark):
    got = resolve(spark, [(BASE, link) for link, _ in CASES])
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES]


def test_links_equal_the_standard_library(spark):
    draw = random.Random(3)
    parts = ["/", "//", "..", ".", "a", "é", "?", "#", ":", ";", "=", "http:", "https://", "b.com", ":80",
             "mailto:", " ", "\t", "%20", "%", "[", "@", "x.html", "A", "-"]
    bases = ["http://a.com", "http://a.com/x/y", "https://A.com:8/p/q/?k=v", "http://a.com/x;p?q#f",
             "http://u@a.com/", "http://a.com/ü/", "ftp://a.com/x", "HTTP://a.com/b/c", "http://a.com?", " http://a.com/x"]
    pairs = [(draw.choice(bases), "".join(draw.choices(parts, k=draw.randint(1, 6)))) for _ in range(4000)]
    got = resolve(spark, pairs)
    wrong = [(p, got[i], expected(*p)) for i, p in enumerate(pairs) if got[i] != expected(*p)]
    assert not wrong, wrong[:5]


def test_urls_alone_equal_the_standard_library(spark):
    draw = random.Random(4)
    parts = ["/", "a", "#", "?", ";", "b=c", " ", "é", ":9", ".", "[", "&"]
    heads = ["http://a.com", "https://b.org/", "HTTP://c.com", "ftp://d.com", "mailto:x", "//e.com", "f/g", ""]
    values = [draw.choice(heads) + "".join(draw.choices(parts, k=draw.randint(0, 5))) for _ in range(2000)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, u string")
    for row in frame.select("n", urls.normalize_url(F.col("u")).alias("u")).collect():
        assert row.u == expected(values[row.n], None), values[row.n]


def test_parts(spark):
    frame = spark.createDataFrame([("HTTPS://A.com:80/x?y#z",)], "u string")
    row = frame.select(
        urls.scheme(F.col("u")), urls.netloc(F.col("u")), urls.origin(F.col("u")), urls.robots_url(F.col("u")),
        urls.is_web_scheme(F.col("u")),
    ).first()
    assert list(row) == ["https", "A.com:80", "https://A.com:80", "https://A.com:80/robots.txt", True]


@pytest.mark.parametrize("value", [None])
def test_null(spark, value):
    frame = spark.createDataFrame([(value, "x")], "b string, h string")
    assert frame.select(urls.normalize_url(F.col("b"), F.col("h"))).first()[0] is None
