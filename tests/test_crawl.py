import random
from pathlib import Path
from urllib.parse import urlparse
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

import titleloom as tl
from titleloom.operators.robots import AGENT, robots_rules, rule_nodes
from titleloom.plans import crawl as crawl_plan
from titleloom.plans.buckets import BucketedTable
from titleloom.plans.durable import shared_dir

GRAPH = {
    "http://a.com": ["/p1", "/p2", "http://b.com/x"],
    "http://a.com/p1": ["/p3", "/"],
    "http://a.com/p2": ["/p3#s", "/p4"],
    "http://a.com/p3": ["/p1"],
    "http://a.com/p4": [],
}


def page_rows(graph, status=None):
    body = lambda links: "<h1>t</h1>" + "".join(f'<a href="{h}">x</a>' for h in links)
    return [
        (i, url, (status or {}).get(url, 200), "text/html", body(links)) for i, (url, links) in enumerate(graph.items())
    ]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, status int, content_type string, html string")


def seeds_of(spark, *urls):
    return spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, pos bigint")


def robots_of(spark, *rows):
    return spark.createDataFrame(rows, "origin string, status int, robots_txt string")


def order(crawl):
    return [(r.url.removeprefix("http://a.com") or "/", r.depth) for r in crawl.pages.orderBy("depth", "pos").collect()]


def test_no_limit(spark):
    crawl = tl.crawl_order(pages_of(spark, page_rows(GRAPH)), seeds_of(spark, "http://a.com"))
    assert order(crawl) == [("/", 0), ("/p1", 1), ("/p2", 1), ("/p3", 2), ("/p4", 2)]
    assert "b.com" not in str(crawl.visited.collect())
    assert crawl.counters().first().asDict() == {"pages_crawled": 5, "unique_urls": 5}


def test_limit(spark):
    crawl = tl.crawl_order(pages_of(spark, page_rows(GRAPH)), seeds_of(spark, "http://a.com/"), 3)
    assert order(crawl) == [("/", 0), ("/p1", 1), ("/p2", 1)]
    assert crawl.counters().first().asDict() == {"pages_crawled": 3, "unique_urls": 5}
    crawl = tl.crawl_order(pages_of(spark, page_rows(GRAPH)), seeds_of(spark, "http://a.com/"), 2)
    assert order(crawl) == [("/", 0), ("/p1", 1)]
    # The links of a page that was not reached were never queued.
    assert crawl.counters().first().asDict() == {"pages_crawled": 2, "unique_urls": 4}


def test_failed_page_does_not_count(spark):
    pages = pages_of(spark, page_rows(GRAPH, {"http://a.com/p1": 404}))
    assert order(tl.crawl_order(pages, seeds_of(spark, "http://a.com"), 3)) == [("/", 0), ("/p2", 1), ("/p3", 2)]


def test_robots_in_the_crawl(spark):
    robots = robots_of(spark, ("http://a.com", 200, "User-agent: *\nDisallow: /p2"))
    crawl = tl.crawl_order(pages_of(spark, page_rows(GRAPH)), seeds_of(spark, "http://a.com"), robots=robots)
    assert order(crawl) == [("/", 0), ("/p1", 1), ("/p3", 2)]


def test_pages_without_h1_count_but_have_no_title(spark):
    rows = page_rows(GRAPH)
    rows[1] = (*rows[1][:4], rows[1][4].replace("<h1>t</h1>", ""))
    rows[2] = (*rows[2][:4], rows[2][4].replace("<h1>t</h1>", "<h1></h1>"))
    crawl = tl.crawl_order(pages_of(spark, rows), seeds_of(spark, "http://a.com"))
    assert crawl.counters().first().pages_crawled == 5
    assert {(r.url[-2:], r.title) for r in crawl.titles().collect()} == {("om", "t"), ("p2", ""), ("p3", "t"), ("p4", "t")}


def test_no_seed_is_valid(spark):
    crawl = tl.crawl_order(pages_of(spark, page_rows(GRAPH)), seeds_of(spark, "mailto:x", "http://[bad"))
    assert crawl.counters().first().asDict() == {"pages_crawled": 0, "unique_urls": 0}


def breadth_first(graph, seeds, limit):
    """Crawl order with a plain list as queue; all links in the graph are absolute."""
    hosts = {urlparse(s).netloc for s in seeds}
    queue, crawled = list(dict.fromkeys(seeds)), []
    for url in queue:
        if len(crawled) == limit:
            break
        if url in graph:
            crawled.append(url)
            queue += [u for u in dict.fromkeys(graph[url]) if urlparse(u).netloc in hosts and u not in queue]
    return crawled, set(queue)


@pytest.mark.parametrize("limit", [7, 10_000])
def test_random_graph(spark, limit):
    draw = random.Random(limit)
    urls = [f"http://{h}.com/{i}" for h in ("a", "b", "c") for i in range(40)]
    graph = {u: draw.choices(urls, k=draw.randint(0, 4)) for u in draw.sample(urls, 100)}
    seeds = ["http://b.com/1", "http://a.com/7", "http://a.com/8"]
    crawl = tl.crawl_order(pages_of(spark, page_rows(graph)), seeds_of(spark, *seeds), limit)
    crawled, queued = breadth_first(graph, seeds, limit)
    assert [r.url for r in crawl.pages.orderBy("depth", "pos").collect()] == crawled
    if limit > 100:
        assert {r.url for r in crawl.visited.collect()} == queued


def linked_graph(seed):
    draw = random.Random(seed)
    urls = [f"http://{h}.com/{i}" for h in ("a", "b") for i in range(30)]
    return {u: draw.choices(urls, k=draw.randint(3, 6)) for u in draw.sample(urls, 50)}, ["http://b.com/1", "http://a.com/7"]


def in_order(crawl):
    return [(r.url, r.depth, r.page_id, r.title) for r in crawl.pages.orderBy("depth", "pos").collect()]


def test_a_crawl_goes_on_after_the_driver_died(spark, tmp_path, monkeypatch):
    (graph, seeds), limit = linked_graph(3), 12
    pages, seeds = pages_of(spark, page_rows(graph)), seeds_of(spark, *seeds)
    whole = tl.crawl_order(pages, seeds, limit)
    for i, place in enumerate(["seen", "frontier/000001", "level/000001", "manifest"]):
        state, writes = str(tmp_path / f"crawl {i}'s"), []
        real_at, real_append = crawl_plan.stored_at, BucketedTable.append

        def died(path, place=place, writes=writes):
            writes.append(path)
            if path.endswith(place) and sum(p.endswith(place) for p in writes) == (2 if place == "seen" else 1):
                raise KeyboardInterrupt

        def at(df, path, real_at=real_at, died=died):
            out = real_at(df, path)
            died(path)
            return out

        def append(self, rows, real_append=real_append, died=died):
            real_append(self, rows)
            died("seen" if "step" in self.schema.names else "graph")

        def note(self, step, *rest, real_note=crawl_plan._Crawl.note, place=place):
            if place == "manifest" and step == 1:
                raise KeyboardInterrupt
            real_note(self, step, *rest)

        with monkeypatch.context() as patch:
            patch.setattr(crawl_plan, "stored_at", at)
            patch.setattr(BucketedTable, "append", append)
            patch.setattr(crawl_plan._Crawl, "note", note)
            with pytest.raises(KeyboardInterrupt):
                tl.crawl_order(pages, seeds, limit, state=state)
        nothing = pages.filter("false")
        again = tl.crawl_order(nothing, seeds, limit, state=state)
        assert in_order(again) == in_order(whole)
        assert sorted(again.visited.collect()) == sorted(whole.visited.collect())


def test_levels_one_at_a_time(spark, tmp_path):
    graph, seeds = linked_graph(4)
    pages, seeds = pages_of(spark, page_rows(graph)), seeds_of(spark, *seeds)
    whole, state = tl.crawl_order(pages, seeds, 10_000), str(tmp_path / "crawl")
    assert in_order(tl.crawl_order(pages, seeds, 10_000, state=state, levels=1)) == in_order(whole)[:2]
    tl.crawl_order(pages, seeds, 10_000, state=state, levels=1)
    for _ in range(2):  # the second call finds an ended crawl
        again = tl.crawl_order(pages, seeds, 10_000, state=state)
        assert in_order(again) == in_order(whole)
        assert sorted(again.visited.collect()) == sorted(whole.visited.collect())
    with pytest.raises(ValueError, match="max_pages"):
        tl.crawl_order(pages, seeds, 5, state=state)


def test_what_was_visited_is_not_moved(spark, tmp_path, monkeypatch):
    graph, seeds = linked_graph(5)
    plans = []

    def seen(self, step, real=crawl_plan._Crawl.new_links):
        links = real(self, step)
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return links

    monkeypatch.setattr(crawl_plan._Crawl, "new_links", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tl.crawl_order(pages_of(spark, page_rows(graph)), seeds_of(spark, *seeds), 10_000, buckets=8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans
    for plan in plans:
        # The visited URLs come last: a join, then filter and sort of a scan of buckets; links are shuffled once by URL.
        upto = next(line for line in plan.splitlines() if "Bucketed: true" in line)
        visited = plan[plan.index("LeftAnti") : plan.index(upto)].splitlines()
        assert not any("Exchange" in line for line in visited[-4:]), plan
        assert plan.count("Exchange hashpartitioning(dst") == 1 and "Exchange hashpartitioning(url" not in plan, plan


def test_a_crawl_leaves_only_its_result(spark):
    graph, seeds = linked_graph(6)
    robots = robots_of(spark, ("http://a.com", 200, "User-agent: *\nDisallow: /1"))
    before = set(Path(shared_dir(spark)).iterdir())
    crawl = tl.crawl_order(pages_of(spark, page_rows(graph)), seeds_of(spark, *seeds), 30, robots)
    left = set(Path(shared_dir(spark)).iterdir()) - before
    assert len(left) == 1 and {p.name for p in left.pop().iterdir()} == {"frontier", "level"}
    assert crawl.counters().first().pages_crawled == 30
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("titleloom_")]


def test_frontier_step(spark):
    links = spark.createDataFrame(
        [(1, "http://a.com/1", 3), (1, "http://a.com/2", 0), (2, "http://a.com/1", 0), (2, "http://a.com:8080/z", 1),
         (2, "http://A.com/z", 2), (3, "http://b.com/1", 0), (3, "http://a.com/old", 0)],
        "page_id bigint, dst string, pos int",
    )
    visited = spark.createDataFrame([("http://a.com/old",)], "url string")
    fresh, seen = tl.frontier_step(links, visited, seeds_of(spark, "http://a.com/"))
    assert {tuple(r) for r in fresh.collect()} == {("http://a.com/1", 1, 3), ("http://a.com/2", 1, 0)}
    assert {r.url for r in seen.collect()} == {"http://a.com/old", "http://a.com/1", "http://a.com/2"}


def test_seed_domains_keep_port_and_case(spark):
    seeds = seeds_of(spark, "http://a.com/x", "https://a.com", "http://A.com:81/#f")
    assert {r.netloc for r in tl.seed_domains(seeds).collect()} == {"a.com", "A.com:81"}
    assert {r.url for r in tl.start_frontier(seeds).collect()} == {"http://a.com/x", "https://a.com", "http://A.com:81"}


ROBOTS = [
    ("User-agent: *\nDisallow: /p", "/p/1", False),
    ("User-agent: *\nAllow: /p/ok\nDisallow: /p", "/p/ok", True),
    ("User-agent: *\nDisallow: /p\nAllow: /p/ok", "/p/ok", False),
    ("User-agent: crawler\nDisallow: /\n\nUser-agent: *\nDisallow:", "/", False),
    ("User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow:", "/", True),
    ("", "/", True),
    ("User-agent: *\nDisallow: /", "", False),
]


def allowed(spark, status, text, path):
    urls = spark.createDataFrame([("http://a.com" + path,)], "url string")
    return tl.robots_filter(urls, robots_of(spark, ("http://a.com", status, text))).count() == 1


def test_robots_rules(spark):
    origins = [(f"http://{i}.com", 200, text) for i, (text, _, _) in enumerate(ROBOTS)]
    urls = spark.createDataFrame([(i, f"http://{i}.com{p}") for i, (_, p, _) in enumerate(ROBOTS)], "n int, url string")
    got = {r.n for r in tl.robots_filter(urls, robots_of(spark, *origins)).collect()}
    assert got == {i for i, (_, _, allow) in enumerate(ROBOTS) if allow}


def test_robots_status(spark):
    deny = "User-agent: *\nDisallow: /"
    rows = [("http://a", 401, None), ("http://b", 403, None), ("http://c", 404, deny), ("http://d", 500, None),
            ("http://e", None, deny), ("http://f", 200, deny)]
    urls = spark.createDataFrame([(f"http://{c}/x",) for c in "abcdefg"], "url string")
    got = tl.robots_filter(urls, robots_of(spark, *rows))
    assert sorted(r.url[7] for r in got.collect()) == ["c", "e", "g"]


def test_robots_equal_the_standard_library(spark):
    draw = random.Random(9)
    paths = ["/", "/a", "/a/b", "/a%20b", "/é", "/a+b", "/%C3%A9", "*", "/a?b=c", "/a;x", "", "/a%2Fb", "/A", "/%zz"]
    agents = ["*", "MySimpleCrawler", "crawler", "other", "mysimple"]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(draw.randint(0, 8)):
            kind = draw.choice(["User-agent", "Allow", "Disallow", "disallow", "Crawl-delay", "", "#"])
            value = draw.choice(agents) if kind == "User-agent" else draw.choice(paths)
            lines.append(f"{kind}: {value}" if kind not in ("", "#") else kind)
        texts.append("\n".join(lines))
    origins = [(f"http://h{i}.com", 200, t) for i, t in enumerate(texts)]
    urls = [(f"http://h{i}.com{p}",) for i in range(len(texts)) for p in paths if p != "*"]
    got = {r.url for r in tl.robots_filter(spark.createDataFrame(urls, "url string"), robots_of(spark, *origins)).collect()}
    wrong = []
    for i, text in enumerate(texts):
        parser = RobotFileParser()
        parser.parse(text.splitlines())
        for path in paths:
            url = f"http://h{i}.com{path}"
            if path != "*" and parser.can_fetch(AGENT, url) != (url in got):
                wrong.append((text, url))
    assert not wrong, wrong[:3]


def test_many_rules_are_looked_up_by_prefix(spark):
    pick = random.Random(7)
    way = lambda low, high: "".join(pick.choice("ab/") for _ in range(pick.randint(low, high)))
    texts = {
        f"http://{host}.com": "User-agent: *\n" + "".join(
            f"{pick.choice(['Allow', 'Disallow'])}: /{way(1, 9)}\n" for _ in range(count)
        )
        for host, count in (("large", 3000), ("even", 70), ("small", 9))
    }
    urls = [(n, f"{pick.choice(list(texts))}/{way(0, 12)}", "kept") for n in range(1500)]
    urls += [(n, "http://none.com/a", None) for n in range(3)] + [(9, None, "x"), (10, "http://large.com", "x")] + urls[:40]
    table = spark.createDataFrame(urls, "origin int, url string, path string")
    got = tl.robots_filter(table, robots_of(spark, *[(host, 200, text) for host, text in texts.items()]))
    parsers = {}
    for host, text in texts.items():
        parsers[host] = RobotFileParser()
        parsers[host].modified()
        parsers[host].parse(text.splitlines())
    allowed = lambda url: not url or "none" in url or parsers[url[: url.index(".com") + 4]].can_fetch(AGENT, url)
    wanted = [row for row in urls if allowed(row[1])]
    assert 300 < len(wanted) < 1400
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))


def test_work_of_a_url_does_not_grow_with_the_rules(spark):
    """Each URL meets at most as many nodes as its origin's rules have lengths."""
    text = "User-agent: *\n" + "".join(f"Disallow: /p{n:05d}\n" for n in range(10_000))
    rules = robots_rules(robots_of(spark, ("http://a.com", 200, text)))
    nodes = rule_nodes(rules)
    assert nodes.count() == 10_000 and nodes.select(F.char_length("prefix")).distinct().count() == 1
    urls = spark.range(30_000).select(F.format_string("http://a.com/p%05d", F.col("id").cast("int")).alias("url"))
    got = tl.robots_filter(urls, robots_of(spark, ("http://a.com", 200, text)))
    assert got.count() == 20_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
