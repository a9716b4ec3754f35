"""One query per operator; each takes a session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import titleloom as tl
from titleloom.functions.minhash import jaccard, jaccard_estimate
from titleloom.functions.text import has_title, has_tokens, tokens
from titleloom.functions.urls import netloc, normalize_url, origin, robots_url, scheme
from titleloom.operators.codec import coded_bits, code_tables
from titleloom.operators.index import forest_keys, last_documents, with_signature
from titleloom.operators.paging import numbered
from titleloom.operators.search import as_json
from titleloom.plans.durable import stored, working_path
from titleloom.session import ship
from titleloom.sources.containers import (
    container_name,
    container_titles,
    read_container_text,
    read_titles_container,
    write_container_files,
)
from titleloom.sources.tables import append_titles, read_table, read_text, read_titles_csv, write_text
from titleloom.streaming.titles import arriving_pages, expiring_state, ingest, ingest_index, titles_of

ALL_PAGES = 1 << 40

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(ship(spark), folder)

    QUERIES[function.__name__] = run
    return run


def _pages(spark, folder):
    return read_table(spark, folder, "pages")


def _documents(spark, folder):
    return read_table(spark, folder, "documents")


def _titles(spark, folder):
    """The title table of the pages, with ``page_id`` as id and row order."""
    return tl.extract_titles(_pages(spark, folder)).select(
        F.col("page_id").alias("id"), F.col("page_id").alias("pos"), "url", "title"
    )


def _as_titles(documents: DataFrame) -> DataFrame:
    """Documents as title rows: the whole text is what gets indexed."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("pos"),
        F.col("source").alias("url"),
        F.col("text").alias("title"),
    )


def _host_ends(url: Column, ending: str) -> Column:
    return F.endswith(netloc(url), F.lit(ending))


def _seeds(pages: DataFrame) -> DataFrame:
    """Pages of one top-level domain, in page order."""
    return pages.filter(_host_ends(F.col("url"), ".org")).select("url", F.col("page_id").alias("pos"))


def _responses(pages: DataFrame) -> DataFrame:
    """Pages with a status and a content type derived from the form of their URL."""
    url = F.col("url")
    kind = (
        F.when(F.contains(url, F.lit("utm_source")), "application/pdf")
        .when(F.startswith(url, F.lit("https:")), "Text/HTML; charset=utf-8")
        .when(F.contains(url, F.lit("//www.")), F.lit(None))
        .otherwise("text/html")
    )
    return pages.withColumn("status", F.when(F.contains(url, F.lit("#")), 404).otherwise(200)).withColumn(
        "content_type", kind
    )


def _robots(pages: DataFrame) -> DataFrame:
    """Robots answers per origin, derived from scheme and top-level domain."""
    host = F.col("origin")
    org = "User-agent: *\nDisallow: /en/\n"
    net = "User-agent: crawler\nAllow: /fr/1\nDisallow: /fr/\n\nUser-agent: *\nDisallow: /\n"
    com = "User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /de\nAllow: /de/1\n"
    text = (
        F.when(F.endswith(host, F.lit(".org")), F.lit(org))
        .when(F.endswith(host, F.lit(".net")), F.lit(net))
        .otherwise(F.lit(com))
    )
    status = (
        F.when(F.contains(host, F.lit("://blog.")), 403)
        .when(F.contains(host, F.lit("://m.")), F.lit(None))
        .when(F.contains(host, F.lit("://www.")) & F.startswith(host, F.lit("http:")), 404)
        .otherwise(200)
    )
    return pages.select(origin(F.col("url")).alias("origin")).distinct().select(
        "origin", status.alias("status"), text.alias("robots_txt")
    )


@query
def normalize_urls(spark, folder):
    return _pages(spark, folder).select("page_id", normalize_url(F.col("url")).alias("url"))


@query
def page_origins(spark, folder):
    url = F.col("url")
    return _pages(spark, folder).select(
        "page_id",
        scheme(url).alias("scheme"),
        netloc(url).alias("netloc"),
        origin(url).alias("origin"),
        robots_url(url).alias("robots_url"),
    )


@query
def accepted_pages(spark, folder):
    return tl.accepted_pages(_responses(_pages(spark, folder))).select("page_id", "url")


@query
def page_titles(spark, folder):
    return tl.extract_titles(_pages(spark, folder))


@query
def page_links(spark, folder):
    return tl.extract_links(_pages(spark, folder))


@query
def links_per_domain(spark, folder):
    links = tl.extract_links(_pages(spark, folder))
    return links.groupBy(netloc(F.col("dst")).alias("netloc")).agg(
        F.count("*").alias("links"), F.countDistinct("dst").alias("targets")
    )


@query
def seed_domains(spark, folder):
    return tl.seed_domains(_seeds(_pages(spark, folder)))


@query
def frontier_step(spark, folder):
    pages = _pages(spark, folder)
    visited = pages.select(normalize_url(F.col("url")).alias("url"))
    fresh, _ = tl.frontier_step(tl.extract_links(pages), visited, _seeds(pages))
    return fresh


@query
def visited_after_step(spark, folder):
    pages = _pages(spark, folder)
    seeds = _seeds(pages)
    _, visited = tl.frontier_step(tl.extract_links(pages), tl.start_frontier(seeds), seeds)
    return visited


@query
def robots_filter(spark, folder):
    pages = _pages(spark, folder)
    urls = pages.select("page_id", normalize_url(F.col("url")).alias("url"))
    return tl.robots_filter(urls, _robots(pages))


@query
def robots_many_rules(spark, folder):
    """Robots answers with a rule for every page of a site; a site is up to 500 pages in a row."""
    site = F.format_string("http://s%d.example.com", F.floor(F.col("page_id") / 500))
    path = F.regexp_extract("url", "://[^/]+(/[A-Za-z0-9/._-]*)", 1)
    pages = _pages(spark, folder).select("page_id", site.alias("site"), path.alias("path")).filter(F.char_length("path") > 3)
    rule = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("Allow: "), "path")).otherwise(
        F.concat(F.lit("Disallow: "), F.expr("left(path, length(path) - 1)"))
    )
    rules = F.array_sort(F.collect_list(F.struct("page_id", rule.alias("rule"))))["rule"]
    text = F.concat(F.lit("User-agent: *\n"), F.array_join(rules, "\n"))
    robots = pages.groupBy(F.col("site").alias("origin")).agg(text.alias("robots_txt")).withColumn("status", F.lit(200))
    return tl.robots_filter(pages.select("page_id", F.concat("site", "path").alias("url")), robots)


@query
def crawl_levels(spark, folder):
    pages = _pages(spark, folder)
    crawl = tl.crawl_order(pages, _seeds(pages), ALL_PAGES)
    return crawl.pages.select("url", "depth", "page_id", "title")


@query
def crawl_counters(spark, folder):
    pages = _pages(spark, folder)
    return tl.crawl_order(pages, _seeds(pages), ALL_PAGES).counters()


@query
def crawl_with_robots(spark, folder):
    pages = _pages(spark, folder)
    answers = _responses(pages)
    crawl = tl.crawl_order(answers, _seeds(pages), ALL_PAGES, _robots(pages))
    return crawl.titles()


def _linked_pages(spark, folder):
    """The pages, a page for every link target of the seeds' hosts, and the pages that those link on to."""
    pages = _pages(spark, folder)
    links = tl.extract_links(pages).filter(_host_ends(F.col("dst"), ".org"))
    number = lambda url: F.conv(F.substring(F.md5(url), 1, 12), 16, 10).cast("bigint")
    mark = F.substring(F.md5("url"), 1, 1)
    targets = links.select(F.col("dst").alias("url")).distinct()
    hops = targets.select(F.concat(origin(F.col("url")), F.lit("/hop/"), mark).alias("url")).distinct()
    onward = F.concat(F.lit("<h1>x</h1><a href=\"/hop/"), mark, F.lit("\">on</a>"))
    made = targets.withColumn("html", onward).unionByName(hops.withColumn("html", F.lit("<h1>end</h1>")))
    return pages.select("page_id", "url", "html").unionByName(
        made.select(number(F.col("url")).alias("page_id"), "url", "html")
    )


@query
def crawl_two_levels(spark, folder):
    """Seeds, the targets of their links, and one step further."""
    seeds = _seeds(_pages(spark, folder))
    return tl.crawl_order(_linked_pages(spark, folder), seeds, ALL_PAGES).pages.select("url", "depth")


@query
def crawl_resumed(spark, folder):
    """The same crawl, stopped after each of its first two levels and taken up again from its folder."""
    pages, seeds = _linked_pages(spark, folder), _seeds(_pages(spark, folder))
    state = working_path(spark, "kept-crawl")
    for _ in range(2):
        tl.crawl_order(pages, seeds, ALL_PAGES, state=state, levels=1)
    return tl.crawl_order(pages, seeds, ALL_PAGES, state=state).pages.select("url", "depth")


@query
def crawl_limit(spark, folder):
    """The first 60 pages in the order of the crawl."""
    seeds = _seeds(_pages(spark, folder))
    return tl.crawl_order(_linked_pages(spark, folder), seeds, 60).pages.select("url", "depth")


@query
def title_tokens(spark, folder):
    words = tokens(F.col("title"))
    return tl.extract_titles(_pages(spark, folder)).select(
        "page_id", F.size(words).alias("n_tokens"), F.array_join(F.array_sort(words), " ").alias("words")
    )


@query
def document_tokens(spark, folder):
    words = tokens(F.col("text"))
    return _documents(spark, folder).select(
        "doc_id",
        F.size(words).alias("n_tokens"),
        F.md5(F.array_join(F.array_sort(words), " ").cast("binary")).alias("words_md5"),
    )


@query
def dedup_last(spark, folder):
    turns = read_table(spark, folder, "conversations").select(
        F.col("conv_id").alias("id"),
        F.col("turn").alias("pos"),
        F.col("role").alias("url"),
        F.col("text").alias("title"),
    )
    return last_documents(turns)


@query
def index_counts(spark, folder):
    rows = _documents(spark, folder)
    return tl.build_index(_as_titles(rows)).count()


@query
def minhash_signatures(spark, folder):
    signed = with_signature(_documents(spark, folder), tokens(F.col("text")))
    return signed.select("doc_id", F.array_join("sig", ",").alias("signature"))


@query
def forest_keys_of_titles(spark, folder):
    docs = last_documents(_titles(spark, folder))
    keys = forest_keys(with_signature(docs, tokens(F.col("title"))), "id")
    return keys.select("id", "tree", "k0", F.hex("slots").alias("slots"))


@query
def jaccard_pairs(spark, folder):
    """Estimated and exact similarity of each conversation turn and the next."""
    rows = read_table(spark, folder, "conversations").select(
        "conv_id", "turn", tokens(F.col("text")).alias("words")
    )
    turns = with_signature(rows, F.col("words")).drop("trees")
    after = turns.select(
        "conv_id",
        (F.col("turn") - 1).alias("turn"),
        F.col("words").alias("next_words"),
        F.col("sig").alias("next_sig"),
    )
    return turns.join(after, ["conv_id", "turn"]).select(
        "conv_id",
        "turn",
        jaccard_estimate(F.col("sig"), F.col("next_sig")).alias("estimate"),
        jaccard(F.col("words"), F.col("next_words")).alias("exact"),
    )


def _title_queries(spark, folder):
    titles = _titles(spark, folder)
    return titles, titles.select(F.col("id").alias("qid"), F.col("title").alias("query"))


def _passage_queries(spark, folder):
    return read_table(spark, folder, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("query")
    )


@query
def forest_candidates(spark, folder):
    titles, asked = _title_queries(spark, folder)
    return tl.forest_candidates(tl.build_index(titles), asked)


@query
def search_titles(spark, folder):
    titles, asked = _title_queries(spark, folder)
    return tl.search(tl.build_index(titles), asked)


@query
def search_documents(spark, folder):
    index = tl.build_index(_as_titles(_documents(spark, folder)))
    hits = tl.search(index, _passage_queries(spark, folder))
    return hits.select("qid", "id", "url", "similarity", F.md5(F.col("title").cast("binary")).alias("title_md5"))


@query
def search_saved_index(spark, folder):
    """The same search through an index that was written and read back."""
    path = working_path(spark, "index")
    index = tl.write_index(_as_titles(_documents(spark, folder)), path)
    hits = tl.search(index, _passage_queries(spark, folder))
    return hits.select("qid", "id", "similarity")


@query
def search_updated_index(spark, folder):
    """The same search through an index that got its documents in three batches: some with stale texts and some that
    go again, then the others with the true texts of the stale ones, then after compaction the rest."""
    rows = _as_titles(_documents(spark, folder))
    turn = F.col("pos") % 4
    has_words = has_title(F.col("title")) & has_tokens(F.col("title"))
    text = F.when((turn == 1) & has_words, F.concat(F.lit("stale "), "title")).otherwise(F.col("title"))
    stale = rows.filter(turn < 2).withColumn("title", text)
    short_lived = rows.filter(turn == 3).withColumn("id", -1 - F.col("id"))
    late = F.col("pos") + ALL_PAGES
    index = tl.SegmentedIndex(spark, working_path(spark, "segments"))
    index.add(stale.unionByName(short_lived), batch=0)
    second = rows.filter(turn == 1).withColumn("pos", late).unionByName(rows.filter(turn == 2))
    for _ in range(2):  # delivered twice
        index.add(second, batch=1, removed=short_lived.select("id"))
    index.compact()
    index.clean()
    index.add(rows.filter(turn == 3), batch=2)
    hits = tl.search(index.load(), _passage_queries(spark, folder))
    return hits.select("qid", "id", "similarity")


@query
def search_streamed_index(spark, folder):
    """Titles of arriving pages, indexed batch by batch, and every title asked as a query."""
    path, marks = working_path(spark, "streamed-index"), working_path(spark, "stream-checkpoint")
    arriving = arriving_pages(spark, f"{folder}/pages.parquet*")
    ingest_index(titles_of(arriving, once=False), path, marks).awaitTermination()
    return tl.search(tl.SegmentedIndex(spark, path).load(), _title_queries(spark, folder)[1])


@query
def search_json(spark, folder):
    titles, asked = _title_queries(spark, folder)
    return as_json(tl.search(tl.build_index(titles), asked))


@query
def search_positions(spark, folder):
    titles, asked = _title_queries(spark, folder)
    hits = tl.search(tl.build_index(titles), asked, ordered=False)
    return numbered(hits).select("qid", "id", "similarity", "position", "page")


@query
def search_page(spark, folder):
    titles, asked = _title_queries(spark, folder)
    hits = tl.search(tl.build_index(titles), asked, ordered=False)
    return tl.paginate(hits, 1).select("qid", "id", "position", "label")


@query
def page_counts(spark, folder):
    titles, asked = _title_queries(spark, folder)
    return tl.page_counts(tl.search(tl.build_index(titles), asked, ordered=False))


def _codes(spark, folder):
    freqs = tl.char_frequencies(_documents(spark, folder), "lang")
    return stored(tl.huffman_codes(freqs), "codes")


@query
def char_frequencies(spark, folder):
    return tl.char_frequencies(_documents(spark, folder), "lang")


@query
def huffman_codes(spark, folder):
    return tl.huffman_codes(tl.char_frequencies(_documents(spark, folder), "lang"))


@query
def code_listing(spark, folder):
    return tl.code_listing(tl.huffman_codes(tl.char_frequencies(_documents(spark, folder), "lang")))


@query
def total_coded_bits(spark, folder):
    return coded_bits(tl.huffman_codes(tl.char_frequencies(_documents(spark, folder), "lang")))


@query
def code_table_sizes(spark, folder):
    table = F.from_json("table", "map<string,string>")
    return code_tables(_codes(spark, folder)).select(
        "scope",
        F.size(table).alias("symbols"),
        F.aggregate(
            F.map_values(table), F.lit(0), lambda total, code: total + F.length(code)
        ).alias("code_chars"),
    )


@query
def whole_file_frequencies(spark, folder):
    """Documents as text files by language, read whole, coded and decoded, and their characters counted."""
    path = working_path(spark, "texts")
    write_text(_documents(spark, folder), path, by="lang")
    files = read_text(spark, path).withColumn("lang", F.regexp_extract("path", "/lang=([^/]*)/", 1))
    back = tl.decompress_column(tl.compress_alone(files), name="text")
    return tl.char_frequencies(back, "lang")


@query
def compression_report(spark, folder):
    return tl.compression_report(_documents(spark, folder), _codes(spark, folder), "lang")


def _payload(blob: Column) -> tuple[Column, Column]:
    """Padding and code bytes of a container, read by its layout."""
    pieces = [F.hex(F.substring(blob, start, 1)) for start in (4, 3, 2, 1)]
    size = F.conv(F.concat(*pieces), 16, 10).cast("int")
    padding = F.conv(F.hex(F.substring(blob, size + 5, 1)), 16, 10).cast("int")
    return padding, F.substring(blob, size + 6, F.octet_length(blob))


@query
def compressed_documents(spark, folder):
    docs = _documents(spark, folder)
    packed = tl.compress_column(docs, _codes(spark, folder), "lang")
    padding, body = _payload(F.col("blob"))
    return packed.select(
        "doc_id",
        padding.alias("padding"),
        F.octet_length(body).alias("payload_bytes"),
        F.md5(body).alias("payload_md5"),
    )


@query
def codec_roundtrip(spark, folder):
    docs = _documents(spark, folder)
    codes = _codes(spark, folder)
    packed = tl.compress_column(docs, codes, "lang", header=False)
    back = tl.decompress_column(packed, name="decoded", codes=codes, scope="lang", tasks=0)
    return back.select(
        "doc_id",
        (F.col("decoded") == F.col("text")).alias("equal"),
        F.md5(F.col("decoded").cast("binary")).alias("text_md5"),
    )


@query
def single_file_roundtrip(spark, folder):
    turns = tl.compress_alone(read_table(spark, folder, "conversations"))
    back = tl.decompress_column(turns, name="decoded", tasks=0)
    return back.select("conv_id", "turn", F.md5(F.col("decoded").cast("binary")).alias("text_md5"))


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


@query
def titles_from_containers(spark, folder):
    """Each page as a container of CSV text with one title row, decoded and parsed again."""
    titles = tl.extract_titles(_pages(spark, folder))
    row = F.concat_ws(",", F.col("page_id").cast("string"), _quoted(F.col("title")), _quoted(F.col("url")))
    texts = titles.select(
        F.col("page_id").cast("string").alias("path"),
        F.concat(F.lit("id,title,url\n"), row, F.lit("\n")).alias("text"),
    )
    content = tl.compress_alone(texts).select("path", F.col("blob").alias("content"))
    return container_titles(content, tasks=0).select(F.col("id").cast("bigint").alias("id"), "url", "title")


@query
def container_files(spark, folder):
    """Each conversation as a container file, and what reading the files gives."""
    path = working_path(spark, "containers")
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")))
    turns = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    rows = read_table(spark, folder, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    texts = rows.select(F.col("conv_id").cast("string").alias("name"), F.array_join("turns.line", "\n").alias("text"))
    write_container_files(tl.compress_alone(texts), path)
    name = container_name(F.col("path")).cast("bigint")
    return read_container_text(spark, path).select(
        name.alias("conv_id"), F.char_length("text").alias("chars"), F.md5(F.col("text").cast("binary")).alias("text_md5")
    )


@query
def titles_from_container_files(spark, folder):
    """The title table as container files of CSV text, a hundred pages each, decoded and parsed again."""
    path = working_path(spark, "title-containers")
    titles = tl.extract_titles(_pages(spark, folder))
    row = F.concat_ws(",", F.col("page_id").cast("string"), _quoted(F.col("title")), _quoted(F.col("url")))
    lines = titles.groupBy(F.floor(F.col("page_id") / 100).cast("string").alias("name")).agg(F.collect_list(row).alias("rows"))
    texts = lines.select("name", F.concat(F.lit("id,title,url\n"), F.array_join("rows", "\n")).alias("text"))
    write_container_files(tl.compress_alone(texts), path)
    found = read_titles_container(spark, path)
    return found.select(F.col("id").cast("bigint").alias("id"), "url", "title")


@query
def titles_from_csv(spark, folder):
    path = working_path(spark, "csv")
    _titles(spark, folder).select("id", "title", "url").write.csv(path, header=True, escape='"')
    return read_titles_csv(spark, path).select(F.col("id").cast("bigint").alias("id"), "url", "title")


@query
def multiline_csv(spark, folder):
    """Page sources as CSV values with line breaks in quotes, read in splits."""
    path = working_path(spark, "pages-csv")
    rows = _pages(spark, folder).select(F.col("page_id").alias("id"), F.col("html").alias("title"), "url")
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = read_titles_csv(spark, path)
    html = F.coalesce("title", F.lit(""))
    return back.select(
        F.col("id").cast("bigint").alias("page_id"), "url", F.char_length(html).alias("chars"),
        F.md5(html.cast("binary")).alias("html_md5"),
    )


@query
def appended_titles(spark, folder):
    """The title table after two appends."""
    path = working_path(spark, "titles")
    titles = tl.extract_titles(_pages(spark, folder))
    for secure in (True, False):
        append_titles(titles.filter(F.startswith("url", F.lit("https:")) == secure), path)
    return spark.read.parquet(path)


def _ingested(spark, folder, once):
    out, marks = working_path(spark, "stream"), working_path(spark, "stream-checkpoint")
    arriving = arriving_pages(spark, f"{folder}/pages.parquet*")
    ingest(titles_of(arriving, once), out, marks).awaitTermination()
    return spark.read.parquet(out)


@query
def stream_titles(spark, folder):
    return _ingested(spark, folder, once=False)


@query
def stream_recent_urls(spark, folder):
    """As ``stream_unique_urls``, with an arrival time that bounds the state."""
    out, marks = working_path(spark, "stream"), working_path(spark, "stream-checkpoint")
    arriving = arriving_pages(spark, f"{folder}/pages.parquet*")
    timed = arriving.withColumn("arrived", F.timestamp_seconds(F.col("page_id") + 1_700_000_000))
    ingest(titles_of(timed, arrival="arrived"), out, marks).awaitTermination()
    return spark.read.parquet(out).select("url")


@query
def stream_remembered_urls(spark, folder):
    """As ``stream_unique_urls``, with state that expires by the clock."""
    out, marks = working_path(spark, "stream"), working_path(spark, "stream-checkpoint")
    arriving = arriving_pages(spark, f"{folder}/pages.parquet*")
    with expiring_state(spark):
        started = ingest(titles_of(arriving, remember=timedelta(days=1)), out, marks)
    started.awaitTermination()
    return spark.read.parquet(out).select("url")


@query
def stream_unique_urls(spark, folder):
    return _ingested(spark, folder, once=True).select("url")
