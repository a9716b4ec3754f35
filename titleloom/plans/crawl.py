"""Breadth-first crawl over stored pages, one round of joins per level."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from titleloom.functions.html import h1_source, h1_title, hrefs, visible_html
from titleloom.functions.urls import normalize_url, resolve_links
from titleloom.operators.frontier import (
    new_urls,
    seed_domains,
    within_domains,
)
from titleloom.operators.pages import accepted_pages
from titleloom.operators.robots import AGENT, robots_filter
from titleloom.plans.buckets import BucketedTable, bucket_count
from titleloom.plans.durable import folder_exists, remove_folder, stored_at, working_path, working_tables
from titleloom.plans.ranking import first_rows, ordered_ids
from titleloom.session import ship


@dataclass(frozen=True)
class CrawlResult:
    """``pages(url, depth, pos, page_id, title)`` in crawl order ``(depth, pos)``, and the URLs
    that were queued or visited."""

    pages: DataFrame
    visited: DataFrame

    def titles(self) -> DataFrame:
        """Rows for the title table; a page without an H1 has none."""
        return self.pages.filter(F.col("title").isNotNull()).select("url", "title")

    def counters(self) -> DataFrame:
        """One row ``(pages_crawled, unique_urls)``."""
        crawled = self.pages.select(F.lit(1).alias("crawled"), F.lit(0).alias("seen"))
        seen = self.visited.select(F.lit(0).alias("crawled"), F.lit(1).alias("seen"))
        return crawled.unionAll(seen).agg(
            F.coalesce(F.sum("crawled"), F.lit(0)).alias("pages_crawled"),
            F.coalesce(F.sum("seen"), F.lit(0)).alias("unique_urls"),
        )


def page_graph(pages: DataFrame, domains: DataFrame) -> DataFrame:
    """``(url, page_id, title, hrefs)`` of accepted pages within the domains.

    Foreign pages are dropped before their HTML is read; only titles and links are shuffled. Of
    pages with the same normalised URL the lowest ``page_id`` counts.
    """
    located = accepted_pages(pages).withColumn("url", normalize_url(F.col("url")))
    near = within_domains(located.filter(F.col("url").isNotNull()), domains, "url")
    read = near.select("page_id", "url", visible_html(F.col("html")).alias("visible"))
    found = read.select(
        "page_id", "url", h1_source(F.col("visible")).alias("h1"), hrefs(F.col("visible")).alias("hrefs")
    )
    titled = found.select("page_id", "url", h1_title(F.col("h1")).alias("title"), "hrefs")
    first = titled.groupBy("url").agg(
        F.min_by(F.struct("page_id", "title", "hrefs"), F.col("page_id")).alias("page")
    )
    return first.select("url", "page.page_id", "page.title", "page.hrefs")


def _seed_level(seeds: DataFrame) -> DataFrame:
    place = F.col("pos").cast("bigint") if "pos" in seeds.columns else F.lit(0).cast("bigint")
    urls = seeds.select(normalize_url(F.col("url")).alias("url"), place.alias("place"))
    first = urls.filter(F.col("url").isNotNull()).groupBy("url").agg(F.min("place").alias("place"))
    return ordered_ids(first, [F.col("place"), F.col("url")], "pos").select("url", "pos")


class _Crawl:
    """Tables of one crawl under a folder, and the manifest of the steps that are whole.

    ``start`` writes domains, the graph and the first frontier; step ``n`` writes level ``n`` and the frontier behind it.
    A step counts once its row is in the manifest; what an unfinished one left is written over. The table of
    visited URLs may then hold rows twice, or of a step that is run again: rows carry their step.
    """

    _MANIFEST = "step int, size bigint, room bigint, note string"
    _SEEN = StructType().add("url", "string").add("step", "integer")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.graph = self.seen = None
        self.finished: list[Row] = []
        if folder_exists(spark, self._at("manifest")):
            rows = spark.read.schema(self._MANIFEST).parquet(self._at("manifest")).collect()
            self.finished = sorted({row.step: row for row in rows}.values(), key=lambda row: row.step)

    def _at(self, name: str, step: int | None = None) -> str:
        return f"{self.folder}/{name}" if step is None else f"{self.folder}/{name}/{step:06d}"

    def note(self, step: int, size: int, room: int, note: str = "") -> None:
        """The step is whole."""
        row = self.spark.createDataFrame([(step, size, room, note)], self._MANIFEST)
        row.coalesce(1).write.mode("append").parquet(self._at("manifest"))
        self.finished.append(Row(step=step, size=size, room=room, note=note))

    def start(self, pages, seeds, robots, agent, buckets, settings) -> None:
        domains = stored_at(seed_domains(seeds), self._at("domains"))
        with working_tables(self.spark):
            graph = page_graph(pages, domains)
            if robots is not None:
                graph = robots_filter(graph, robots, agent)
            self._open(graph.schema, buckets)
            remove_folder(self.spark, self._at("graph"))
            self.graph.append(graph)
        self._add_frontier(_seed_level(seeds), 0)
        self.note(-1, 0, settings["max_pages"], json.dumps(
            settings | {"buckets": buckets, "graph": graph.schema.jsonValue()}
        ))

    def resume(self, settings) -> None:
        noted = json.loads(self.finished[0].note)
        other = {name: noted[name] for name, value in settings.items() if noted[name] != value}
        if other:
            raise ValueError(f"the crawl in {self.folder} was started with {other}")
        self._open(StructType.fromJson(noted["graph"]), noted["buckets"])

    def _open(self, schema: StructType, buckets: int) -> None:
        self.graph = BucketedTable(self.spark, self._at("graph"), schema, "url", buckets)
        self.seen = BucketedTable(self.spark, self._at("seen"), self._SEEN, "url", buckets)

    def close(self, keep: bool) -> None:
        for table in (self.graph, self.seen):
            if table:
                table.close()
        if not keep:
            for name in ("graph", "seen", "domains", "whole", "manifest"):
                remove_folder(self.spark, self._at(name))

    def _add_frontier(self, urls: DataFrame, step: int) -> None:
        frontier = stored_at(urls.select("url", "pos"), self._at("frontier", step))
        self.seen.append(frontier.withColumn("step", F.lit(step)))

    def frontier(self, *steps: int) -> DataFrame:
        return self.spark.read.schema("url string, pos bigint").parquet(*[self._at("frontier", n) for n in steps])

    def level_schema(self) -> StructType:
        return StructType([*self.graph.schema, *StructType().add("pos", "long").add("depth", "integer")])

    def levels(self, *steps: int) -> DataFrame:
        if not steps:
            return self.spark.createDataFrame([], self.level_schema())
        return self.spark.read.schema(self.level_schema()).parquet(*[self._at("level", n) for n in steps])

    def visited_before(self, step: int) -> DataFrame:
        return self.seen.read().filter(F.col("step") <= step).select("url")

    def new_links(self, step: int) -> DataFrame:
        """URLs that the pages of a level name first."""
        hrefs_of = self.levels(step).select(
            F.col("pos").alias("parent_pos"), "url", F.posexplode_outer("hrefs").alias("pos", "href")
        )
        links = resolve_links(hrefs_of.filter(F.col("pos").isNotNull()), "url", "href", "dst")
        domains = self.spark.read.schema("netloc string").parquet(self._at("domains"))
        near = within_domains(links.select("parent_pos", "pos", "dst").filter(F.col("dst").isNotNull()), domains)
        return new_urls(near, self.visited_before(step))

    def step(self, step: int, room: int) -> tuple[int, int]:
        """Crawl one level of at most ``room`` pages: its size, and the room left."""
        found = self.frontier(step).join(self.graph.read(), "url").withColumn("depth", F.lit(step))
        found = found.select(*self.level_schema().names)
        level = stored_at(found, self._at("level", step))
        size = level.count()
        if size > room:
            whole = stored_at(level, self._at("whole", step))
            stored_at(first_rows(whole, "pos", room), self._at("level", step))
            remove_folder(self.spark, self._at("whole", step))
            size = room
        if size:
            ordered = ordered_ids(self.new_links(step), [F.col("parent_pos"), F.col("link_pos")], "pos")
            self._add_frontier(ordered, step + 1)
        return size, room - size


def crawl_order(
    pages: DataFrame,
    seeds: DataFrame,
    max_pages: int = 100,
    robots: DataFrame | None = None,
    agent: str = AGENT,
    state: str | None = None,
    levels: int | None = None,
    buckets: int | None = None,
) -> CrawlResult:
    """Pages in the order in which a breadth-first crawl from ``seeds(url[, pos])`` meets them.

    Only accepted pages count towards ``max_pages``. Denied and missing pages are passed over.
    Every level is stored, so neither lineage nor the loss of an executor makes a level run twice. Page graph and
    visited URLs lie in the same hash buckets, as many as a shuffle has partitions unless the pages are few
    (``buckets``), so a level moves its new links and its frontier and not what was visited before.

    ``state`` names a shared folder in which the crawl is kept. A call with the folder of a crawl that did not come to
    its end, because the driver died or after a number of ``levels``, goes on behind the last whole level; it needs
    the same ``max_pages`` and agent, and reads neither pages nor robots again. One call at a time may use a folder.
    Without it only the tables that the result reads are left.
    """
    spark = ship(pages.sparkSession)
    crawl = _Crawl(spark, state.rstrip("/") if state else working_path(spark, "crawl"))
    settings = {"max_pages": max_pages, "agent": agent}
    try:
        if crawl.finished:
            crawl.resume(settings)
        else:
            crawl.start(pages, seeds, robots, agent, buckets or bucket_count(pages), settings)
        step, size, room = crawl.finished[-1].step, crawl.finished[-1].size, crawl.finished[-1].room
        begin = step
        while room > 0 and (step < 0 or size) and (levels is None or step - begin < levels):
            step += 1
            size, room = crawl.step(step, room)
            if state:
                crawl.note(step, size, room)
        columns = ["url", "depth", "pos", "page_id", "title"]
        crawled = crawl.levels(*range(step + 1)).select(*columns)
        reached = step + 1 if size or step < 0 else step
        return CrawlResult(crawled, crawl.frontier(*range(reached + 1)).select("url"))
    finally:
        crawl.close(keep=state is not None)
