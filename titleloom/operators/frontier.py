"""Steps of a same-domain crawl frontier, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleloom.functions.urls import netloc, normalize_url
from titleloom.plans.durable import stored


def seed_domains(seeds: DataFrame) -> DataFrame:
    """Distinct host parts of the seeds as given, port and case included."""
    return seeds.select(netloc(F.col("url")).alias("netloc")).distinct()


def start_frontier(seeds: DataFrame) -> DataFrame:
    """Distinct valid seeds ``(url)``."""
    urls = seeds.select(normalize_url(F.col("url")).alias("url"))
    return urls.filter(F.col("url").isNotNull()).distinct()


def within_domains(links: DataFrame, domains: DataFrame, url: str = "dst") -> DataFrame:
    """Links whose host part is a seed domain.

    No hint: Catalyst broadcasts the domains when their size allows. When it does not, adaptive execution
    splits a host with many links, provided that ``domains`` is a stored table and not an aggregate.
    """
    hosted = links.withColumn("netloc", netloc(F.col(url)))
    return hosted.join(domains, "netloc", "left_semi").drop("netloc")


def new_urls(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Link targets not seen before, each with the place of its first discovery.

    Duplicates are merged before the shuffle; the anti-join reuses its partitioning.
    """
    first = links.groupBy(F.col("dst").alias("url")).agg(
        F.min(F.struct("parent_pos", F.col("pos").alias("link_pos"))).alias("found")
    )
    fresh = first.join(visited.select("url"), "url", "left_anti")
    return fresh.select("url", "found.parent_pos", "found.link_pos")


def frontier_step(
    links: DataFrame, visited: DataFrame, seeds: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """One round: new URLs within the seed domains, and the visited set with them added.

    ``links`` has ``(dst, pos)`` and ``parent_pos``, the order of the linking page (its
    ``page_id`` when absent).
    """
    if "parent_pos" not in links.columns:
        links = links.withColumn("parent_pos", F.col("page_id"))
    domains = stored(seed_domains(seeds), "domains")
    fresh = new_urls(within_domains(links, domains), visited)
    return fresh, visited.select("url").unionByName(fresh.select("url"))
