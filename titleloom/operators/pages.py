"""Titles and links of fetched pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.functions.html import h1_source, h1_title, hrefs, visible_html
from titleloom.functions.urls import normalize_url, resolve_links


def is_html_response(pages: DataFrame) -> Column:
    """Status 200 and an HTML content type. A column that is absent excludes nothing."""
    ok = F.lit(True)
    if "status" in pages.columns:
        ok = ok & F.coalesce(F.col("status") == 200, F.lit(False))
    if "content_type" in pages.columns:
        kind = F.coalesce(F.lower("content_type"), F.lit(""))
        ok = ok & F.contains(kind, F.lit("text/html"))
    return ok


def accepted_pages(pages: DataFrame) -> DataFrame:
    """Pages that count as crawled."""
    return pages.filter(is_html_response(pages))


def extract_titles(pages: DataFrame) -> DataFrame:
    """``(page_id, url, title)`` of accepted pages that have an H1; an empty H1 gives ``''``."""
    found = accepted_pages(pages).select(
        "page_id", "url", h1_source(visible_html(F.col("html")), F.col("html")).alias("h1")
    )
    # Filtering on the finished columns keeps the search for H1 from running twice per page.
    return found.select(
        "page_id", normalize_url(F.col("url")).alias("url"), h1_title(F.col("h1")).alias("title")
    ).filter(F.col("url").isNotNull() & F.col("title").isNotNull())


def extract_links(pages: DataFrame) -> DataFrame:
    """``(page_id, src, dst, pos)``: absolute http(s) links of accepted pages in page order."""
    found = accepted_pages(pages).select(
        "page_id",
        normalize_url(F.col("url")).alias("src"),
        hrefs(visible_html(F.col("html"))).alias("hrefs"),
    )
    # The outer form: the inner one adds a filter that extracts all links a second time.
    links = found.select("page_id", "src", F.posexplode_outer("hrefs").alias("pos", "href"))
    resolved = resolve_links(links.filter(F.col("pos").isNotNull()), "src", "href", "dst")
    return resolved.select("page_id", "src", "dst", "pos").filter(F.col("dst").isNotNull())
