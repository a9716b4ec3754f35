"""Build and query a searchable corpus of web pages with Spark.

Pages become titles and links, titles become a MinHash prefix-forest index, queries get ranked and
paged results, and texts get character statistics, Huffman codes and compressed columns.
"""

from titleloom.operators.codec import (
    char_frequencies,
    code_listing,
    compress_alone,
    compress_column,
    compression_report,
    decompress_column,
    huffman_codes,
)
from titleloom.operators.frontier import frontier_step, seed_domains, start_frontier
from titleloom.operators.index import Index, build_index, write_index
from titleloom.operators.pages import accepted_pages, extract_links, extract_titles
from titleloom.operators.paging import page_counts, paginate
from titleloom.operators.robots import robots_filter
from titleloom.operators.search import forest_candidates, query_table, search
from titleloom.operators.segments import SegmentedIndex
from titleloom.plans.crawl import CrawlResult, crawl_order
from titleloom.plans.durable import clear_working_tables, working_tables
from titleloom.session import build_session

__all__ = [
    "CrawlResult",
    "Index",
    "SegmentedIndex",
    "accepted_pages",
    "build_index",
    "build_session",
    "char_frequencies",
    "clear_working_tables",
    "code_listing",
    "compress_alone",
    "compress_column",
    "compression_report",
    "crawl_order",
    "decompress_column",
    "extract_links",
    "extract_titles",
    "forest_candidates",
    "frontier_step",
    "huffman_codes",
    "page_counts",
    "paginate",
    "query_table",
    "robots_filter",
    "search",
    "seed_domains",
    "start_frontier",
    "working_tables",
    "write_index",
]
