"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of local threads. Every
query is computed in full and its rows are thrown away; the second of two runs counts, so that
starting Python workers and compiling plans is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from titleloom.session import build_session  # noqa: E402

HEADLINES = [
    "normalize_urls",
    "page_titles",
    "page_links",
    "frontier_step",
    "robots_filter",
    "crawl_levels",
    "dedup_last",
    "minhash_signatures",
    "forest_candidates",
    "search_titles",
    "search_documents",
    "search_page",
    "char_frequencies",
    "huffman_codes",
    "compression_report",
    "compressed_documents",
    "codec_roundtrip",
    "single_file_roundtrip",
    "titles_from_containers",
    "stream_titles",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        for _ in range(2):
            spark.catalog.clearCache()
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    scale = Path(folder).name
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[2:]) if scale.startswith("sf") else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
