"""Wall time of the headline queries: one cold and one warm run each, one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
number of local cores (default 8). `queries` holds the warm times, `cold` the
first ones; `value` is the sum of the warm times.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gazette.session import get_session
from gazette.workload.catalogue import QUERIES

HEADLINES = [
    "article_keys", "clean_newlines_urls", "pub_date_ladder", "queue_messages", "decode_messages",
    "metadata_merge", "feed_seed_new", "incremental_articles", "cursor_update", "latest_per_key",
    "cap_per_feed", "rss_roundtrip", "page_title_text", "ingest_articles", "ingest_articles_clean",
    "stream_ingest", "objects_per_day", "date_range_export", "export_csv", "export_json",
    "stored_articles", "null_profile", "describe_numeric", "describe_lineitem", "describe_text",
    "monthly_clean", "monthly_summary", "vector_topk_cosine", "vector_search_labels",
    "vector_collection", "embedded_documents",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in sys.argv[1:] or HEADLINES:
        for times in (cold, warm):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "sum of warm wall times of the headline queries",
        "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold,
        "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
