"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   table directory, default /root/testdata/sf0.1
    BENCH_CPUS     local cores, default 8
    BENCH_QUERIES  comma-separated names, default the headline queries
"""

from __future__ import annotations

import json
import os
import sys
import time

from postlens.plans.queries import QUERIES
from postlens.session import local_session

HEADLINE = [
    "basic_stats", "hourly_sentiment", "hashtag_trends", "activity_spikes", "content_velocity", "clean_text",
    "extract_entities", "lexicon_sentiment", "enrich_posts", "dedupe_exact", "dedupe_near", "extract_keywords", "keyword_trends",
    "keyword_trends_by_platform", "emerging_topics", "topic_predictions", "competitor_mentions", "extract_articles",
    "recommend_all", "cycle_analysis", "cycle_summary",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, partitions=int(cores), memory="16g")
    QUERIES["source_counts"](spark, directory).count()  # starts the session's workers and caches
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = os.path.basename(directory.rstrip("/"))
    print(
        json.dumps(
            {"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
