"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``; ``BENCH_QUERIES`` may name others.
Each query runs once to warm up and ``BENCH_RUNS`` times for the median; results
are consumed by Spark's ``noop`` sink, so every row is computed and none is
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = (
    "trending_topics trends_day trends_week clean_text bigrams topical_tokens "
    "corpus_freq_rank explode_terms tfidf entities post_scores dq_report "
    "trend_features partitioned_posts stream_term_counts freq_filter pos_filter "
    "rank_in_window stream_trending"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "median seconds, sum over queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
