"""spark-submit entry point: JSON posts in, ranked trends out as CSV.

    spark-submit burstline/jobs.py INPUT OUTPUT --interval hour --n 5
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

if __name__ == "__main__":  # spark-submit puts only this folder on the path
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from burstline.operators import bursts
from burstline.operators.terms import explode_terms, topical_tokens
from burstline.sources.posts import prepare_posts, read_posts
from burstline.sources.results import read_trends, write_trends

log = logging.getLogger("burstline")


def _check_arguments(
    input_path, output_path, n, interval, start_date, end_date, min_count
) -> None:
    for name, value in (("input_path", input_path), ("output_path", output_path)):
        if not isinstance(value, str) or not value:
            raise ValueError(f"{name} must be a non-empty string")
    for name, value in (("start_date", start_date), ("end_date", end_date)):
        if value is not None and not isinstance(value, str):
            raise ValueError(f"{name} must be a string")
    for name, value in (("n", n), ("min_count", min_count)):
        if not isinstance(value, int) or isinstance(value, bool) or value < 1:
            raise ValueError(f"{name} must be a positive integer")
    bursts.interval_seconds(interval)


def run_trending(
    input_path: str,
    output_path: str,
    n: int = 5,
    interval: str = "hour",
    start_date: str | None = None,
    end_date: str | None = None,
    min_count: int = 2,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Load, rank, write and show the trends; return them as stored.

    The plan runs once, for the write; the preview reads the written files.
    Counters of the run are logged. Errors are raised. A session made here is
    the caller's to stop, as the result belongs to it.
    """
    _check_arguments(
        input_path, output_path, n, interval, start_date, end_date, min_count
    )
    spark = spark or SparkSession.builder.appName("burstline").getOrCreate()
    observed = {
        name: Observation(name) for name in ("read", "dated", "with_tokens", "terms", "trends")
    }

    def counted(df: DataFrame, name: str, rows: Column | None = None) -> DataFrame:
        rows = F.count("*") if rows is None else rows
        return df.observe(observed[name], rows.alias("rows"))

    raw = counted(read_posts(spark, input_path), "read")
    posts = counted(prepare_posts(raw, start_date, end_date), "dated")
    tokens = counted(
        topical_tokens(posts), "with_tokens", F.count_if(F.size("tokens") > 0)
    )
    occurrences = counted(explode_terms(tokens), "terms")
    counts = bursts.window_term_counts(occurrences, interval)
    trends = bursts.trends_from_counts(counts, n, interval, min_count)
    write_trends(counted(trends, "trends"), output_path)
    log.info("rows: %s", {name: o.get["rows"] for name, o in observed.items()})
    stored = read_trends(spark, output_path)
    preview = stored.orderBy("timestamp_start", "rank").limit(100)
    preview.show(100, truncate=False)
    return stored


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("input_path")
    parser.add_argument("output_path")
    parser.add_argument("--n", type=int, default=5)
    parser.add_argument("--interval", default="hour", choices=sorted(bursts.SECONDS))
    parser.add_argument("--start-date")
    parser.add_argument("--end-date")
    parser.add_argument("--min-count", type=int, default=2)
    arguments = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("burstline").getOrCreate()
    try:
        run_trending(spark=spark, **arguments)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
