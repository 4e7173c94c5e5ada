"""Raw JSON posts to stored columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from burstline.plans.quality import with_verdict
from burstline.sources import layout, posts as src


def etl_posts(
    spark: SparkSession, input_path: str, output_path: str, fmt: str = "parquet"
) -> DataFrame:
    """Store the dated, cleaned posts by date and language; read them back.

    ``fmt`` is ``parquet`` or ``orc``.
    """
    posts = src.load_posts(spark, input_path)
    layout.write_partitioned(layout.with_date(posts), output_path, fmt=fmt)
    return spark.read.format(fmt).load(output_path)


def store_quarantined(posts: DataFrame, path: str, languages: Sequence[str]) -> None:
    """Store projected posts in one pass, partitioned by ``verdict``."""
    with_verdict(posts, languages).write.mode("overwrite").partitionBy("verdict").parquet(path)
