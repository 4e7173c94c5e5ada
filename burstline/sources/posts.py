"""Raw posts: read, project, date, bound, clean.

Paths may be any URI Hadoop knows (``file:``, ``s3a:``, ...). Endpoint and
credentials of an object store belong in the session's ``spark.hadoop.*``
settings, which serve reads and writes alike.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.operators import terms
from burstline.schemas import RAW_POSTS


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Scan JSON lines with the declared schema.

    Lines that are no JSON come as nulls with the line in ``_corrupt_record``.
    """
    return (
        spark.read.schema(RAW_POSTS)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def project_posts(raw: DataFrame) -> DataFrame:
    """Nested leaves to ``post_id, text, lang, created_at`` (still text)."""
    return raw.select(
        F.col("twitter.id").alias("post_id"),
        F.col("interaction.content").alias("text"),
        F.col("language.tag").alias("lang"),
        F.col("twitter.created_at").alias("created_at"),
    )


def parse_created_at(value: Column) -> Column:
    """``Sat, 04 Feb 2012 09:38:03 +0000`` to a timestamp; null if it is none.

    The weekday is cut off, as Spark does not parse it; the offset is honoured.
    """
    return F.try_to_timestamp(
        F.regexp_extract(value, r"^\w{3}, (.*)$", 1),
        F.lit("dd MMM yyyy HH:mm:ss Z"),
    )


def _bound(value: str, name: str) -> datetime:
    try:
        return datetime.fromisoformat(value)
    except (TypeError, ValueError) as error:
        raise ValueError(f"{name} must be an ISO date or timestamp, got {value!r}") from error


def date_from(posts: DataFrame, start_date: str | None) -> DataFrame:
    """Keep posts at or after the start, if one is given."""
    if not start_date:
        return posts
    start = _bound(start_date, "start_date")
    return posts.filter(F.col("created_at") >= F.lit(start.isoformat(" ")).cast(_ts(posts)))


def date_to(
    posts: DataFrame, end_date: str | None, end_inclusive_day: bool = False
) -> DataFrame:
    """Keep posts at or before the end, if one is given.

    A bare date means its midnight; ``end_inclusive_day`` keeps the whole day.
    """
    if not end_date:
        return posts
    end = _bound(end_date, "end_date")
    if end_inclusive_day:
        after = end.replace(hour=0, minute=0, second=0, microsecond=0) + timedelta(days=1)
        return posts.filter(F.col("created_at") < F.lit(after.isoformat(" ")).cast(_ts(posts)))
    return posts.filter(F.col("created_at") <= F.lit(end.isoformat(" ")).cast(_ts(posts)))


def _ts(posts: DataFrame) -> str:
    return posts.schema["created_at"].dataType.simpleString()


def drop_undated(posts: DataFrame) -> DataFrame:
    """Drop posts without a usable time."""
    return posts.filter(F.col("created_at").isNotNull())


def prepare_posts(
    raw: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    end_inclusive_day: bool = False,
) -> DataFrame:
    """Raw nested posts to ``post_id, text, lang, created_at, cleaned_text``."""
    posts = project_posts(raw).withColumn(
        "created_at", parse_created_at(F.col("created_at"))
    )
    posts = date_to(date_from(posts, start_date), end_date, end_inclusive_day)
    return terms.with_cleaned_text(drop_undated(posts))


def load_posts(
    spark: SparkSession,
    path: str,
    start_date: str | None = None,
    end_date: str | None = None,
    end_inclusive_day: bool = False,
) -> DataFrame:
    """Read and prepare posts from JSON lines."""
    return prepare_posts(read_posts(spark, path), start_date, end_date, end_inclusive_day)
