"""Posts as a stream: scan JSON lines, archive them to columnar files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from burstline.schemas import RAW_POSTS
from burstline.sources.layout import with_date, write_partitioned


def stream_posts(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Raw posts from a folder that JSON files arrive in.

    Any other streaming source with the same columns serves as well: the
    functions below take the DataFrame.
    """
    reader = spark.readStream.schema(RAW_POSTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def drop_redelivered(posts: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Keep the first delivery of each post id within ``delay`` of event time.

    A source that delivers at least once may bring a post again; the state holds
    the ids of the delay alone. Undated posts and null ids are dropped beforehand.
    """
    known = posts.filter(F.col("created_at").isNotNull() & F.col("post_id").isNotNull())
    return known.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["post_id"])


def start_archive(
    posts: DataFrame,
    path: str,
    checkpoint: str,
    every: str = "300 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Store dated posts in Parquet folders by micro-batch, date and language.

    Rows are dealt by date and language before they are written, so a micro-batch
    makes few files; a repeated one overwrites its own folder.
    """

    def run(rows: DataFrame, batch: int) -> None:
        write_partitioned(with_date(rows), f"{path}/batch={batch}")

    writer = (
        posts.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .foreachBatch(run)
    )
    return triggered(writer, every, available_now).start()


def triggered(writer, every: str, available_now: bool):
    """Process what is there and stop, or run at an interval."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)
