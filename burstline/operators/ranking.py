"""Complete ranks of very large groups, and the first places alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstline.sources.layout import work_path

#: Low bits of ``monotonically_increasing_id``: a row's number in its partition.
ROW_BITS = 33


def complete_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Add ``rank``, from 1, of every row within its ``group`` by ``order``.

    The rows are cut into sampled ranges of the whole sort key, group columns
    first, so that neither a group nor a tie in the first sort columns is one
    task's: only rows that are equal in all of them stay together. Each range
    numbers its rows; where a group begins in a range, and how many of its rows the
    ranges before hold, comes from one row per range and group. Rows of one
    group with equal sort keys are numbered in any order.

    The sorted rows are stored in a work folder once. Sampled bounds need not be the
    same when a plan is run again, so the numbers and what they are counted from
    must be of one run.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in group]
    place = F.monotonically_increasing_id()
    path = work_path(spark, "ranked")
    (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_row", place)
        .write.parquet(path)
    )
    stored = spark.read.parquet(path).select(
        *df.columns,
        F.shiftright("_row", ROW_BITS).alias("_range"),
        F.col("_row").bitwiseAND((1 << ROW_BITS) - 1).alias("_row"),
    )
    ranges = stored.groupBy(*group, "_range").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_size")
    )
    before = Window.partitionBy(*group).orderBy("_range")
    offsets = ranges.select(
        *[F.col(c).alias(f"_of_{c}") for c in group], F.col("_range").alias("_of_range"),
        (F.sum("_size").over(before) - F.col("_size") - F.col("_first")).alias("_offset"),
    )
    same = F.col("_range") == F.col("_of_range")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return stored.join(offsets, same).select(
        *df.columns, (F.col("_offset") + F.col("_row") + 1).alias(rank)
    )


def first_places(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], most: int, rank: str = "rank"
) -> DataFrame:
    """The rows that would get ranks 1 to ``most`` from ``complete_rank``.

    The bound follows the numbering directly, so each task passes on no more than
    ``most`` rows per group (a group limit in the plan).
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= most)
