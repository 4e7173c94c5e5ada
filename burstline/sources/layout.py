"""Stored layouts: work folders, partitioned posts, archive tiers, catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables.

    It lies in the folder the session names as ``spark.checkpoint.dir``, else
    below the session's warehouse, which every executor reaches as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getCheckpointDir()
    base = base or spark.conf.get("spark.sql.warehouse.dir") + "/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to a work folder and read it, which cuts its lineage."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def with_date(posts: DataFrame, ts: str = "created_at") -> DataFrame:
    """Add ``dt``, the date posts are stored under."""
    return posts.withColumn("dt", F.to_date(ts))


def write_partitioned(
    df: DataFrame, path: str, by: tuple[str, ...] = ("dt", "lang"), fmt: str = "parquet"
) -> None:
    """Write posts as one folder per date and language (Parquet or ORC).

    The rebalance gives each folder few files of a good size, and splits a
    folder that holds much of the data over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite").partitionBy(*by).format(fmt).save(path)
    )


def split_by_age(
    df: DataFrame, days: int = 30, ts: str = "created_at"
) -> tuple[DataFrame, DataFrame]:
    """Current rows, and those more than ``days`` older than the newest date.

    A ``dt`` column is used as it is, so that stored partitions are pruned;
    without one it is added. Undated rows stay current.
    """
    dated = df if "dt" in df.columns else with_date(df, ts)
    newest = dated.agg(F.max("dt")).scalar()
    old = F.col("dt") < F.date_sub(newest, days)
    return dated.filter(~old | F.col("dt").isNull()), dated.filter(old)


def archive(df: DataFrame, path: str, days: int = 30, ts: str = "created_at") -> None:
    """Store the rows in one pass, partitioned by ``tier`` and date.

    ``archive`` holds what is more than ``days`` older than the newest date,
    ``current`` the rest and undated rows.
    """
    dated = df if "dt" in df.columns else with_date(df, ts)
    newest = dated.agg(F.max("dt")).scalar()
    old = F.coalesce(F.col("dt") < F.date_sub(newest, days), F.lit(False))
    tier = F.when(old, "archive").otherwise("current")
    write_partitioned(dated.withColumn("tier", tier), path, by=("tier", "dt"))


def stored_dates(spark: SparkSession, path: str, tier: str) -> list[str]:
    """The dates of a tier of a stored archive, from its folders' names alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/tier={tier}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(n.removeprefix("dt=") for n in names if n.startswith("dt="))


def advance_archive(spark: SparkSession, path: str, days: int = 30) -> list[str]:
    """Move the dates that have become too old to the archive tier; returns them.

    ``path`` is what ``archive`` wrote, to which newer dates may have been added
    since. Which dates are more than ``days`` older than the newest one is decided
    from the folders' names, and only their folders are renamed: no row is read or
    written, and a run without such a date changes nothing. A date that is in the archive
    already gets the files of the current tier besides its own.
    """
    base = path.rstrip("/")
    real = [d for d in stored_dates(spark, base, "current") if not d.startswith("__")]
    newest = max(real + stored_dates(spark, base, "archive"), default=None)
    if newest is None:
        return []
    limit = (date.fromisoformat(newest) - timedelta(days=days)).isoformat()
    old = [d for d in real if d < limit]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(base).getFileSystem(spark._jsc.hadoopConfiguration())
    for dt in old:
        source, target = hadoop(f"{base}/tier=current/dt={dt}"), hadoop(f"{base}/tier=archive/dt={dt}")
        if not fs.exists(target):
            fs.mkdirs(target.getParent())
            moved = fs.rename(source, target)
        else:
            files = [status.getPath() for status in fs.listStatus(source)]
            moved = all(fs.rename(file, hadoop(target, file.getName())) for file in files)
            moved = moved and fs.delete(source, True)
        if not moved:
            raise OSError(f"could not move {source} to {target}")
    return old


def register_view(df: DataFrame, name: str) -> None:
    """Make a result available to ``spark.sql`` in this session."""
    df.createOrReplaceTempView(name)


def register_bucketed(
    df: DataFrame, name: str, by: Sequence[str], buckets: int, fmt: str = "parquet"
) -> None:
    """Store a result as a catalog table, bucketed and sorted by columns.

    Tables with the same buckets are joined and grouped by these columns without a
    shuffle. Rows are dealt by the columns first, so that each bucket is one file.
    """
    (
        df.repartition(buckets, *by)
        .write.mode("overwrite").format(fmt).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    )


def register_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Store a result as a catalog table."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)
