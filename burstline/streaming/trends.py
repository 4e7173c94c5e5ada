"""Windowed term counts on a stream, and trends from the windows that closed.

A batch run scores a window against all windows, later ones included; a stream
cannot. Two outputs keep the meanings apart: ``start_trending`` stores closed
counts and ranks a date's windows against all windows closed by then;
``running_burst`` scores each window once, against the past alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from burstline.operators import bursts
from burstline.schemas import TERM_COUNTS
from burstline.streaming.ingest import triggered

CLOSED = f"{TERM_COUNTS}, total long, windows long, date date, batch long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_OPTIONS = "spark.sql.streaming.stateStore.rocksdb"


def term_counts(
    terms: DataFrame, interval: str = "hour", watermark: str = "2 hours"
) -> DataFrame:
    """``time_window, topic, count`` of each window once it has closed.

    Occurrences later than the watermark are dropped.
    """
    duration = f"{bursts.interval_seconds(interval)} seconds"
    return (
        terms.withWatermark("created_at", watermark)
        .groupBy(F.window("created_at", duration).alias("time_window"), "topic")
        .count()
    )


def daily_averages(counts: DataFrame) -> DataFrame:
    """Mean of the hourly counts of each topic per closed day."""
    return (
        counts.groupBy(F.window(F.window_time("time_window"), "1 day").alias("day"), "topic")
        .agg(F.avg("count").alias("avg_count"), F.count("*").alias("n_hours"))
    )


def start_append(
    stream: DataFrame, path: str, checkpoint: str, every: str = "300 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream's rows to Parquet files."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return triggered(writer, every, available_now).start()


def with_totals(counts: DataFrame, expire_days: float | None = None) -> DataFrame:
    """``start_time, topic, count, total, windows`` of each closed count.

    ``total`` and ``windows`` are the sum and the number of the topic's counts up to
    the last one of the micro-batch. They are keyed state, two numbers per topic in the RocksDB
    store (``use_rocksdb``), so a micro-batch reads and writes its own topics only.
    See ``running_burst`` for ``expire_days``.
    """
    return _stateful(counts, expire_days).drop("own_total", "own_windows")


def store_closed(closed: DataFrame, path: str, batch: int) -> None:
    """Store the counts one micro-batch closed, by date and then by micro-batch.

    ``closed`` is a micro-batch of ``with_totals``. A window closes in one
    micro-batch with all its topics, and a repeated micro-batch overwrites its
    folders, so nothing is counted twice. A query that starts over with a new
    checkpoint needs a new path.
    """
    closed.select(
        "start_time", "topic", "count", "total", "windows",
        F.to_date("start_time").alias("date"), F.lit(batch).cast("long").alias("batch"),
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date", "batch"
    ).parquet(path)


def read_closed(
    spark: SparkSession, path: str, since: str | None = None, dates: Sequence[date] | None = None
) -> DataFrame:
    """Stored counts of the windows from ``since`` (a timestamp) on, or of all.

    With ``dates`` only the folders of these dates are listed and read. The columns
    ``date`` and ``batch`` are those of the folders.
    """
    reader = spark.read.schema(CLOSED).option("basePath", path)
    if dates is not None:
        return reader.parquet(*[f"{path}/date={d}" for d in dates])
    stored = reader.parquet(path)
    if since is not None:
        start = F.lit(since).cast("timestamp")
        stored = stored.filter((F.col("date") >= F.to_date(start)) & (F.col("start_time") >= start))
    return stored


def start_trending(
    counts: DataFrame,
    counts_path: str,
    trends_path: str,
    checkpoint: str,
    n: int = 5,
    interval: str = "hour",
    min_count: int = 2,
    every: str = "300 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Store closed counts, and the trends of the dates that a micro-batch closed.

    A topic's mean covers all windows closed so far, from totals in keyed state.
    A micro-batch reads the counts of its own dates only and replaces the trends of
    these dates; those of other dates stay as they were when their last window
    closed. So its work follows its own topics and dates, however many there were
    before. The session needs the RocksDB state store (``use_rocksdb``).
    """

    def run(closed: DataFrame, batch: int) -> None:
        spark = closed.sparkSession
        seen = Observation()
        dated = closed.observe(seen, F.collect_set(F.to_date("start_time")).alias("dates"))
        store_closed(dated, counts_path, batch)
        dates = sorted(seen.get["dates"])
        if not dates:
            return
        stored = read_closed(spark, counts_path, dates=dates)
        # windows close in the order of time, so since a date's topic was stored
        # last, it was in no other date but those of this micro-batch
        last = stored.groupBy("topic").agg(
            F.max_by(F.struct("total", "windows"), "batch").alias("last")
        )
        means = last.select("topic", (F.col("last.total") / F.col("last.windows")).alias("avg_count"))
        scored = bursts.with_burst_score(
            stored.select("start_time", "topic", "count").join(means, "topic")
        )
        ranked = bursts.top_n(bursts.min_count_floor(scored, min_count), n)
        bursts.flatten_window(ranked, interval).withColumn(
            "date", F.to_date("start_time")
        ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "date"
        ).parquet(trends_path)

    writer = (
        with_totals(counts).writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .foreachBatch(run)
    )
    return triggered(writer, every, available_now).start()


def use_rocksdb(spark: SparkSession, many_keys: bool = False) -> None:
    """Choose the state store ``running_burst`` needs, for this session.

    It keeps state on the executors' disks; the default store holds every key, and the
    versions of two micro-batches, in their heap. ``many_keys`` is for state of very many
    keys, like the counts of all terms: a micro-batch stores its changes alone, and the
    keys are not counted, which takes a read for each write.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if many_keys:
        spark.conf.set(f"{ROCKSDB_OPTIONS}.changelogCheckpointing.enabled", "true")
        spark.conf.set(f"{ROCKSDB_OPTIONS}.trackTotalNumberOfRows", "false")


def _running_totals(expire_ms: int | None) -> StatefulProcessor:
    class RunningTotals(StatefulProcessor):
        """Keeps (sum, windows, last window) of one topic."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.seen = handle.getValueState("seen", "total long, windows long, last long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            total, windows, last = self.seen.get() if self.seen.exists() else (0, 0, None)
            out = []
            for at, start, topic, count in sorted(
                (r["at"], r["start_time"], r["topic"], r["count"]) for r in rows
            ):
                if expire_ms is not None and last is not None and at - last > expire_ms:
                    total, windows = 0, 0
                total, windows, last = total + count, windows + 1, at
                out.append((start, topic, count, total, windows))
            self.seen.update((total, windows, last))
            if expire_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(last + expire_ms)
            for start, topic, count, own_total, own_windows in out:
                yield Row(
                    start_time=start, topic=topic, count=count, total=total, windows=windows,
                    own_total=own_total, own_windows=own_windows,
                )

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            self.seen.clear()
            return iter(())

        def close(self) -> None:
            pass

    return RunningTotals()


def _stateful(counts: DataFrame, expire_days: float | None) -> DataFrame:
    expire_ms = None if expire_days is None else int(expire_days * 86_400_000)
    rows = counts.select(
        F.col("time_window.start").alias("start_time"), "topic", "count",
        F.unix_millis(F.col("time_window.start")).alias("at"),
        F.window_time("time_window").alias("event_time"),
    )
    return rows.groupBy("topic").transformWithState(
        statefulProcessor=_running_totals(expire_ms),
        outputStructType="start_time timestamp, topic string, count long, total long, "
        "windows long, own_total long, own_windows long",
        outputMode="Append",
        timeMode="None" if expire_ms is None else "EventTime",
    )


def running_burst(counts: DataFrame, expire_days: float | None = None) -> DataFrame:
    """``start_time, topic, count, burst_score``: count over the mean so far.

    The mean covers the topic's windows up to and including this one, so a
    topic's first window scores 1.0. State per topic is two numbers and a time; the
    counts are aggregated already, so a topic brings one row per window. With
    ``expire_days`` a topic whose next window starts more than so many days of event
    time later starts anew, and is forgotten once the watermark has passed that time,
    so that state doesn't grow with all topics ever seen. By default nothing
    expires. The session needs the RocksDB state store (``use_rocksdb``).
    """
    scored = _stateful(counts, expire_days)
    mean = F.col("own_total") / F.col("own_windows")
    return scored.select(
        "start_time", "topic", "count", F.round(F.col("count") / mean, 2).alias("burst_score")
    )
