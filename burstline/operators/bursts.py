"""Windowed term counts, baselines, burst scores and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from burstline.operators.joins import HOT_KEYS, hot_keys, left_join_split_hot
from burstline.operators.ranking import complete_rank, first_places

SECONDS = {"hour": 3600, "day": 86400, "week": 7 * 86400}
#: One in so many terms is counted to find the topics that are hot.
HOT_SAMPLE = 64
#: Terms that one task groups by topic, and scores of hot topics that are broadcast.
TASK_TERMS, MOST_SCORES = 6 << 20, 1 << 20


def interval_seconds(interval: str) -> int:
    """Length of the named interval; unknown names are an error."""
    if interval not in SECONDS:
        raise ValueError(f"interval must be one of {sorted(SECONDS)}, got {interval!r}")
    return SECONDS[interval]


def window_start(
    ts: Column, interval: str, start_offset: str | None = None
) -> Column:
    """Start of the tumbling window that holds ``ts``.

    Windows are aligned to 1970-01-01 00:00 UTC, so weeks begin on Thursday;
    ``start_offset="4 days"`` makes them begin on Monday.
    """
    duration = f"{interval_seconds(interval)} seconds"
    if start_offset is None:
        return F.window(ts, duration)["start"]
    return F.window(ts, duration, duration, start_offset)["start"]


def window_end(start: Column, interval: str) -> Column:
    return start + F.make_dt_interval(secs=F.lit(interval_seconds(interval)))


def with_window_start(
    rows: DataFrame, interval: str = "hour", start_offset: str | None = None
) -> DataFrame:
    """Add ``start_time``, the window of ``created_at``; undated rows are dropped."""
    start = window_start(F.col("created_at"), interval, start_offset)
    return rows.withColumn("start_time", start).filter(F.col("start_time").isNotNull())


def count_by_window(terms: DataFrame) -> DataFrame:
    """Occurrences per (window, topic) of terms that have a ``start_time``.

    Counting is combined before the shuffle, which bounds what a frequent topic sends.
    """
    return terms.groupBy("start_time", "topic").count()


def window_term_counts(
    terms: DataFrame, interval: str = "hour", start_offset: str | None = None
) -> DataFrame:
    """Occurrences per (window, topic): ``start_time, topic, count``.

    The start alone identifies a window, so only it is shuffled.
    """
    return count_by_window(with_window_start(terms, interval, start_offset))


def topic_averages(counts: DataFrame, baseline: str = "present") -> DataFrame:
    """Mean count per topic: ``topic, avg_count``.

    ``present`` averages over the windows in which the topic occurs; ``all``
    counts every window of the data, absent ones as zero.
    """
    if baseline == "present":
        mean = F.avg("count")
    elif baseline == "all":
        mean = F.sum("count") / _window_total(counts)
    else:
        raise ValueError(f"baseline must be 'present' or 'all', got {baseline!r}")
    return counts.groupBy("topic").agg(mean.alias("avg_count"))


def _window_total(counts: DataFrame) -> Column:
    # Summing keeps the counts' columns as they are, so their shuffle is reused.
    per_window = counts.groupBy("start_time").agg(F.sum("count").alias("total"))
    return per_window.agg(F.count("total")).scalar()


def with_baseline(
    counts: DataFrame, baseline: str = "present", strategy: str = "window"
) -> DataFrame:
    """Add ``avg_count`` to every (window, topic) row.

    A topic has at most one row per window of the data, so no topic is a heavy
    key here. ``strategy="window"`` shuffles the counts once by topic;
    ``"join"`` aggregates them and joins the averages back.
    """
    if strategy == "join":
        return counts.join(topic_averages(counts, baseline), "topic")
    if strategy != "window":
        raise ValueError(f"strategy must be 'window' or 'join', got {strategy!r}")
    by_topic = Window.partitionBy("topic")
    if baseline == "present":
        mean = F.avg("count").over(by_topic)
    elif baseline == "all":
        mean = F.sum("count").over(by_topic) / _window_total(counts)
    else:
        raise ValueError(f"baseline must be 'present' or 'all', got {baseline!r}")
    return counts.withColumn("avg_count", mean)


def with_burst_score(averaged: DataFrame) -> DataFrame:
    """Add ``burst_score``: count over average, two decimals, half up."""
    return averaged.withColumn(
        "burst_score", F.round(F.col("count") / F.col("avg_count"), 2)
    )


def min_count_floor(scored: DataFrame, min_count: int = 2) -> DataFrame:
    """Drop low-volume rows. Belongs after the average, which includes them."""
    return scored.filter(F.col("count") >= min_count)


def _rank_order() -> tuple[Column, ...]:
    return F.desc("burst_score"), F.desc("count"), F.asc("topic")


def rank_in_window(scored: DataFrame) -> DataFrame:
    """Add ``rank``: by rounded score, then count, then topic within a window.

    A window may hold any number of topics, and most of them may have one score and
    count, so ranges of the whole sort key are ranked (see
    ``ranking.complete_rank``).
    """
    ranked = complete_rank(scored, ["start_time"], _rank_order())
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def top_n(scored: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` of every window.

    Every task keeps at most ``n`` rows per window before the shuffle, however full
    a window is.
    """
    return first_places(scored, ["start_time"], _rank_order(), n)


def flatten_window(ranked: DataFrame, interval: str) -> DataFrame:
    """The result layout: start_time, end_time, topic, count, burst_score, rank."""
    return ranked.select(
        "start_time",
        window_end(F.col("start_time"), interval).alias("end_time"),
        "topic",
        "count",
        "burst_score",
        "rank",
    )


def trends_from_counts(
    counts: DataFrame,
    n: int = 5,
    interval: str = "hour",
    min_count: int = 2,
    baseline: str = "present",
    strategy: str = "window",
) -> DataFrame:
    """Term counts to ranked trends."""
    scored = with_burst_score(with_baseline(counts, baseline, strategy))
    return flatten_window(top_n(min_count_floor(scored, min_count), n), interval)


def preview(trends: DataFrame, rows: int = 100) -> DataFrame:
    """The first rows by window and rank."""
    return trends.orderBy("start_time", "rank").limit(rows)


def topic_weights(trends: DataFrame, topic: str = "topic") -> DataFrame:
    """Word weights of the result's topics: ``word, count, weight``.

    The weight is the count relative to the commonest word's.
    """
    counts = (
        trends.filter(F.col(topic).isNotNull())
        .select(F.explode_outer(F.split(topic, " ")).alias("word"))
        .filter(F.length("word") > 0)
        .groupBy("word")
        .count()
    )
    highest = counts.agg(F.max("count")).scalar()
    return counts.withColumn("weight", F.col("count") / highest)


def post_scores(
    terms: DataFrame, trends: DataFrame | None = None, interval: str = "hour"
) -> DataFrame:
    """Score posts by the burst scores of their terms.

    ``terms`` is ``(post_id, created_at, topic)``. ``trends`` holds the scores of
    some topics, by default of every topic in every window, from the terms
    themselves. Every post with a term gets ``post_id, n_trending, max_score,
    avg_score``; zero if none of its terms has a score. A post's terms are hardly
    ever alike, so they are not counted per post: they are scored as they come.
    """
    rows = terms.select(
        "post_id", window_start(F.col("created_at"), interval).alias("start_time"), "topic"
    )
    if trends is None:
        number, odd = F.sum("terms"), F.count("hundredths")
        total = F.coalesce(F.sum("hundredths"), F.lit(0)) + 100 * (number - odd)
        highest = F.max("hundredths")
        return (
            _own_scores(rows, interval)
            .groupBy("post_id")
            .agg(
                number.alias("n_trending"),
                (F.when(odd < number, F.greatest(highest, F.lit(100))).otherwise(highest) / 100)
                .alias("max_score"),
                F.try_divide(total / 100, number).alias("avg_score"),
            )
            .na.fill(0, ["max_score", "avg_score"])
        )
    matched = _given_scores(rows, trends)
    # Scores have two decimals: a decimal sum does not depend on the row order.
    exact = F.col("burst_score").cast("decimal(18,2)")
    scored = F.when(F.col("burst_score").isNotNull(), 1).otherwise(0)
    return (
        matched.groupBy("post_id")
        .agg(
            F.sum(scored).alias("n_trending"),
            F.max("burst_score").alias("max_score"),
            F.try_divide(F.sum(exact).cast("double"), F.sum(scored)).alias("avg_score"),
        )
        .na.fill(0, ["max_score", "avg_score"])
    )


def _given_scores(
    rows: DataFrame, trends: DataFrame, of_hot: DataFrame | None = None
) -> DataFrame:
    """``post_id, burst_score`` of ``(post_id, start_time, topic)``, null without a score."""
    keys = ["start_time", "topic"]
    matched = left_join_split_hot(
        rows, trends.select(*keys, "burst_score"), keys, count_by_window(rows), hot_right=of_hot
    )
    return matched.select("post_id", "burst_score")


def _own_scores(rows: DataFrame, interval: str) -> DataFrame:
    """``post_id, terms, hundredths``: how many terms of a post there are, and their scores.

    ``hundredths`` is a score of a term, by the counts of the terms themselves; scores have two
    decimals. It is null in place of 100, the score of a topic whose windows have like counts, as
    most have. Rows with a score taken from the shuffle below have 0 ``terms``: they are
    counted before it, where all terms of a post are in one task, so that the
    results of a post per task are few and small.

    Terms are shuffled once, by their topic: a task counts its topics in all windows and
    scores the terms it holds, so that neither counts nor scores are shuffled. Topics
    of more than one in ``HOT_KEYS`` of all terms would fill a task. They are found by a
    sample, which decides about the way alone, not about a score; their scores, one row per
    window, go to the terms, by broadcast if there are few of them.
    """
    number, windows, hot = _hot_topics(rows, interval)
    is_hot = F.col("topic").isin(*hot)
    tasks = max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-number // TASK_TERMS)
    )
    # Null topics have no score.
    spread = rows.filter(~is_hot | F.col("topic").isNull()) if hot else rows
    in_time = Window.partitionBy("topic").orderBy("start_time")
    in_window = in_time.rangeBetween(Window.currentRow, Window.currentRow)
    by_topic = Window.partitionBy("topic")
    counted = (
        spread.repartition(tasks, "topic")
        .select(
            "post_id", "topic",
            F.count(F.lit(1)).over(in_window).alias("count"),
            F.dense_rank().over(in_time).alias("_window"),
        )
        .select(
            "post_id", "topic", "count",
            (F.count(F.lit(1)).over(by_topic) / F.max("_window").over(by_topic)).alias("avg_count"),
        )
    )
    score = F.round(F.col("burst_score") * 100).cast("long")
    odd = F.when(score != 100, score).alias("hundredths")
    scored = with_burst_score(counted.filter(F.col("topic").isNotNull())).select(
        "post_id", F.lit(0).cast("long").alias("terms"), odd
    ).filter(F.col("hundredths").isNotNull())
    terms = F.col("topic").isNotNull().cast("long").alias("terms")
    unscored = F.lit(None).cast("long").alias("hundredths")
    if not hot:
        return scored.unionByName(rows.select("post_id", terms, unscored))
    keys, among = ["start_time", "topic"], rows.filter(is_hot)
    counts = count_by_window(among)
    trends = with_burst_score(with_baseline(counts)).select(*keys, "burst_score")
    if windows * len(hot) <= MOST_SCORES:
        found = rows.join(F.broadcast(trends), keys, "left").select("post_id", terms, odd)
        return scored.unionByName(found)
    topics = hot_keys(counts, keys).select("topic").distinct()
    of_hot = with_burst_score(
        with_baseline(counts.join(F.broadcast(topics), "topic", "left_semi"))
    )
    found = _given_scores(among, trends, of_hot).select("post_id", F.lit(1).cast("long").alias("terms"), odd)
    return scored.unionByName(found).unionByName(spread.select("post_id", terms, unscored))


def _hot_topics(rows: DataFrame, interval: str) -> tuple[int, int, list[str]]:
    """The number of terms, the most windows they can have, and the hot topics.

    Too few terms for the sample to hold any, or none, count as none.
    """
    seen, at = Observation(), F.col("start_time").cast("timestamp").cast("long")
    counts = (
        rows.observe(
            seen, F.count(F.lit(1)).alias("number"), F.min(at).alias("first"), F.max(at).alias("last")
        )
        .sample(1 / HOT_SAMPLE, seed=0)
        .filter(F.col("topic").isNotNull())
        .groupBy("topic").count()
    )
    most = counts.orderBy(F.desc("count"), "topic").limit(HOT_KEYS).collect()
    if not most:  # the plan of an empty table observes nothing
        return 0, 0, []
    number = seen.get["number"]
    windows = (seen.get["last"] - seen.get["first"]) // interval_seconds(interval) + 1
    return number, windows, [r["topic"] for r in most if r["count"] * HOT_SAMPLE * HOT_KEYS > number]
