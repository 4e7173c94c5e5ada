from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from burstline.operators import bursts
from burstline.plans.trending import post_terms, trending
from checks import inputs
from conftest import plan_of

SF = "/root/testdata/sf0.001"
HOUR = datetime(2012, 2, 4, 9)


@pytest.fixture
def counts(spark):
    """Counts 4, 1, 1 of one topic over three hours, and 3 of another in one."""
    rows = [(HOUR, "a", 4), (HOUR + timedelta(hours=1), "a", 1),
            (HOUR + timedelta(hours=2), "a", 1), (HOUR, "b", 3)]
    return spark.createDataFrame(rows, "start_time timestamp_ntz, topic string, count long")


def scores(df):
    return {(r["topic"], r["start_time"].hour): r["burst_score"] for r in df.collect()}


@pytest.mark.parametrize("strategy", ["window", "join"])
def test_golden_scores(counts, strategy):
    present = bursts.with_burst_score(bursts.with_baseline(counts, strategy=strategy))
    assert scores(present) == {("a", 9): 2.0, ("a", 10): 0.5, ("a", 11): 0.5, ("b", 9): 1.0}
    everywhere = bursts.with_burst_score(bursts.with_baseline(counts, "all", strategy))
    assert scores(everywhere) == {("a", 9): 2.0, ("a", 10): 0.5, ("a", 11): 0.5, ("b", 9): 3.0}


def test_average_sees_counts_below_the_floor(counts):
    rows = bursts.trends_from_counts(counts, min_count=2).collect()
    assert [(r["topic"], r["count"], r["burst_score"], r["rank"]) for r in rows] == [
        ("a", 4, 2.0, 1), ("b", 3, 1.0, 2),
    ]
    assert rows[0]["end_time"] - rows[0]["start_time"] == timedelta(hours=1)


def test_published_scores(spark):
    """6 against a mean of 16/5 is 1.88, half up."""
    rows = [(HOUR + timedelta(hours=i), "t", c) for i, c in enumerate([6, 4, 3, 2, 1])]
    df = spark.createDataFrame(rows, "start_time timestamp_ntz, topic string, count long")
    scored = bursts.with_burst_score(bursts.with_baseline(df))
    assert scores(scored)[("t", 9)] == 1.88


def test_ties_break_by_count_then_topic(spark):
    rows = [(HOUR, "c", 5), (HOUR, "b", 5), (HOUR, "d", 9)]
    df = spark.createDataFrame(rows, "start_time timestamp_ntz, topic string, count long")
    ranked = bursts.trends_from_counts(df, n=2).orderBy("rank").collect()
    assert [r["topic"] for r in ranked] == ["d", "b"]


@pytest.mark.parametrize("call", [
    lambda c: bursts.with_baseline(c, baseline="median"),
    lambda c: bursts.with_baseline(c, strategy="loop"),
    lambda c: bursts.topic_averages(c, baseline="median"),
    lambda c: bursts.trends_from_counts(c, interval="month"),
])
def test_unknown_names_are_errors(counts, call):
    with pytest.raises(ValueError):
        call(counts)


def test_window_alignment(spark):
    df = spark.createDataFrame([(datetime(2012, 2, 4, 9, 38, 3),)], "t timestamp_ntz")
    def start(*options):
        return df.select(bursts.window_start(F.col("t"), *options).alias("s")).first()["s"]

    assert start("hour") == datetime(2012, 2, 4, 9)
    assert start("day") == datetime(2012, 2, 4)
    assert start("week") == datetime(2012, 2, 2)
    assert start("week", "4 days") == datetime(2012, 1, 30)


@pytest.mark.parametrize("interval", ["hour", "day", "week"])
def test_trends_hold_their_invariants(spark, interval):
    n, floor = 4, 2
    posts = inputs.cleaned(spark, SF)
    rows = trending(posts, n=n, interval=interval, min_count=floor).collect()
    by_window = defaultdict(list)
    for row in rows:
        by_window[row["start_time"]].append(row)
    assert rows
    for window in by_window.values():
        window.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in window] == list(range(1, len(window) + 1))
        assert len(window) <= n and all(r["count"] >= floor for r in window)
        order = [(-r["burst_score"], -r["count"], r["topic"]) for r in window]
        assert order == sorted(order)


def test_topics_of_one_window_score_one(spark):
    counts = bursts.window_term_counts(post_terms(inputs.cleaned(spark, SF)))
    scored = bursts.with_burst_score(bursts.with_baseline(counts))
    once = scored.groupBy("topic").agg(F.count("*").alias("n"), F.max("burst_score").alias("s"))
    assert once.filter("n = 1 AND s <> 1.0").count() == 0


def test_strategies_agree(spark):
    posts = inputs.cleaned(spark, SF)
    for baseline in ("present", "all"):
        a = trending(posts, baseline=baseline, strategy="window")
        b = trending(posts, baseline=baseline, strategy="join")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_high_floor_and_empty_input_give_nothing(spark):
    posts = inputs.cleaned(spark, SF)
    assert trending(posts, min_count=9999).isEmpty()
    empty = spark.createDataFrame(
        [], "text string, lang string, created_at timestamp, cleaned_text string"
    )
    for baseline in ("present", "all"):
        assert trending(empty, baseline=baseline).isEmpty()
    assert trending(empty).columns == [
        "start_time", "end_time", "topic", "count", "burst_score", "rank"
    ]


def test_plan_of_the_trends(spark):
    plan = plan_of(trending(inputs.cleaned(spark, SF)))
    assert plan.count("WindowGroupLimit") == 2  # before and after the last shuffle
    assert plan.count("Generate") == 1
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert unwanted not in plan


def test_topic_weights(spark):
    df = spark.createDataFrame([("a b",), ("a",), (None,), ("c",)], "topic string")
    rows = {r["word"]: (r["count"], r["weight"]) for r in bursts.topic_weights(df).collect()}
    assert rows == {"a": (2, 1.0), "b": (1, 0.5), "c": (1, 0.5)}


def test_post_scores(spark):
    rows = [(1, HOUR, "x"), (1, HOUR, "x"), (1, HOUR, "y"), (2, HOUR, "y"), (3, HOUR, "z")]
    found = spark.createDataFrame(rows, "post_id long, created_at timestamp_ntz, topic string")
    trends = spark.createDataFrame(
        [(HOUR, "x", 3.0), (HOUR, "y", 1.5)],
        "start_time timestamp_ntz, topic string, burst_score double",
    )
    got = {
        r["post_id"]: (r["n_trending"], r["max_score"], r["avg_score"])
        for r in bursts.post_scores(found, trends).collect()
    }
    assert got == {1: (3, 3.0, 2.5), 2: (1, 1.5, 1.5), 3: (0, 0.0, 0.0)}


def test_post_scores_of_hot_repeated_and_undated_rows(spark):
    """Posts share ids, some are undated, one topic of one window is hot."""
    rows = [(i % 50 or None, HOUR, "hot") for i in range(300)]
    rows += [(i % 50 or None, HOUR + timedelta(hours=i % 3), f"t{i % 11}") for i in range(200)]
    rows += [(7, None, "hot"), (99, None, "t1")]
    found = spark.createDataFrame(rows, "post_id long, created_at timestamp_ntz, topic string")
    uses, per_topic = Counter((t, x) for _, t, x in rows if t), defaultdict(list)
    for (_, topic), count in uses.items():
        per_topic[topic].append(count)
    expected = defaultdict(list)
    for i, t, topic in rows:
        if t:  # a window holds dated rows only
            mean = sum(per_topic[topic]) / len(per_topic[topic])
            expected[i].append(float(Decimal(repr(uses[t, topic] / mean)).quantize(Decimal("0.01"), ROUND_HALF_UP)))
    result = bursts.post_scores(found)
    got = {r["post_id"]: (r["n_trending"], r["max_score"], r["avg_score"]) for r in result.collect()}
    assert got.keys() == expected.keys()
    for i, scores in expected.items():
        assert got[i] == (len(scores), max(scores), pytest.approx(sum(scores) / len(scores)))
    # no table of (post, window, topic) counts, which is as large as the terms
    for line in plan_of(result).splitlines():
        assert not ("Aggregate(keys=[post_id" in line and "topic" in line)


@pytest.mark.parametrize("hot, most", [([], 1 << 20), (["hot", "t3"], 1 << 20), (["hot", "t3"], 0)])
def test_post_scores_shuffle_the_terms_once(spark, monkeypatch, hot, most):
    """Whichever topics are said to be hot, scores are the same; nothing but terms is shuffled."""
    rows = [(i % 40 or None, HOUR + timedelta(hours=i % 2), "hot") for i in range(150)]
    rows += [(i % 50, HOUR + timedelta(hours=i % 7), f"t{i * i % 13}") for i in range(300)]
    rows += [(7, None, "hot"), (98, HOUR, None), (98, HOUR, "t1"), (99, HOUR, None)]
    found = spark.createDataFrame(rows, "post_id long, created_at timestamp_ntz, topic string")
    uses, per_topic = Counter((t, x) for _, t, x in rows if t), defaultdict(list)
    for (_, topic), count in uses.items():
        per_topic[topic].append(count)
    expected = defaultdict(list)
    for i, t, topic in rows:
        if t:
            mean = sum(per_topic[topic]) / len(per_topic[topic])
            score = float(Decimal(repr(uses[t, topic] / mean)).quantize(Decimal("0.01"), ROUND_HALF_UP))
            expected[i] += [] if topic is None else [score]
    monkeypatch.setattr(bursts, "_hot_topics", lambda *_: (len(rows), 7, hot), raising=False)
    monkeypatch.setattr(bursts, "MOST_SCORES", most, raising=False)
    result = bursts.post_scores(found)
    shuffles = [x for x in plan_of(result).splitlines() if "Exchange hashpartitioning" in x and "topic" in x]
    got = {r["post_id"]: (r["n_trending"], r["max_score"], r["avg_score"]) for r in result.collect()}
    assert got == {
        i: (len(x), max(x, default=0), pytest.approx(sum(x) / max(len(x), 1))) for i, x in expected.items()
    }
    assert [x for x in shuffles if "hashpartitioning(topic" in x and "REPARTITION_BY_NUM" in x]
    assert hot or len(shuffles) == 1


def test_hot_topics_are_found_by_a_sample(spark):
    rows = [(HOUR + timedelta(hours=i % 30), "hot" if i % 5 == 0 else f"t{i}") for i in range(20000)]
    found = spark.createDataFrame(rows, "start_time timestamp_ntz, topic string").repartition(4)
    number, windows, hot = bursts._hot_topics(found, "hour")
    assert (number, windows) == (20000, 30) and "hot" in hot and len(hot) <= 1000
    assert bursts._hot_topics(found.limit(0), "hour") == (0, 0, [])


def test_terms_are_counted_once_for_all_windows(spark):
    rows = [(1, "en", HOUR, "storm over rome"), (2, "en", None, "storm")]
    posts = spark.createDataFrame(
        rows, "post_id long, lang string, created_at timestamp_ntz, cleaned_text string"
    )
    found = trending(posts, baseline="all", min_count=1)
    assert {r["topic"] for r in found.collect()} == {"storm", "rome", "storm rome"}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the reuse isn't in the plan
    try:
        lines = plan_of(found.select("*")).splitlines()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    by_window = [x for x in lines if "Exchange hashpartitioning(start_time" in x and "topic" in x]
    assert len([x for x in by_window if "ReusedExchange" not in x]) == 1
