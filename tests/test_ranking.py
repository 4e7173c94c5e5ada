"""Complete ranks and first places, against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from burstline.operators import bursts, vocabulary
from burstline.operators.ranking import complete_rank, first_places
from conftest import plan_of

SCORED = "start_time long, topic string, burst_score double, count long"


def scored_rows(n, windows=3, scores=(1.0, 1.5, None)):
    rng = random.Random(n)
    rows = [(rng.choice([*range(windows), None]), f"t{i:05d}", rng.choice(scores), rng.randrange(3)) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [[], scored_rows(1), scored_rows(500), scored_rows(3000, 1, (1.0,))])
def test_complete_rank(spark, rows):
    df = spark.createDataFrame(rows, SCORED).repartition(7)
    order = [F.desc("burst_score"), F.desc("count"), F.asc("topic")]
    got = complete_rank(df, ["start_time"], order).collect()
    by_window = {}
    for r in rows:
        by_window.setdefault(r[0], []).append(r)
    expected = set()
    for own in by_window.values():
        own.sort(key=lambda r: (r[2] is None, -(r[2] or 0), -r[3], r[1]))
        expected |= {(*r, i) for i, r in enumerate(own, 1)}
    assert {tuple(r) for r in got} == expected and len(got) == len(rows)


def test_equal_rows_get_different_ranks(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)] * 3, "g string, x int")
    got = complete_rank(df, ["g"], [F.asc("x")]).collect()
    assert sorted((r["g"], r["rank"]) for r in got) == [("a", i) for i in range(1, 51)] + [("b", i) for i in (1, 2, 3)]


def test_no_range_holds_much_more_than_the_others(spark):
    """All topics in one window, tied, and alike in their first characters."""
    n = 40_000
    df = spark.range(n).select(
        F.lit(0).alias("start_time"), F.format_string("purchase:u%06d", F.col("id")).alias("topic"),
        F.lit(1.0).alias("burst_score"), F.lit(2).alias("count"),
    )
    cut = df.repartitionByRange("start_time", F.desc("burst_score"), F.desc("count"), "topic")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect())
        ranked = bursts.rank_in_window(df)
        rows = ranked.select("topic", "rank").orderBy("rank").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert [(r["topic"], r["rank"]) for r in rows] == [(f"purchase:u{i:06d}", i + 1) for i in range(n)]


def test_first_places_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame(scored_rows(500), SCORED)
    order = [F.desc("burst_score"), F.desc("count"), F.asc("topic")]
    first = first_places(df, ["start_time"], order, 4)
    assert {tuple(r) for r in first.collect()} == {
        tuple(r) for r in complete_rank(df, ["start_time"], order).filter("rank <= 4").collect()
    }
    assert plan_of(first).count("WindowGroupLimit") >= 2


def test_top_words_are_the_first_of_all_ranks(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["en", "nl", None]), [f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(9)])
            for _ in range(200)] + [("en", None), ("en", [None])]
    tokens = spark.createDataFrame(rows, "lang string, tokens array<string>")
    ranks, top = vocabulary.freq_rank(tokens), vocabulary.top_words(tokens, 7)
    assert ranks.dtypes == top.dtypes
    assert {tuple(r) for r in top.collect()} == {tuple(r) for r in ranks.filter("rank < 7").collect()}
    assert "WindowGroupLimit" in plan_of(top)
    common = {r["lang"]: set(r["common"]) for r in vocabulary.common_words(top, 7).collect()}
    assert common == {r["lang"]: set(r["common"]) for r in vocabulary.common_words(ranks, 7).collect()}
