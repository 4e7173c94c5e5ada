from pyspark.sql import functions as F

from burstline.operators.joins import left_join_split_hot, member
from conftest import plan_of


def skewed(spark):
    """One key on a third of the rows, unmatched keys, and a long tail."""
    ids = spark.range(30_000)
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("tail"), F.col("id")))
        .when(F.col("id") % 6 == 2, "hot_unmatched")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    )
    return ids.select("id", key.alias("key"))


def test_equals_a_plain_left_join(spark):
    left = skewed(spark)
    counts = left.groupBy("key").count()
    right = counts.filter("key not in ('hot_unmatched', 'k7')").select(
        "key", F.length("key").alias("n"), F.upper("key").alias("u")
    )
    ours = left_join_split_hot(left, right, ["key"], counts)
    plain = left.join(right, "key", "left").select(ours.columns)
    assert ours.count() == 30_000
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_hot_rows_spread_over_the_shuffle(spark):
    """Without a broadcast of the cold side no task gets the hot key's rows."""
    left = skewed(spark)
    counts = left.groupBy("key").count()
    right = counts.select("key", F.length("key").alias("n"))
    plain = left.join(right.hint("merge"), "key", "left")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = left_join_split_hot(left, right, ["key"], counts)
        shuffles = [x for x in plan_of(joined).splitlines() if "hashpartitioning(_key" in x]
        assert len(shuffles) == 2 and all("_spread" in x for x in shuffles)
        sizes, lumped = (
            df.groupBy(F.spark_partition_id().alias("p"))
            .agg(F.count("*").alias("rows"), F.max("n"))  # uses n, or the join would go
            .collect()
            for df in (joined, plain)
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(r["rows"] for r in lumped) >= 10_000  # what the split avoids
    assert sum(r["rows"] for r in sizes) == 30_000
    assert max(r["rows"] for r in sizes) < 30_000 / 8 * 1.5


def test_two_keys_and_empty_left(spark):
    left = spark.createDataFrame([(1, "a", 9), (1, "b", 8)], "x int, y string, v int")
    right = spark.createDataFrame([(1, "a", 0.5)], "x int, y string, s double")
    counts = left.groupBy("x", "y").count()
    rows = left_join_split_hot(left, right, ["x", "y"], counts).orderBy("y").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 9, 0.5), (1, "b", 8, None)]
    none = left.limit(0)
    assert left_join_split_hot(none, right, ["x", "y"], counts.limit(0)).isEmpty()


def test_member_keeps_all_listed_keys_and_few_others(spark):
    listed = spark.range(0, 40_000, 7).select(F.xxhash64("id").alias("key"))
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("key"))
    passed = {r["id"] for r in rows.filter(member(listed, listed.count(), F.col("key"))).collect()}
    own = set(range(0, 40_000, 7))
    assert own <= passed
    assert len(passed - own) < 0.1 * (40_000 - len(own))
    none = spark.createDataFrame([], "key long")
    assert rows.filter(member(none, 0, F.col("key"))).count() == 0


def test_member_works_beyond_its_bound(spark, monkeypatch):
    monkeypatch.setattr("burstline.operators.joins.MOST_BITS", 256)
    listed = spark.range(100).select(F.xxhash64("id").alias("key"))
    passed = listed.filter(member(listed, 100, F.col("key")))
    assert passed.count() == 100


def test_hot_rows_may_come_from_a_table_of_their_own(spark):
    left = skewed(spark)
    counts = left.groupBy("key").count()
    right = counts.select("key", F.length("key").alias("n"))
    few = right.filter("key not like 'tail%'")
    ours = left_join_split_hot(left, right, ["key"], counts, hot_right=few)
    plain = left.join(right, "key", "left").select(ours.columns)
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()
