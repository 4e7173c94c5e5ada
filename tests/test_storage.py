import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from burstline.schemas import TRENDS
from burstline.sources import layout, object_store, results
from conftest import plan_of

START, END = datetime(2012, 2, 4, 9), datetime(2012, 2, 4, 10)


def trends(spark):
    rows = [(START, END, "winter, \"quoted\"", 10, 3.5, 1), (START, END, None, 4, 1.88, 2)]
    return spark.createDataFrame(rows, TRENDS)


@pytest.mark.parametrize("header", [False, True])
def test_results_round_trip(spark, tmp_path, header):
    path = str(tmp_path / "out")
    for _ in range(2):  # the second run overwrites the first
        results.write_trends(trends(spark).repartition(2), path, header)
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 2
    back = results.read_trends(spark, path, header)
    assert back.columns == ["timestamp_start", "timestamp_end", "topic", "count",
                            "burst_score", "rank"]
    assert sorted(map(tuple, back.collect()), key=lambda r: r[-1]) == [
        tuple(r) for r in trends(spark).collect()
    ]


def test_stored_text_form(spark, tmp_path):
    path = str(tmp_path / "out")
    results.write_trends(trends(spark).limit(1), path)
    line = spark.read.text(path).first()["value"]
    assert line.startswith("2012-02-04T09:00:00.000Z,2012-02-04T10:00:00.000Z,")


def posts(spark):
    rows = [(i, "en" if i % 3 else "nl", datetime(2024, 1, 1 + i % 40 // 10, i % 24))
            for i in range(200)]
    return spark.createDataFrame(rows, "post_id long, lang string, created_at timestamp_ntz")


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_partitions_are_pruned(spark, tmp_path, fmt):
    path = str(tmp_path / "posts")
    layout.write_partitioned(layout.with_date(posts(spark)), path, fmt=fmt)
    stored = spark.read.format(fmt).load(path)
    picked = stored.filter("dt = DATE '2024-01-02' AND lang = 'en'")
    assert picked.count() == posts(spark).filter("day(created_at) = 2 AND lang = 'en'").count()
    filters = [line for line in plan_of(picked).splitlines() if "PartitionFilters" in line][0]
    assert "dt" in filters and "lang" in filters
    assert stored.count() == 200


def test_archive_by_age(spark, tmp_path):
    undated = spark.createDataFrame([(900, "en", None)], posts(spark).schema)
    layout.archive(posts(spark).unionAll(undated), str(tmp_path / "tiers"), days=1)
    stored = spark.read.parquet(str(tmp_path / "tiers"))
    days = {(r["tier"], r["d"]) for r in stored.select("tier", F.day("dt").alias("d")).collect()}
    assert days == {("current", 3), ("current", 4), ("archive", 1), ("archive", 2), ("current", None)}
    assert stored.count() == 201


def test_catalog(spark):
    layout.register_view(posts(spark), "burstline_test_posts")
    assert spark.sql("SELECT count(*) AS n FROM burstline_test_posts").first()["n"] == 200
    layout.register_table(posts(spark), "burstline_test_table")
    assert spark.table("burstline_test_table").count() == 200


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = posts(spark).select("post_id", "lang")
    right = left.select("post_id", (F.col("post_id") * 2).alias("double"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, df in (("burstline_left", left), ("burstline_right", right)):
            layout.register_bucketed(df, name, ["post_id"], 4)
        joined = spark.table("burstline_left").join(spark.table("burstline_right"), "post_id")
        assert "Exchange" not in plan_of(joined)
        assert "Exchange" not in plan_of(joined.groupBy("post_id").count())
        assert joined.filter("double = 2 * post_id").count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_archive_advances_by_folders(spark, tmp_path):
    path = str(tmp_path / "tiers")
    undated = spark.createDataFrame([(900, "en", None)], posts(spark).schema)
    layout.archive(posts(spark).unionAll(undated), path, days=3)
    assert layout.stored_dates(spark, path, "archive") == []
    days = [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    kept = {f.name for f in (tmp_path / "tiers").rglob("*.parquet")}
    assert layout.advance_archive(spark, path, days=1) == days[:2]
    assert layout.advance_archive(spark, path, days=1) == []
    assert layout.stored_dates(spark, path, "archive") == days[:2]
    assert {f.name for f in (tmp_path / "tiers").rglob("*.parquet")} == kept  # nothing was written anew
    # a date that comes again joins what the archive has of it
    again = posts(spark).filter("day(created_at) = 1").withColumn("tier", F.lit("current"))
    layout.with_date(again).write.mode("append").partitionBy("tier", "dt").parquet(path)
    assert layout.advance_archive(spark, path, days=1) == days[:1]
    stored = spark.read.parquet(path)
    assert stored.count() == 201 + again.count()
    assert {r["d"] for r in stored.filter("tier = 'archive'").select(F.day("dt").alias("d")).collect()} == {1, 2}
    assert layout.advance_archive(spark, str(tmp_path / "none"), days=1) == []


def test_work_paths_are_new_and_under_the_given_folder(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    paths = {layout.work_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(p.startswith(base + "/x-") for p in paths)


def test_object_store_settings():
    settings = object_store.s3a_settings("http://store:9000", "key", "secret")
    assert all(name.startswith("spark.hadoop.fs.s3a.") for name in settings)
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert object_store.s3a_path("posts", "/in/a.json") == "s3a://posts/in/a.json"


def test_stored_archive_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "posts")
    layout.write_partitioned(layout.with_date(posts(spark)), path, by=("dt",))
    current, old = layout.split_by_age(spark.read.parquet(path), 1)
    assert old.count() == posts(spark).filter("day(created_at) <= 2").count()
    assert current.count() + old.count() == 200
    for part in (current, old):
        scan = [line for line in plan_of(part).splitlines() if "PartitionFilters" in line][0]
        assert "dt" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
