import json
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from burstline.operators import bursts
from burstline.plans.trending import post_terms
from burstline.sources import posts as src
from burstline.streaming import compaction, ingest, metrics, trends as streams
from checks import inputs
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def arriving(spark, tmp_path):
    """A stream of terms from JSON files that tests write one by one."""
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, rows):
        lines = [json.dumps({"created_at": t.isoformat(), "topic": topic}) for t, topic in rows]
        (folder / f"{name}.json").write_text("\n".join(lines))

    stream = spark.readStream.schema("created_at timestamp, topic string").json(str(folder))
    return write, stream


def run(query):
    query.awaitTermination()
    return query


T0 = datetime(2024, 1, 1)


def hours(n):
    return timedelta(hours=n)


def test_windows_close_and_late_rows_drop(spark, tmp_path, arriving):
    write, stream = arriving
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def step():
        run(streams.start_append(streams.term_counts(stream), out, checkpoint, available_now=True))
        return {(r["time_window"]["start"], r["topic"]): r["count"]
                for r in spark.read.parquet(out).collect()}

    write("a", [(T0, "x"), (T0, "x"), (T0 + hours(1), "y"), (T0 + hours(3), "x")])
    assert step() == {(T0, "x"): 2}
    write("b", [(T0 + timedelta(minutes=5), "x"), (T0 + hours(1), "y"), (T0 + hours(6), "z")])
    assert step() == {(T0, "x"): 2, (T0 + hours(1), "y"): 2, (T0 + hours(3), "x"): 1}


def test_closed_windows_equal_batch(spark, tmp_path):
    stream = inputs.event_term_stream(spark, SF)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    run(streams.start_append(streams.term_counts(stream), out, checkpoint, available_now=True))
    closed = spark.read.parquet(out).select("time_window.start", "topic", "count")
    instants = inputs.event_terms(spark, SF).withColumn(
        "created_at", inputs.as_instant(F.col("created_at"))
    )
    batch = bursts.window_term_counts(instants, "hour")
    newest = instants.agg(F.max("created_at")).first()[0]
    expected = batch.filter(
        bursts.window_end(F.col("start_time"), "hour") <= F.lit(newest - hours(2))
    )
    assert not closed.isEmpty()
    assert closed.exceptAll(expected).isEmpty() and expected.exceptAll(closed).isEmpty()


def test_trending_over_batches_and_rerun(spark, tmp_path, arriving):
    write, stream = arriving
    streams.use_rocksdb(spark)
    paths = [str(tmp_path / name) for name in ("counts", "trends", "c")]
    write("a", [(T0, "x")] * 4 + [(T0, "y")] * 2 + [(T0 + hours(4), "x")])
    for name in ("b", None):
        run(streams.start_trending(streams.term_counts(stream), *paths, n=1, available_now=True))
        if name:
            write(name, [(T0 + hours(5), "y")] * 6 + [(T0 + hours(9), "x")])
    def stored():
        return {(r["start_time"], r["topic"]): (r["count"], r["burst_score"], r["rank"])
                for r in spark.read.parquet(paths[1]).collect()}

    # x: 4 and 1, mean 2.5; y: 2 and 6, mean 4; all on one date
    assert stored() == {(T0, "x"): (4, 1.6, 1), (T0 + hours(5), "y"): (6, 1.5, 1)}
    # a third batch closes one more window of the first date, which is ranked anew
    write("c", [(T0 + hours(50), "x")] * 5 + [(T0 + hours(75), "end")])
    run(streams.start_trending(streams.term_counts(stream), *paths, n=1, available_now=True))
    # x so far: 4, 1, 1 and 5
    third = {(T0, "x"): (4, 1.45, 1), (T0 + hours(5), "y"): (6, 1.5, 1),
             (T0 + hours(50), "x"): (5, 1.82, 1)}
    assert stored() == third
    # a fourth on later dates leaves the trends of the others as they are
    write("d", [(T0 + hours(100), "x")] * 9 + [(T0 + hours(200), "end")])
    run(streams.start_trending(streams.term_counts(stream), *paths, n=1, available_now=True))
    assert stored() == third | {(T0 + hours(100), "x"): (9, 2.25, 1)}
    closed = spark.createDataFrame(
        [(T0 + hours(4), "x", 1, 9, 3)], "start_time timestamp, topic string, count long, total long, windows long"
    )
    before = streams.read_closed(spark, paths[0]).count()
    streams.store_closed(closed, paths[0], 99)
    streams.store_closed(closed, paths[0], 99)  # a repeated micro-batch
    assert streams.read_closed(spark, paths[0]).count() == before + 1
    one = streams.read_closed(spark, paths[0], dates=[T0.date()])
    assert {r["start_time"] for r in one.collect()} == {T0 + hours(h) for h in (0, 4, 5, 9)}
    recent = streams.read_closed(spark, paths[0], since="2024-01-01 04:30:00")
    assert {r["start_time"] for r in recent.collect()} == {T0 + hours(h) for h in (5, 9, 50, 75, 100)}


def test_a_micro_batch_reads_and_writes_its_own_topics(spark, tmp_path, arriving):
    """Many restarts: totals go on, only the dates of a micro-batch are written again."""
    write, stream = arriving
    streams.use_rocksdb(spark)
    paths = [str(tmp_path / name) for name in ("counts", "trends", "c")]
    counts = defaultdict(int)
    for day in range(6):
        start = T0 + hours(24 * day)
        rows = [(start, "always")] * (day + 2) + [(start, f"day{day}")] * 3
        for t, topic in rows:
            counts[t, topic] += 1
        write(f"d{day}", rows)
        query = run(streams.start_trending(
            streams.term_counts(stream, "day"), *paths, interval="day", available_now=True
        ))
        state = [op for op in query.recentProgress[0]["stateOperators"] if "transformWithState" in op["operatorName"]]
        closing = [p for p in query.recentProgress if p["stateOperators"]]
        updated = sum(op["numRowsUpdated"] for p in closing for op in p["stateOperators"]
                      if "transformWithState" in op["operatorName"])
        assert state and updated <= 2 * (day > 0)
    trends = {(r["start_time"], r["topic"]): r["burst_score"] for r in spark.read.parquet(paths[1]).collect()}
    own = [day + 2 for day in range(4)]  # the watermark has not passed the fifth day
    assert trends == {
        **{(T0 + hours(24 * d), "always"): round(own[d] / (sum(own[: d + 1]) / (d + 1)) + 1e-9, 2) for d in range(4)},
        **{(T0 + hours(24 * d), f"day{d}"): 1.0 for d in range(4)},
    }


def test_redelivered_posts_count_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def deliver(name, ids):
        lines = [json.dumps({"interaction": {"content": f"post {i}"}, "twitter": {
            "id": str(i), "created_at": "Sat, 04 Feb 2012 09:38:03 +0000"}}) for i in ids]
        (folder / f"{name}.json").write_text("\n".join(lines))

    posts = src.prepare_posts(ingest.stream_posts(spark, str(folder)))
    once = ingest.drop_redelivered(posts)
    for name, ids in (("a", [1, 2, 2]), ("b", [2, 3]), ("c", [1, 3])):
        deliver(name, ids)
        run(streams.start_append(once, out, str(tmp_path / "c"), available_now=True))
    assert sorted(r["post_id"] for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_daily_averages(spark, tmp_path, arriving):
    write, stream = arriving
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    write("a", [(T0, "x")] * 3 + [(T0 + hours(5), "x")] + [(T0 + hours(40), "y")])
    daily = streams.daily_averages(streams.term_counts(stream))
    run(streams.start_append(daily, out, checkpoint, available_now=True))
    rows = [(r["topic"], r["avg_count"], r["n_hours"]) for r in spark.read.parquet(out).collect()]
    assert rows == [("x", 2.0, 2)]


def test_posts_stream_to_archive_and_terms(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    record = {"interaction": {"content": "storm at sea #storm"}, "language": {"tag": "en"},
              "twitter": {"id": "1", "created_at": "Sat, 04 Feb 2012 09:38:03 +0000"}}
    (folder / "p.json").write_text(json.dumps(record) + "\n{broken\n")
    posts = src.prepare_posts(ingest.stream_posts(spark, str(folder), 1))
    assert posts.isStreaming
    run(ingest.start_archive(posts, out, str(tmp_path / "c"), available_now=True))
    stored = spark.read.parquet(out)
    assert stored.filter("dt = DATE '2012-02-04' AND lang = 'en'").count() == stored.count() == 1
    found = str(tmp_path / "terms")
    run(streams.start_append(post_terms(posts), found, str(tmp_path / "c2"), available_now=True))
    topics = {r["topic"] for r in spark.read.parquet(found).collect()}
    assert topics == {"storm", "sea", "#storm", "storm sea", "sea storm", "storm #storm"}


def test_topics_expire_by_event_time(spark, tmp_path, arriving):
    write, stream = arriving
    streams.use_rocksdb(spark)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def step(name, rows):
        write(name, rows)
        scored = streams.running_burst(streams.term_counts(stream), expire_days=1)
        query = run(streams.start_append(scored, out, checkpoint, available_now=True))
        return [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]
                if "transformWithState" in op["operatorName"]]

    step("a", [(T0, "x")] * 2 + [(T0 + hours(20), "x")] * 4 + [(T0 + hours(23), "end")])
    step("b", [(T0 + hours(60), "x")] * 8 + [(T0 + hours(61), "x")] * 2 + [(T0 + hours(64), "end")])
    kept = step("c", [(T0 + hours(500), "y")])
    kept = step("d", [(T0 + hours(600), "y")])
    scores = {r["start_time"]: r["burst_score"] for r in spark.read.parquet(out).filter("topic = 'x'").collect()}
    # after forty hours without it the topic starts anew
    assert scores == {T0: 1.0, T0 + hours(20): 1.33, T0 + hours(60): 1.0, T0 + hours(61): 0.4}
    assert kept and kept[0] <= 4  # all but the last topic are forgotten


def test_metrics_of_each_micro_batch(spark, tmp_path, arriving):
    write, stream = arriving
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    listener = metrics.BatchMetrics()
    spark.streams.addListener(listener)
    found = []
    try:
        for name, rows in (("a", [(T0, "x"), (T0 + hours(5), "y")]), ("b", [(T0, "late"), (T0 + hours(9), "z")])):
            write(name, rows)
            counts = metrics.counted(streams.term_counts(metrics.counted(stream, "read")), "closed")
            query = run(streams.start_append(counts, out, checkpoint, available_now=True))
            assert listener.wait_for(query)
            got = listener.take(spark)
            assert got.columns == ["query", "batch", "metric", "value"]
            found.append({m: sum(r["value"] for r in got.collect() if r["metric"] == m)
                          for m in ("read", "closed", "late")})
    finally:
        spark.streams.removeListener(listener)
    assert found == [{"read": 2, "closed": 1, "late": 0}, {"read": 2, "closed": 1, "late": 1}]
    assert listener.take(spark).isEmpty()


def test_counts_of_all_terms_are_not_held_in_the_heap(spark, monkeypatch):
    names = [f"spark.sql.streaming.stateStore.{x}" for x in (
        "providerClass", "rocksdb.changelogCheckpointing.enabled", "rocksdb.trackTotalNumberOfRows")]
    before, started = {name: spark.conf.get(name, None) for name in names}, []
    start = streams.start_append
    monkeypatch.setattr(streams, "start_append", lambda *a, **b: started.append(start(*a, **b)) or started[-1])
    for name in names:
        spark.conf.unset(name)
    try:
        found = {r["metric"]: r["value"] for r in QUERIES["stream_metrics"](spark, SF).collect()}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    stores = [op["customMetrics"] for p in started[0].recentProgress for op in p["stateOperators"]]
    assert stores and all("rocksdbPutCount" in metrics for metrics in stores)
    assert set(found) == {"read", "dated", "terms", "closed", "late"} and found["closed"] > 0 == found["late"]


def test_archive_is_merged_beside_the_stream(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()

    def files():
        return len([f for f in out.rglob("*.parquet") if "_merging" not in str(f)])

    def deliver(n, days):
        for day in days:
            record = {"interaction": {"content": f"post {n}"}, "language": {"tag": "en" if n % 2 else None}, "twitter": {
                "id": f"{n}-{day}", "created_at": f"Sat, 0{day} Feb 2012 09:38:03 +0000"}}
            (folder / f"{n}-{day}.json").write_text(json.dumps(record))
        posts = src.prepare_posts(ingest.stream_posts(spark, str(folder)))
        run(ingest.start_archive(posts, str(out), str(tmp_path / "c"), available_now=True))

    def ids():
        return sorted(r["post_id"] for r in compaction.read_archive(spark, str(out)).collect())

    assert compaction.read_archive(spark, str(out)) is None
    for n in range(4):
        deliver(n, [4, 5] if n < 3 else [5])
    expected, before = ids(), files()
    assert len(expected) == 7 and before == 7
    assert compaction.merge_dates(spark, str(out), ["2012-02-04"], clean=False) == ["2012-02-04"]
    assert ids() == expected and files() == before + 2  # both versions are there, one is read
    assert compaction.merge_dates(spark, str(out)) == ["2012-02-05"]
    assert ids() == expected
    deliver(9, [5])
    assert len(ids()) == 8
    assert compaction.merge_dates(spark, str(out)) == ["2012-02-05"]
    assert compaction.merge_dates(spark, str(out)) == []
    assert len(ids()) == 8
    one = compaction.read_archive(spark, str(out), ["2012-02-05"])
    assert one.count() == 5 and {str(r["dt"]) for r in one.collect()} == {"2012-02-05"}
    assert len(list((out / "merged" / "dt=2012-02-05").rglob("*.parquet"))) == 2
