import math

import pytest
from pyspark.sql import functions as F

from burstline.operators.weights import tfidf


def test_against_brute_force(spark):
    documents = [["sun"] * 3 + ["sea"], ["sun", "rain"], ["sun"], []] + [
        ["sun", f"w{i % 7}", f"w{i % 7}", f"x{i}"] for i in range(60)
    ]
    df = spark.createDataFrame(list(enumerate(documents)), "post_id long, tokens array<string>")
    got = {(r["post_id"], r["term"]): (r["tf"], r["df"], r["weight"]) for r in tfidf(df).collect()}
    n = len(documents)
    expected = {}
    for i, words in enumerate(documents):
        for word in set(words):
            count = sum(word in d for d in documents)
            expected[i, word] = (words.count(word), count,
                                 words.count(word) * math.log((n + 1) / (count + 1)))
    assert got.keys() == expected.keys()
    for key, (tf, df_, weight) in expected.items():
        assert got[key][:2] == (tf, df_) and got[key][2] == pytest.approx(weight)


def test_empty(spark):
    assert tfidf(spark.createDataFrame([], "post_id long, tokens array<string>")).isEmpty()


def test_tasks_grow_with_the_words(spark):
    """No task joins much more than its share, whatever the session's partitions."""
    rows = [(i, [f"w{i}", f"w{i + 1}", f"w{i + 2}", "sun"]) for i in range(2000)]
    df = spark.createDataFrame(rows + [(None, ["sea"]), (None, ["sea"]), (7, None)], "post_id long, tokens array<string>")
    got = tfidf(df, words_per_task=100)
    task = F.spark_partition_id().alias("task")
    per_task = [r["count"] for r in got.select("*", task).groupBy("task").count().collect()]
    assert sum(per_task) == 8001 and max(per_task) < 8001 / 8 / 4
    null = got.filter("post_id is null").collect()
    assert [(r["term"], r["tf"], r["df"]) for r in null] == [("sea", 2, 1)]
    assert got.first()["weight"] is not None
