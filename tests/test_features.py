from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from burstline.plans import features

DAY = datetime(2024, 1, 1)


def counts(spark):
    rows = []
    for day in range(12):
        for topic in range(40):
            rows.append((DAY + timedelta(days=day), f"t{topic}", 1 + (topic * 7 + day * 5) % 11))
    return spark.createDataFrame(rows, "start_time timestamp_ntz, topic string, count long")


def test_features(spark):
    rows = [(DAY, "a", 2), (DAY, "b", 6), (DAY + timedelta(days=1), "a", 4)]
    df = spark.createDataFrame(rows, "start_time timestamp_ntz, topic string, count long")
    got = {(r["start_time"].day, r["topic"]): tuple(r)[2:]
           for r in features.trend_features(df).collect()}
    assert got[1, "a"] == (2, 0, 2, pytest.approx(2 / 3), 0.25)
    assert got[1, "b"] == (6, 0, 6, 1.0, 0.75)
    assert got[2, "a"] == (4, 2, 2, pytest.approx(4 / 3), 1.0)


def test_label_is_the_next_windows_trend(spark):
    labelled = features.labelled_features(counts(spark), n=3, interval="day")
    by_day = {r["start_time"].day: r["sum(label)"]
              for r in labelled.groupBy("start_time").sum("label").collect()}
    assert by_day == {**{day: 3.0 for day in range(1, 12)}, 12: 0.0}


def test_least_squares(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(2, 200))
    rows = [(float(a), float(b), float(2 + 3 * a - b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "burst_ratio double, previous_count double, label double")
    fit = features.least_squares(df).first()
    assert (fit["bias"], fit["w1"], fit["w2"]) == pytest.approx((2, 3, -1))
    one = features.least_squares(df.limit(1)).first()
    assert one["w1"] is None and one["w2"] is None


def test_classifier(spark, tmp_path):
    labelled = features.labelled_features(counts(spark), n=3, interval="day")
    model = features.train_classifier(labelled)
    scored = features.classify(model, labelled)
    assert scored.columns == ["start_time", "topic", "probability", "prediction"]
    assert scored.count() == 480
    assert scored.filter("probability < 0 OR probability > 1").isEmpty()
    path = str(tmp_path / "model")
    model.save(path)
    stored = PipelineModel.load(path).transform(labelled)
    theirs = {
        (r["start_time"], r["topic"]): (r["probability"][1], int(r["prediction"]))
        for r in stored.collect()
    }
    for row in scored.collect():
        probability, prediction = theirs[row["start_time"], row["topic"]]
        assert row["probability"] == pytest.approx(probability)
        assert row["prediction"] == prediction


def test_classifier_after_an_observation(spark):
    observation = Observation("rows")
    spark.range(3).observe(observation, F.count("*").alias("n")).collect()
    assert observation.get == {"n": 3}
    labelled = features.labelled_features(counts(spark), n=3, interval="day")
    scored = features.classify(features.train_classifier(labelled), labelled)
    assert scored.count() == 480 and len(scored.collect()) == 480


def test_causal_features_do_not_know_later_windows(spark):
    whole = counts(spark)
    early = whole.filter(F.col("start_time") < DAY + timedelta(days=6))
    seen = {tuple(r) for r in features.trend_features(early, causal=True).collect()}
    later = features.trend_features(whole, causal=True).filter(F.col("start_time") < DAY + timedelta(days=6))
    assert {tuple(r) for r in later.collect()} == seen
    assert {r["burst_ratio"] for r in features.trend_features(whole, causal=True)
            .filter(F.col("start_time") == DAY).collect()} == {1.0}


def test_middle_window_and_hits(spark):
    whole = counts(spark)
    cut = whole.select(features.middle_window(whole).alias("cut")).first()["cut"]
    assert cut == DAY + timedelta(days=6)
    rows = [(DAY, "a", 1.0, 0.5), (DAY, "b", 0.0, 0.5), (DAY, "c", 1.0, 0.4), (DAY, "d", 1.0, None)]
    df = spark.createDataFrame(rows, "start_time timestamp_ntz, topic string, label double, score double")
    scored = df.select("start_time", "topic", "score")
    for n, hits in ((1, 1), (2, 1), (3, 2), (9, 3)):
        assert [tuple(r) for r in features.hits_in_top(scored, df, n).collect()] == [(DAY, 3, hits)]
