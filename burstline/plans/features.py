"""Trend features per (window, topic) and a linear trend classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstline.operators import bursts
from burstline.operators.joins import left_join_split_hot
from burstline.operators.ranking import first_places

FEATURES = ("count", "previous_count", "delta", "burst_ratio", "window_share")


def trend_features(counts: DataFrame, causal: bool = False) -> DataFrame:
    """Add the features of every (window, topic) count.

    ``previous_count`` is the topic's count in the last window it occurred in,
    zero at first; ``burst_ratio`` its count over its mean; ``window_share`` its
    share of all occurrences in the window. The mean covers all windows of the topic
    or, if ``causal``, those up to this one: a model of what comes next must not know
    later windows. A topic has one row per window, so
    the windows over topics stay small. A time window can hold any number of
    topics, so its total is aggregated and joined, not computed over a frame.
    """
    by_topic = Window.partitionBy("topic")
    in_time = by_topic.orderBy("start_time")
    mean_over = in_time.rowsBetween(Window.unboundedPreceding, 0) if causal else by_topic
    per_topic = counts.select(
        "start_time",
        "topic",
        "count",
        F.lag("count", 1, 0).over(in_time).alias("previous_count"),
        (F.col("count") / F.avg("count").over(mean_over)).alias("burst_ratio"),
    )
    totals = counts.groupBy("start_time").agg(
        F.sum("count").alias("window_total"), F.count("*").alias("n_topics")
    )
    joined = left_join_split_hot(per_topic, totals, ["start_time"], totals, "n_topics")
    return joined.select(
        "start_time",
        "topic",
        "count",
        "previous_count",
        (F.col("count") - F.col("previous_count")).alias("delta"),
        "burst_ratio",
        (F.col("count") / F.col("window_total")).alias("window_share"),
    )


def labelled_features(
    counts: DataFrame, n: int = 5, interval: str = "hour", min_count: int = 2,
    causal: bool = False,
) -> DataFrame:
    """Features with ``label`` 1.0 if the topic is in the next window's top ``n``."""
    trends = bursts.trends_from_counts(counts, n, interval, min_count)
    before = F.make_dt_interval(secs=F.lit(bursts.interval_seconds(interval)))
    next_up = trends.select(
        (F.col("start_time") - before).alias("start_time"),
        "topic",
        F.lit(1.0).alias("label"),
    )
    return (
        trend_features(counts, causal)
        .join(next_up, ["start_time", "topic"], "left")
        .na.fill(0.0, ["label"])
    )


def middle_window(labelled: DataFrame) -> Column:
    """Start of the middle one of the data's windows, which splits them into two halves.

    Windows are as many as the time span has, whatever the number of posts.
    """
    starts = F.sort_array(F.collect_set("start_time"))
    middle = F.get(starts, F.floor(F.size(starts) / 2).cast("int"))
    return labelled.agg(middle.alias("cut")).scalar()


def hits_in_top(scored: DataFrame, labelled: DataFrame, n: int = 5) -> DataFrame:
    """How well scores find the next trends: ``start_time, trends, hits`` per window.

    ``trends`` counts the window's topics with label 1, ``hits`` those of them among the ``n`` highest
    scores; ties go to the smaller topic.
    """
    order = (F.desc("score"), F.asc("topic"))
    first = first_places(scored, ["start_time"], order, n).select("start_time", "topic", F.lit(1).alias("first"))
    judged = labelled.select("start_time", "topic", "label").join(first, ["start_time", "topic"], "left")
    right = F.col("label") > 0
    return judged.groupBy("start_time").agg(
        F.count_if(right).alias("trends"), F.count_if(right & F.col("first").isNotNull()).alias("hits")
    )


def train_classifier(
    labelled: DataFrame, max_iter: int = 20, reg_param: float = 0.01
) -> PipelineModel:
    """Fit a scaled logistic regression on labelled features.

    Fitting reads its input several times: pass a stored table.
    """
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
            LogisticRegression(maxIter=max_iter, regParam=reg_param),
        ]
    ).fit(labelled)


def classify(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``start_time, topic, probability, prediction`` for each feature row.

    The model is linear, so it is applied as a Column expression of its few
    numbers. A fitted model that is shipped to tasks takes its training summary
    along, which cannot be serialised once the session has used an Observation.
    """
    _, scaler, regression = model.stages
    margin = F.lit(regression.intercept)
    for name, mean, std, weight in zip(
        FEATURES, scaler.mean, scaler.std, regression.coefficients
    ):
        if std > 0:
            margin += (F.col(name) - float(mean)) / float(std) * float(weight)
    probability = 1 / (1 + F.exp(-margin))
    return features.select(
        "start_time",
        "topic",
        probability.alias("probability"),
        (probability > 0.5).cast("int").alias("prediction"),
    )


def score_with(features: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """``start_time, topic, probability, prediction`` under given weights."""
    margin = F.lit(float(bias))
    for name, weight in weights.items():
        margin += F.col(name) * float(weight)
    probability = 1 / (1 + F.exp(-margin))
    return features.select(
        "start_time", "topic", probability.alias("probability"),
        (probability > 0.5).cast("int").alias("prediction"),
    )


def least_squares(
    labelled: DataFrame, inputs: tuple[str, str] = ("burst_ratio", "previous_count")
) -> DataFrame:
    """Linear fit of ``label`` by two features: one row ``bias, w1, w2``.

    One aggregation gives the sums of products; the solution is written as
    determinants. Without a unique solution the weights are null.
    """
    x, y, z = (F.col(c).cast("double") for c in (*inputs, "label"))
    sums = labelled.agg(
        F.count("*").cast("double").alias("n"), F.sum(x).alias("x"), F.sum(y).alias("y"),
        F.sum(z).alias("z"), F.sum(x * x).alias("xx"), F.sum(x * y).alias("xy"),
        F.sum(y * y).alias("yy"), F.sum(x * z).alias("xz"), F.sum(y * z).alias("yz"),
    )
    # central moments: the bias drops out of a system of two equations
    centred = sums.select(
        "*",
        *[
            (F.col(a + b) - F.col(a) * F.col(b) / F.col("n")).alias(f"s{a}{b}")
            for a, b in ("xx", "xy", "yy", "xz", "yz")
        ],
    )
    c = F.col
    determinant = c("sxx") * c("syy") - c("sxy") * c("sxy")
    solved = centred.select(
        "n", "x", "y", "z",
        F.try_divide(c("sxz") * c("syy") - c("syz") * c("sxy"), determinant).alias("w1"),
        F.try_divide(c("syz") * c("sxx") - c("sxz") * c("sxy"), determinant).alias("w2"),
    )
    bias = (c("z") - c("w1") * c("x") - c("w2") * c("y")) / c("n")
    return solved.select(bias.alias("bias"), "w1", "w2")


def fitted_scores(
    train: DataFrame, features: DataFrame,
    inputs: tuple[str, str] = ("burst_ratio", "previous_count"),
) -> DataFrame:
    """``start_time, topic, score``: the fit to ``train`` applied to other rows.

    The fit is one row and is broadcast.
    """
    weights = F.broadcast(least_squares(train, inputs))
    score = F.col("bias") + F.col("w1") * F.col(inputs[0]) + F.col("w2") * F.col(inputs[1])
    return features.join(weights).select("start_time", "topic", score.alias("score"))
