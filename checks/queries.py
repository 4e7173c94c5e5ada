"""One query per operator of the survey, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline import jobs
from burstline.functions import text as tx
from burstline.functions import tokens as tk
from burstline.functions.wordlists import DEFAULT_STOP_WORDS, STOP_WORDS_BY_LANGUAGE
from burstline.operators import bursts, entities as ent, terms, vocabulary, weights
from burstline.plans import etl, features, quality
from burstline.plans.trending import post_terms, trending
from burstline.sources import layout, posts as src, results
from burstline.streaming import compaction, ingest, metrics, trends as streams
from checks import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LANGUAGES = ("en", "de", "fr", "es")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(tokens: DataFrame, column: str = "tokens", sep: str = " ") -> DataFrame:
    """Posts' token lists as text, to compare them as values."""
    return tokens.select("post_id", F.array_join(column, sep).alias(column))


# ---------------------------------------------------------------- sources, sinks


@query
def scan_json(spark, sf):
    return src.project_posts(src.read_posts(spark, inputs.raw_json(spark, sf)))


@query
def project_posts(spark, sf):
    prepared = src.prepare_posts(inputs.raw_posts(spark, sf))
    return prepared.withColumn("created_at", inputs.as_utc(F.col("created_at")))


@query
def parse_created_at(spark, sf):
    raw = src.project_posts(inputs.raw_posts(spark, sf))
    parsed = inputs.as_utc(src.parse_created_at(F.col("created_at")))
    return raw.select("post_id", parsed.alias("created_at"))


def _dated(spark, sf):
    return inputs.table(spark, sf, "events").select(
        F.col("event_id").alias("post_id"), F.col("ts").alias("created_at")
    )


@query
def date_from(spark, sf):
    return src.date_from(_dated(spark, sf), "2024-01-02")


@query
def date_to(spark, sf):
    return src.date_to(_dated(spark, sf), "2024-01-02")


@query
def drop_undated(spark, sf):
    raw = src.project_posts(inputs.raw_posts(spark, sf))
    parsed = raw.select(
        "post_id", inputs.as_utc(src.parse_created_at(F.col("created_at"))).alias("created_at")
    )
    return src.drop_undated(parsed)


@query
def null_text_to_empty(spark, sf):
    raw = src.project_posts(inputs.raw_posts(spark, sf))
    return raw.select("post_id", tx.clean_or_empty(F.col("text")).alias("cleaned_text"))


def _instant_trends(spark, sf):
    posts = inputs.cleaned(spark, sf)
    return trending(posts.withColumn("created_at", inputs.as_instant(F.col("created_at"))))


@query
def write_trends_csv(spark, sf):
    path = layout.work_path(spark, "trends-csv")
    results.write_trends(_instant_trends(spark, sf), path, header=True)
    stored = results.read_trends(spark, path, header=True)
    for end in ("timestamp_start", "timestamp_end"):
        stored = stored.withColumn(end, inputs.as_utc(F.col(end)))
    return stored


@query
def read_trends_csv(spark, sf):
    path = layout.work_path(spark, "trends-csv")
    results.write_trends(_instant_trends(spark, sf), path)
    stored = results.read_trends(spark, path)
    for end in ("timestamp_start", "timestamp_end"):
        stored = stored.withColumn(end, inputs.as_utc(F.col(end)))
    return stored


@query
def etl_parquet(spark, sf):
    raw, path = inputs.raw_json(spark, sf), layout.work_path(spark, "etl")
    as_orc, as_parquet = (
        etl.etl_posts(spark, raw, f"{path}/{fmt}", fmt) for fmt in ("orc", "parquet")
    )
    stored = as_orc.withColumn("fmt", F.lit("orc")).unionByName(
        as_parquet.withColumn("fmt", F.lit("parquet"))
    )
    zoneless = inputs.as_utc(F.col("created_at"))
    return stored.select("fmt", "post_id", "lang", zoneless.alias("created_at"), "cleaned_text")


@query
def partitioned_posts(spark, sf):
    path = layout.work_path(spark, "posts-by-date")
    layout.write_partitioned(layout.with_date(inputs.cleaned(spark, sf)), path)
    stored = spark.read.parquet(path)
    return stored.filter((F.col("dt") >= "2024-01-02") & (F.col("lang") == "en")).select(
        "post_id", "dt", "lang", "cleaned_text"
    )


@query
def sql_over_trends(spark, sf):
    trends = trending(inputs.cleaned(spark, sf))
    saved = f"burstline_saved_{uuid.uuid4().hex}"
    layout.register_table(trends, saved)
    layout.register_view(spark.table(saved), "burstline_trends")
    return spark.sql(
        f"""
        SELECT v.topic, count(*) AS n_windows, sum(v.count) AS total_count,
               max(t.burst_score) AS best_score
        FROM burstline_trends v JOIN {saved} t
          ON v.topic = t.topic AND v.start_time = t.start_time
        GROUP BY v.topic
        """
    )


@query
def archive_split(spark, sf):
    path = layout.work_path(spark, "tiers")
    events = inputs.table(spark, sf, "events")
    layout.archive(events, path, days=7, ts="ts")
    return spark.read.parquet(path).select("tier", "dt", "event_id", "user_id")


@query
def archive_advance(spark, sf):
    # Stored with a later limit first, then the dates between the limits are moved.
    path = layout.work_path(spark, "tiers")
    layout.archive(inputs.table(spark, sf, "events"), path, days=14, ts="ts")
    layout.advance_archive(spark, path, days=7)
    return spark.read.parquet(path).select("tier", "dt", "event_id", "user_id")


@query
def bucketed_join(spark, sf):
    counts, names = _day_counts(spark, sf), []
    for table in (counts, bursts.topic_averages(counts)):
        names.append(f"burstline_buckets_{uuid.uuid4().hex}")
        layout.register_bucketed(table, names[-1], ["topic"], 8)
    joined = spark.sql(f"SELECT * FROM {names[0]} JOIN {names[1]} USING (topic)")
    return bursts.with_burst_score(joined)


# ------------------------------------------------------------------- text, per row


def _per_post(expression) -> Query:
    def run(spark, sf):
        posts = inputs.posts(spark, sf)
        return posts.select("post_id", expression(F.col("text")).alias("result"))

    return run


QUERIES.update(
    strip_entities=_per_post(tx.strip_entities),
    strip_urls_mentions=_per_post(tx.strip_urls_mentions),
    strip_punct=_per_post(tx.strip_punct),
    keep_alnum_hash=_per_post(tx.keep_alnum_hash),
    lower_strip=_per_post(tx.lower_strip),
    clean_text=_per_post(tx.clean),
    hashtags=_per_post(lambda text: F.array_join(tx.hashtags(text), "|")),
)


@query
def clean_pages(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return pages.select("page_id", tx.clean(F.col("html")).alias("cleaned_text"))


@query
def clean_conversations(spark, sf):
    turns = inputs.table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", tx.clean(F.col("text")).alias("cleaned_text"))


def _word_uses(spark, sf):
    words = inputs.routed_words(spark, sf).select(F.explode_outer("tokens").alias("word"))
    return words.filter(F.col("word").isNotNull()).groupBy("word").agg(
        F.count("*").alias("uses")
    )


@query
def noise_tokens(spark, sf):
    return _word_uses(spark, sf).withColumn("is_noise", tk.is_noise(F.col("word")))


@query
def burst_score(spark, sf):
    counts = bursts.window_term_counts(inputs.event_terms(spark, sf), "day")
    return bursts.with_burst_score(bursts.with_baseline(counts))


# ------------------------------------------------------------------ tokens, per post


@query
def tokenize(spark, sf):
    return joined(terms.with_words(inputs.cleaned(spark, sf)), "words")


@query
def stop_words(spark, sf):
    listed = vocabulary.stop_words(spark)
    # The stop-word lists are fixed and short, so they are the side to broadcast.
    found = _word_uses(spark, sf).join(F.broadcast(listed), "word")
    return listed.join(found, "word", "left").na.fill(0, ["uses"])


@query
def remove_stopwords(spark, sf):
    words = terms.with_words(inputs.cleaned(spark, sf))
    kept = tk.remove_stopwords(F.col("words"), DEFAULT_STOP_WORDS)
    return joined(words.select("post_id", kept.alias("tokens")))


@query
def drop_stop_and_noise(spark, sf):
    return joined(inputs.tokens(spark, sf, hashtag_bodies=True))


@query
def min_token_length(spark, sf):
    words = terms.with_words(inputs.cleaned(spark, sf))
    kept = F.filter("words", lambda w: F.length(w) > 1)
    return words.select("post_id", F.size("words").alias("n_words"), F.size(kept).alias("n_kept"))


@query
def lang_guard(spark, sf):
    posts = src.project_posts(inputs.raw_posts(spark, sf)).withColumn(
        "created_at", src.parse_created_at(F.col("created_at"))
    )
    guarded = terms.topical_tokens(terms.with_cleaned_text(posts))
    return guarded.select("post_id", "lang", F.size("tokens").alias("n_tokens"))


@query
def lang_route(spark, sf):
    posts = src.project_posts(inputs.raw_posts(spark, sf))
    routed = posts.select("lang", vocabulary.route_language(F.col("lang")).alias("route"))
    return routed.groupBy("lang", "route").agg(F.count("*").alias("n_posts"))


@query
def corpus_freq_rank(spark, sf):
    ranks = vocabulary.freq_rank(inputs.routed_words(spark, sf))
    return ranks.select("lang", "word", F.col("count").alias("uses"), "rank")


def _common(spark, sf, posts):
    return vocabulary.common_words(vocabulary.top_words(inputs.routed_words(spark, sf, posts)))


@query
def freq_filter(spark, sf):
    posts = inputs.stored_cleaned(spark, sf)
    common = _common(spark, sf, posts)
    return joined(inputs.tokens(spark, sf, posts, common=common, stop_words=()))


@query
def pos_filter(spark, sf):
    posts = inputs.stored_cleaned(spark, sf)
    lexicon = vocabulary.unique_lexicon(inputs.suffix_lexicon(spark, sf, posts))
    return joined(
        inputs.tokens(spark, sf, posts, lexicon=lexicon, min_freq_rank=0, stop_words=())
    )


@query
def topical_tokens(spark, sf):
    posts = inputs.stored_cleaned(spark, sf)
    lexicon = vocabulary.unique_lexicon(inputs.suffix_lexicon(spark, sf, posts))
    common = _common(spark, sf, posts)
    return joined(inputs.tokens(spark, sf, posts, lexicon=lexicon, common=common))


@query
def stopword_anti_join(spark, sf):
    listed = spark.createDataFrame(
        [(lang, w) for lang, words in STOP_WORDS_BY_LANGUAGE.items() for w in words],
        "lang string, word string",
    )
    words = terms.with_words(inputs.cleaned(spark, sf))
    tokens = words.select("post_id", "created_at", "lang", F.col("words").alias("tokens"))
    return joined(vocabulary.drop_words(tokens, listed))


@query
def combine_hashtags(spark, sf):
    words = terms.with_words(inputs.cleaned(spark, sf))
    combined = tk.combine_hashtags(F.col("words"), tx.hashtags(F.col("text")))
    return joined(words.select("post_id", combined.alias("tokens")))


@query
def token_multiplicity(spark, sf):
    return inputs.tokens(spark, sf).select(
        "post_id",
        F.size("tokens").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).alias("n_distinct"),
    )


@query
def nonempty_posts(spark, sf):
    posts = src.project_posts(inputs.raw_posts(spark, sf)).withColumn(
        "created_at", src.parse_created_at(F.col("created_at"))
    )
    kept = terms.nonempty(terms.topical_tokens(terms.with_cleaned_text(posts)))
    return kept.select("post_id", F.size("tokens").alias("n_tokens"))


def _grams(n: int) -> Query:
    def run(spark, sf):
        tokens = inputs.tokens(spark, sf)
        grams = tokens.select("post_id", tk.ngrams(F.col("tokens"), n).alias("grams"))
        return joined(grams, "grams", "|")

    return run


QUERIES.update(bigrams=_grams(2), trigrams=_grams(3))


def _term_uses(occurrences: DataFrame) -> DataFrame:
    return occurrences.groupBy("topic").agg(F.count("*").alias("uses"))


@query
def explode_terms(spark, sf):
    return _term_uses(terms.explode_terms(inputs.tokens(spark, sf)))


@query
def union_terms(spark, sf):
    return _term_uses(terms.union_terms(inputs.tokens(spark, sf)))


@query
def drop_blank_topics(spark, sf):
    posts = inputs.cleaned(spark, sf)
    pieces = posts.select(F.explode_outer(F.split("cleaned_text", " ")).alias("topic"))
    return _term_uses(terms.drop_blank_topics(pieces))


@query
def entities(spark, sf):
    return ent.entities(
        inputs.posts(spark, sf), inputs.gazetteer(spark, sf), languages=LANGUAGES
    )


# ---------------------------------------------------------------------- counts, trends


@query
def window_term_counts(spark, sf):
    counts = bursts.window_term_counts(inputs.event_terms(spark, sf), "hour")
    return counts.withColumn("end_time", bursts.window_end(F.col("start_time"), "hour"))


def _day_counts(spark, sf):
    return bursts.window_term_counts(inputs.event_terms(spark, sf), "day")


@query
def topic_avg(spark, sf):
    return bursts.topic_averages(_day_counts(spark, sf))


@query
def topic_avg_all_windows(spark, sf):
    return bursts.topic_averages(_day_counts(spark, sf), baseline="all")


@query
def burst_join(spark, sf):
    return bursts.with_burst_score(
        bursts.with_baseline(_day_counts(spark, sf), strategy="join")
    )


@query
def min_count_floor(spark, sf):
    scored = bursts.with_burst_score(bursts.with_baseline(_day_counts(spark, sf)))
    return bursts.min_count_floor(scored, 4)


@query
def rank_in_window(spark, sf):
    scored = bursts.with_burst_score(bursts.with_baseline(_day_counts(spark, sf)))
    return bursts.rank_in_window(scored)


@query
def topn_filter(spark, sf):
    scored = bursts.with_burst_score(bursts.with_baseline(_day_counts(spark, sf)))
    return bursts.top_n(bursts.min_count_floor(scored), 1)


@query
def topn_per_window(spark, sf):
    scored = bursts.with_burst_score(bursts.with_baseline(_day_counts(spark, sf), "all"))
    return bursts.top_n(bursts.min_count_floor(scored), 3)


@query
def flatten_window(spark, sf):
    return bursts.trends_from_counts(_day_counts(spark, sf), interval="day")


def _trends(**options) -> Query:
    def run(spark, sf):
        return trending(inputs.cleaned(spark, sf), **options)

    return run


QUERIES.update(
    trending_topics=_trends(),
    trends_hour=_trends(interval="hour", n=10, baseline="all"),
    trends_day=_trends(interval="day"),
    trends_week=_trends(interval="week", min_count=1),
)


@query
def trends_preview(spark, sf):
    return bursts.preview(trending(inputs.cleaned(spark, sf)))


@query
def trends_limit(spark, sf):
    trends = bursts.trends_from_counts(_day_counts(spark, sf), n=50, interval="day")
    return bursts.preview(trends)


@query
def topic_weights(spark, sf):
    return bursts.topic_weights(trending(inputs.cleaned(spark, sf)))


@query
def tfidf(spark, sf):
    weighted = weights.tfidf(inputs.tokens(spark, sf))
    return weighted.withColumn("weight", F.round("weight", 6))


# ------------------------------------------------------------ quality, features, metrics


@query
def dq_report(spark, sf):
    return quality.dq_report(src.project_posts(inputs.raw_posts(spark, sf)), LANGUAGES)


@query
def normalise_columns(spark, sf):
    tidy = quality.normalise_columns(src.project_posts(inputs.raw_posts(spark, sf)))
    return tidy.withColumn("created_at", inputs.as_utc(F.col("created_at")))


@query
def dq_quarantine(spark, sf):
    path = layout.work_path(spark, "quarantine")
    projected = src.project_posts(inputs.raw_posts(spark, sf))
    etl.store_quarantined(projected, path, LANGUAGES)
    return spark.read.parquet(path).select("post_id", "verdict")


@query
def stage_counts(spark, sf):
    raw = inputs.raw_posts(spark, sf)
    return quality.stage_counts(src.project_posts(raw), trending(src.prepare_posts(raw)))


@query
def trend_features(spark, sf):
    return features.trend_features(_day_counts(spark, sf))


@query
def trend_labels(spark, sf):
    return features.labelled_features(_day_counts(spark, sf), interval="day")


@query
def trend_classifier(spark, sf):
    # Training reads its input many times, so it is stored once.
    path = layout.work_path(spark, "labelled-features")
    features.labelled_features(
        _day_counts(spark, sf), interval="day", causal=True
    ).write.parquet(path)
    labelled = spark.read.parquet(path)
    return features.classify(features.train_classifier(labelled), labelled)


@query
def trend_given_weights(spark, sf):
    found = features.trend_features(_day_counts(spark, sf))
    scored = features.score_with(found, {"delta": 0.5, "burst_ratio": 1.25}, -2.0)
    return scored.withColumn("probability", F.round("probability", 9))


def _fitted(labelled):
    """Scores of all windows by a fit to those before the middle one."""
    before = labelled.filter(F.col("start_time") < features.middle_window(labelled))
    return features.fitted_scores(before, labelled).withColumn("score", F.round("score", 6))


@query
def trend_least_squares(spark, sf):
    return _fitted(features.labelled_features(_day_counts(spark, sf), interval="day"))


@query
def trend_features_causal(spark, sf):
    return features.trend_features(_day_counts(spark, sf), causal=True)


@query
def trend_evaluation(spark, sf):
    # Earlier windows teach, later ones are judged, by features of their past alone.
    labelled = features.labelled_features(_day_counts(spark, sf), interval="day", causal=True)
    later = labelled.filter(F.col("start_time") >= features.middle_window(labelled))
    scored = _fitted(labelled).join(later.select("start_time", "topic"), ["start_time", "topic"])
    return features.hits_in_top(scored, later, 100)


@query
def job_trending(spark, sf):
    stored = jobs.run_trending(
        inputs.raw_json(spark, sf), layout.work_path(spark, "job-trends"), spark=spark
    )
    return _utc(stored, "timestamp_start", "timestamp_end")


@query
def post_scores(spark, sf):
    posts = inputs.stored_cleaned(spark, sf)
    return bursts.post_scores(post_terms(posts, with_id=True))


# ------------------------------------------------------------------------- streaming


def _stored(spark, name: str, start: Callable[[str, str], object]) -> DataFrame:
    """Run a streaming query over what is there; read what it stored."""
    path = layout.work_path(spark, name)
    start(f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def _appended(spark, name: str, stream: DataFrame) -> DataFrame:
    return _stored(
        spark, name, lambda p, c: streams.start_append(stream, p, c, available_now=True)
    )


def _utc(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.withColumn(name, inputs.as_utc(F.col(name)))
    return df


@query
def stream_scan(spark, sf):
    raw = ingest.stream_posts(spark, inputs.raw_json(spark, sf), max_files_per_trigger=100)
    return _utc(_appended(spark, "stream-scan", src.prepare_posts(raw)), "created_at")


@query
def stream_term_counts(spark, sf):
    counts = streams.term_counts(inputs.event_term_stream(spark, sf))
    stored = _appended(spark, "stream-counts", counts)
    flat = stored.select(
        F.col("time_window.start").alias("start_time"),
        F.col("time_window.end").alias("end_time"),
        "topic",
        "count",
    )
    return _utc(flat, "start_time", "end_time")


@query
def stream_trending(spark, sf):
    streams.use_rocksdb(spark)
    counts = streams.term_counts(inputs.event_term_stream(spark, sf), "day")
    path = layout.work_path(spark, "stream-trending")
    streams.start_trending(
        counts, f"{path}/counts", f"{path}/trends", f"{path}/checkpoint", interval="day",
        available_now=True,
    ).awaitTermination()
    trends = spark.read.parquet(f"{path}/trends").drop("date")
    return _utc(trends, "start_time", "end_time")


@query
def stream_running_burst(spark, sf):
    streams.use_rocksdb(spark)
    counts = streams.term_counts(inputs.event_term_stream(spark, sf), "day")
    return _utc(
        _appended(spark, "stream-burst", streams.running_burst(counts)), "start_time"
    )


@query
def stream_burst_expiring(spark, sf):
    streams.use_rocksdb(spark)
    counts = streams.term_counts(inputs.event_term_stream(spark, sf), "day")
    scored = streams.running_burst(counts, expire_days=3)
    return _utc(_appended(spark, "stream-expiring", scored), "start_time")


@query
def stream_daily_avg(spark, sf):
    hourly = streams.term_counts(inputs.event_term_stream(spark, sf))
    stored = _appended(spark, "stream-daily", streams.daily_averages(hourly))
    flat = stored.select(
        F.col("day.start").alias("day_start"), "topic", "avg_count", "n_hours"
    )
    return _utc(flat, "day_start")


@query
def stream_dedup(spark, sf):
    # Every post is delivered twice.
    path = layout.work_path(spark, "redelivered")
    for part in ("first", "again"):
        inputs.raw_posts(spark, sf).write.json(f"{path}/{part}")
    posts = src.prepare_posts(ingest.stream_posts(spark, f"{path}/*"))
    once = _appended(spark, "stream-dedup", ingest.drop_redelivered(posts))
    return _utc(once, "created_at")


@query
def stream_archive(spark, sf):
    posts = src.prepare_posts(ingest.stream_posts(spark, inputs.raw_json(spark, sf)))
    zoned = posts.withColumn("created_at", inputs.as_utc(F.col("created_at")))
    stored = _stored(
        spark, "stream-archive",
        lambda p, c: ingest.start_archive(zoned, p, c, available_now=True),
    )
    return stored.select("post_id", "dt", "lang", "created_at", "cleaned_text")


@query
def stream_metrics(spark, sf):
    # Every term of every open window is a key of the state, too many for the heap.
    streams.use_rocksdb(spark, many_keys=True)
    raw = metrics.counted(ingest.stream_posts(spark, inputs.raw_json(spark, sf)), "read")
    dated = metrics.counted(src.prepare_posts(raw), "dated")
    found = metrics.counted(post_terms(dated), "terms")
    counts = metrics.counted(streams.term_counts(found), "closed")
    path, listener = layout.work_path(spark, "stream-metrics"), metrics.BatchMetrics()
    spark.streams.addListener(listener)
    try:
        started = streams.start_append(counts, f"{path}/rows", f"{path}/checkpoint", available_now=True)
        started.awaitTermination()
        listener.wait_for(started)
    finally:
        spark.streams.removeListener(listener)
    return listener.take(spark).groupBy("metric").agg(F.sum("value").alias("value"))


@query
def stream_archive_merged(spark, sf):
    # Two deliveries, each a micro-batch; merged in between and after.
    path = layout.work_path(spark, "stream-merged")
    raw = inputs.raw_posts(spark, sf)
    even = F.col("twitter.id").cast("long") % 2 == 0
    for number, part in enumerate((raw.filter(even), raw.filter(~even))):
        part.write.json(f"{path}/in/{number}")
        posts = src.prepare_posts(ingest.stream_posts(spark, f"{path}/in/*"))
        zoned = posts.withColumn("created_at", inputs.as_utc(F.col("created_at")))
        ingest.start_archive(
            zoned, f"{path}/rows", f"{path}/checkpoint", available_now=True
        ).awaitTermination()
        compaction.merge_dates(spark, f"{path}/rows", least=1 + number)
    stored = compaction.read_archive(spark, f"{path}/rows")
    return stored.select("post_id", "dt", "lang", "created_at", "cleaned_text")
