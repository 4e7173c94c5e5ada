"""Posts derived from the given tables, which hold none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.operators import terms, vocabulary
from burstline.sources import layout

#: Language and source of an event without a document.
NO_LANG, NO_SOURCE = "en", "none"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with the text, language and source of the document of their number.

    An event without one has an empty text. Both tables grow, so neither is
    broadcast.
    """
    events = table(spark, sf_dir, "events")
    documents = table(spark, sf_dir, "documents").hint("merge")
    return events.join(documents, events.event_id == documents.doc_id, "left").select(
        *[events[c] for c in ("event_id", "ts", "user_id", "event_type")],
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("lang", F.lit(NO_LANG)).alias("lang"),
        F.coalesce("source", F.lit(NO_SOURCE)).alias("source"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per event.

    The text is the whole document of the event's number, if any, wrapped so that
    it also holds a retweet mark, a mention, an entity, two hashtags and a link.
    """
    text = F.concat(
        F.lit("RT @u"), "user_id", F.lit(": "), "text", F.lit(" &amp; #"), "event_type",
        F.lit(" #"), "source", F.lit(" http://t.co/"), "event_id",
    )
    return documented(spark, sf_dir).select(
        F.col("event_id").alias("post_id"),
        text.alias("text"),
        "lang",
        F.col("ts").alias("created_at"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.with_cleaned_text(posts(spark, sf_dir))


def stored_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned posts in a work folder, for queries that read them several times."""
    kept = cleaned(spark, sf_dir).select("post_id", "created_at", "lang", "cleaned_text")
    return layout.stored(kept, "cleaned")


def tokens(
    spark: SparkSession, sf_dir: str, posts: DataFrame | None = None, **options
) -> DataFrame:
    """``post_id, created_at, lang, tokens`` of the posts, or of these cleaned ones."""
    return terms.topical_tokens(cleaned(spark, sf_dir) if posts is None else posts, **options)


def routed_words(
    spark: SparkSession, sf_dir: str, posts: DataFrame | None = None
) -> DataFrame:
    """``lang, tokens``: all words of the posts under their table language."""
    words = terms.with_words(cleaned(spark, sf_dir) if posts is None else posts)
    return words.select(
        vocabulary.route_language(F.col("lang")).alias("lang"),
        F.col("words").alias("tokens"),
    )


def suffix_lexicon(
    spark: SparkSession, sf_dir: str, posts: DataFrame | None = None
) -> DataFrame:
    """A lexicon of the posts' own words, tagged by their endings."""
    word = F.col("word")
    pos = (
        F.when(word.endswith("ly"), "ADV")
        .when(word.endswith("ing") | word.endswith("ed"), "VERB")
        .when(word.endswith("able") | word.endswith("eux"), "ADJ")
        .otherwise("NOUN")
    )
    words = routed_words(spark, sf_dir, posts).select(
        "lang", F.explode_outer("tokens").alias("word")
    )
    return (
        words.filter(word.isNotNull()).distinct()
        .select("lang", "word", pos.alias("pos"), F.lit(None).cast("int").alias("rank"))
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in use: sources, event types, and benchmark items.

    Each item is a name as a whole, and so is every four words of it.
    """
    labels = {"source": "ORG", "event_type": "GPE"}
    names = documented(spark, sf_dir).select("lang", "source", "event_type").distinct().unpivot(
        ["lang"], list(labels), "kind", "surface"
    )
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    items = table(spark, sf_dir, "benchmark")
    words = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    parts = items.select(words.alias("w")).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 4).cast("int")),
                lambda i: F.array_join(F.slice("w", 4 * i + 1, 4), " "),
            )
        ).alias("surface")
    )
    listed = items.select(F.col("text").alias("surface"), F.lit("PERSON").alias("label"))
    listed = listed.unionByName(parts.withColumn("label", F.lit("PERSON")))
    unlisted = items.select(F.substring("text", 1, 5).alias("surface"), F.lit("WORK").alias("label"))
    return names.select("lang", "surface", label[F.col("kind")].alias("label")).unionByName(
        listed.unionByName(unlisted).select(F.lit("en").alias("lang"), "surface", "label")
    )


def event_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms straight from the events: who did what, over the whole time span."""
    return _event_terms(table(spark, sf_dir, "events"))


def _event_terms(events: DataFrame) -> DataFrame:
    topic = F.concat("event_type", F.lit(":u"), "user_id")
    return events.select(F.col("ts").alias("created_at"), topic.alias("topic"))


def as_instant(ts: Column) -> Column:
    """A zoneless UTC time as an instant, whatever the session's time zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def as_utc(instant: Column) -> Column:
    """An instant as a zoneless UTC time."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz")
    )


def event_term_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event terms as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return _event_terms(events).withColumn("created_at", as_instant(F.col("created_at")))


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts in their nested raw form, some of them sparse.

    Errors have no time and views an unreadable one; purchases carry another
    UTC offset. Some sources lack text or language.
    """
    kind, source = F.col("event_type"), F.col("source")
    pattern = "EEE, dd MMM yyyy HH:mm:ss"
    shifted = F.col("ts") + F.expr("INTERVAL 2 HOURS")
    created_at = (
        F.when(kind == "error", None)
        .when(kind == "view", "n/a")
        .when(kind == "purchase", F.concat(F.date_format(shifted, pattern), F.lit(" +0200")))
        .otherwise(F.concat(F.date_format("ts", pattern), F.lit(" +0000")))
    )
    text = (
        F.when(source == "src1", None)
        .when(source == "src2", " \t\n ")
        .otherwise(F.concat("text", F.lit(" #"), "source"))
    )
    lang = (
        F.when(source == "src3", None).when(source == "src4", "unknown")
        .when(source == "src5", F.concat(F.lit(" "), F.upper("lang"))).otherwise(F.col("lang"))
    )
    return documented(spark, sf_dir).select(
        F.struct(text.alias("content")).alias("interaction"),
        F.struct(lang.alias("tag")).alias("language"),
        F.struct(
            F.col("event_id").cast("string").alias("id"), created_at.alias("created_at")
        ).alias("twitter"),
    )


def raw_json(spark: SparkSession, sf_dir: str) -> str:
    """The raw posts written as JSON lines to a new work folder; its path."""
    path = layout.work_path(spark, "raw-json")
    raw_posts(spark, sf_dir).write.json(path)
    return path
