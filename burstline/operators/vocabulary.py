"""Tables of words: stop words, frequency ranks, lexicons, and their use as filters.

Part-of-speech and word-rank information comes from a lexicon table that the
caller supplies, ``(lang, word, pos, rank)`` with one row per (lang, word). This
approximates a statistical tagger: a word has one tag whatever its sentence, and
a word the lexicon does not hold counts as topical.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstline.functions.wordlists import STOP_WORDS_BY_LANGUAGE
from burstline.operators.joins import left_join_split_hot, member
from burstline.operators.ranking import complete_rank, first_places
from burstline.sources.layout import stored

TOPICAL_POS = ("NOUN", "PROPN")
DEFAULT_MIN_FREQ_RANK = 700
#: Words of a table that are looked up in place; they travel in the plan, a few bytes each.
LITERAL_WORDS = 50_000
ROUTES = {"en": "en"}
DEFAULT_ROUTE = "nl"


def route_language(
    lang: Column, routes: Mapping[str, str] = ROUTES, default: str = DEFAULT_ROUTE
) -> Column:
    """The language whose tables serve a post: English for ``en``, else Dutch.

    Null goes to the default. ``routes`` maps further tags to table languages.
    """
    routed = F.lit(default)
    for tag, table in routes.items():
        routed = F.when(lang == tag, table).otherwise(routed)
    return routed


def stop_words(
    spark: SparkSession, by_language: Mapping[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """The set union of the languages' stop words, one row per word."""
    lists = by_language or STOP_WORDS_BY_LANGUAGE
    tables = [
        spark.createDataFrame([(w,) for w in entries], "word string")
        for entries in lists.values()
    ]
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.union(table)
    return merged.distinct()


def word_counts(tokens: DataFrame, lang: str = "lang") -> DataFrame:
    """``lang, word, count`` of a table with a language and an array column ``tokens``."""
    words = tokens.select(F.col(lang).alias("lang"), F.explode_outer("tokens").alias("word"))
    return words.filter(F.col("word").isNotNull()).groupBy("lang", "word").count()


def _rank_order() -> tuple[Column, ...]:
    return F.desc("count"), F.asc("word")


def freq_rank(tokens: DataFrame, lang: str = "lang") -> DataFrame:
    """Rank all words by corpus frequency within each language, commonest = 0.

    Words of equal frequency are ranked by code point. Ranges of the whole sort key
    are ranked, so neither a language nor the words of one use are one task's.
    """
    ranked = complete_rank(word_counts(tokens, lang), ["lang"], _rank_order())
    return ranked.select("lang", "word", "count", (F.col("rank") - 1).alias("rank"))


def top_words(
    tokens: DataFrame, most: int = DEFAULT_MIN_FREQ_RANK, lang: str = "lang"
) -> DataFrame:
    """The rows of ``freq_rank`` with a rank below ``most``, without ranking the rest."""
    ranked = first_places(word_counts(tokens, lang), ["lang"], _rank_order(), most)
    return ranked.select("lang", "word", "count", (F.col("rank") - 1).cast("long").alias("rank"))


def common_words(
    ranks: DataFrame, min_freq_rank: int = DEFAULT_MIN_FREQ_RANK
) -> DataFrame:
    """One row per language with the array of words too common to be topics.

    Dropped are ranks 1 to ``min_freq_rank - 1``; rank 0 and null are kept as
    unknown, and ``min_freq_rank=0`` drops nothing. This threshold alone bounds
    the arrays. ``ranks`` may be all of ``freq_rank`` or the ``top_words``.
    """
    too_common = ranks.filter(F.col("rank").between(1, min_freq_rank - 1))
    return too_common.groupBy("lang").agg(F.collect_set("word").alias("common"))


def drop_common(
    tokens: DataFrame,
    common: DataFrame,
    routes: Mapping[str, str] = ROUTES,
    default: str = DEFAULT_ROUTE,
    literal_words: int = LITERAL_WORDS,
) -> DataFrame:
    """Remove each language's common words from the ``tokens`` arrays.

    ``common`` holds one row per language with an array of its words (see
    ``common_words``). Those of the languages named in ``routes`` are looked up in
    place, as sets in the expression, if there are up to ``literal_words`` of
    them. More are broadcast as arrays; the ``min_freq_rank`` that they come from bounds
    their number, which does not depend on the corpus.
    """
    tables = sorted({*routes.values(), default})
    listed = common.filter(F.col("lang").isin(tables)).select(
        F.col("lang").alias("_route"), "common"
    )
    routed = tokens.withColumn("_route", route_language(F.col("lang"), routes, default))
    few = listed.select("_route", F.explode("common").alias("_word")).distinct()
    few = few.limit(literal_words + 1).collect()
    if len(few) <= literal_words:
        return _drop_in_place(routed, few, tokens.columns)
    # The hits are used twice so that Catalyst computes them once per post and
    # not once per token.
    hits = F.array_intersect("tokens", "common")
    left = F.filter("tokens", lambda w: ~F.array_contains("_hits", w))
    untouched = F.coalesce(F.size("_hits"), F.lit(0)) <= 0
    return (
        routed.join(F.broadcast(listed), "_route", "left")
        .withColumn("_hits", hits)
        .withColumn("tokens", F.when(untouched, F.col("tokens")).otherwise(left))
        .select(*tokens.columns)
    )


def _drop_in_place(routed: DataFrame, few: Iterable, columns: Sequence[str]) -> DataFrame:
    """Remove the ``(route, word)`` pairs ``few`` from the ``tokens`` of their ``_route``."""
    listed: dict[str, list[str]] = {}
    for route, word in few:
        listed.setdefault(route, []).append(word)
    left = F.col("tokens")
    for route, words in listed.items():
        among = ", ".join(map(_literal, words))
        kept = F.expr(f"filter(tokens, w -> NOT coalesce(w IN ({among}), false))")
        left = F.when(F.col("_route") == route, kept).otherwise(left)
    return routed.select(*[left.alias(c) if c == "tokens" else F.col(c) for c in columns])


def _literal(word: str) -> str:
    """A word as SQL text; one with any unusual character by its bytes."""
    if word.isalnum():
        return f"'{word}'"
    return f"CAST(X'{word.encode().hex()}' AS STRING)"


def drop_words(
    tokens: DataFrame,
    listed: DataFrame,
    keep: Sequence[str] = ("post_id", "created_at", "lang"),
    routes: Mapping[str, str] = ROUTES,
    default: str = DEFAULT_ROUTE,
    literal_words: int = LITERAL_WORDS,
) -> DataFrame:
    """Remove the words of a ``(lang, word)`` table of any size from ``tokens``.

    Up to ``literal_words`` listed words are fetched and looked up in place, as sets
    in the expression: nothing is shuffled. A larger table is first cut to the words
    that the tokens use, and these may be few enough. If they aren't, they go to
    the uses as a bitmap of bounded size; only uses that pass it are joined with the
    table, hot words apart, and only hits go back to the posts, whose token lists
    stay whole. Hashtags never match. Posts that share their ``keep`` columns also
    share their language, and so what is removed from them.
    """
    keep = list(keep)
    table = (
        listed.filter(~F.col("word").startswith("#") & F.col("lang").isNotNull())
        .select(F.col("lang").alias("_route"), F.col("word").alias("_word"))
        .distinct()
    )
    routed = tokens.withColumn("_route", route_language(F.col("lang"), routes, default))
    # A listed table may itself come from the texts, so it is computed once.
    table = stored(table, "listed-words")
    few = table.limit(literal_words + 1).collect()
    if len(few) > literal_words:
        # The tokens are read three times from here on.
        tokens = stored(tokens.select(*dict.fromkeys([*keep, "lang", "tokens"])), "tokens")
        routed = tokens.withColumn("_route", route_language(F.col("lang"), routes, default))
        uses = routed.select(*keep, "_route", F.explode(F.array_distinct("tokens")).alias("_word"))
        uses = uses.filter(F.col("_word").isNotNull())
        counts = uses.groupBy("_route", "_word").count()
        used = stored(counts.join(table, ["_route", "_word"]), "used-words")
        few = used.select("_route", "_word").limit(literal_words + 1).collect()
        if len(few) > literal_words:
            return _drop_joined(tokens, uses, used, keep)
    return _drop_in_place(routed, few, [*keep, "tokens"])


def _drop_joined(
    tokens: DataFrame, uses: DataFrame, used: DataFrame, keep: list[str]
) -> DataFrame:
    """``drop_words`` by a join: ``used`` are the listed words with their uses' number."""
    key = F.xxhash64("_route", "_word")
    passed = uses.filter(member(used.select(key.alias("key")), used.count(), key))
    marked = used.select("_route", "_word", F.lit(True).alias("_listed"))
    found = left_join_split_hot(passed, marked, ["_route", "_word"], used).filter("_listed")
    hits = found.groupBy(*[F.col(c).alias(f"_of_{c}") for c in keep]).agg(
        F.collect_set("_word").alias("_hits")
    )
    same = F.lit(True)
    for c in keep:
        same &= tokens[c].eqNullSafe(hits[f"_of_{c}"])
    left = F.filter("tokens", lambda w: ~F.coalesce(F.array_contains("_hits", w), F.lit(False)))
    return tokens.join(hits, same, "left").select(
        *[tokens[c] for c in keep],
        F.when(F.col("_hits").isNull(), F.col("tokens")).otherwise(left).alias("tokens"),
    )


def non_topical(
    lexicon: DataFrame, min_freq_rank: int = DEFAULT_MIN_FREQ_RANK
) -> DataFrame:
    """The lexicon's words to drop: wrong part of speech, or too common."""
    wrong_pos = ~F.col("pos").isin(*TOPICAL_POS)
    too_common = F.col("rank").between(1, min_freq_rank - 1)
    drop = F.coalesce(wrong_pos, F.lit(False)) | F.coalesce(too_common, F.lit(False))
    return lexicon.filter(drop).select("lang", "word")


def unique_lexicon(lexicon: DataFrame) -> DataFrame:
    """Fail the job on a lexicon that holds a (lang, word) more than once.

    Use it when a lexicon is loaded; it costs one aggregation of the lexicon.
    """
    per_word = lexicon.groupBy("lang", "word").agg(
        F.count("*").alias("_copies"),
        F.first("pos").alias("pos"),
        F.first("rank").alias("rank"),
    )
    repeated = F.concat(F.lit("lexicon repeats the word: "), F.col("word"))
    word = F.when(F.col("_copies") > 1, F.raise_error(repeated)).otherwise(F.col("word"))
    return per_word.select("lang", word.alias("word"), "pos", "rank")
