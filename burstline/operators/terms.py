"""Posts to terms: topical tokens, n-grams, unnesting, and a tagger hook."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.functions import text as tx
from burstline.functions import tokens as tk
from burstline.functions.wordlists import DEFAULT_STOP_WORDS
from burstline.operators import vocabulary as vocab

TAGGED = "array<struct<word: string, pos: string, rank: int>>"

# (text, lang) -> [(word, pos, rank), ...]
Tagger = Callable[[str, str], list[tuple[str, str, int]]]


def with_cleaned_text(posts: DataFrame) -> DataFrame:
    """Add ``cleaned_text``, never null."""
    return posts.withColumn("cleaned_text", tx.clean_or_empty(F.col("text")))


def with_words(posts: DataFrame, hashtag_bodies: bool = True) -> DataFrame:
    """Add ``words``, the unfiltered words of ``cleaned_text``."""
    return posts.withColumn("words", tk.words(F.col("cleaned_text"), hashtag_bodies))


def topical_tokens(
    posts: DataFrame,
    stop_words: Iterable[str] = DEFAULT_STOP_WORDS,
    common: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    min_freq_rank: int = vocab.DEFAULT_MIN_FREQ_RANK,
    keep: Sequence[str] = ("post_id", "created_at", "lang"),
    routes: Mapping[str, str] = vocab.ROUTES,
    hashtag_bodies: bool = True,
) -> DataFrame:
    """``keep`` columns plus ``tokens``: the words and hashtags that can be topics.

    Words pass the length, stop-word and noise filters, then, if given, the
    ``common`` table (see ``vocabulary.common_words``) and the ``lexicon``'s
    part-of-speech and rank filters. Duplicate words stay. Hashtags follow the
    words, each once, exempt from all filters. An empty text or the language
    ``unknown`` gives an empty list. Needs ``cleaned_text`` and ``lang``.
    """
    cleaned = F.col("cleaned_text")
    usable = (F.length(cleaned) > 0) & ~F.col("lang").eqNullSafe("unknown")
    columns = list(dict.fromkeys([*keep, "lang"]))
    words = tk.remove_stopwords(tk.words(cleaned, hashtag_bodies), stop_words)
    # The words hold no "#", so no tag can be among them already.
    tags = F.array_distinct(F.transform(tx.hashtags(cleaned), F.lower))
    nothing = F.array().cast("array<string>")
    tokens = posts.select(
        *columns,
        F.when(usable, F.concat(words, tags)).otherwise(nothing).alias("tokens"),
    )
    if common is not None:
        tokens = vocab.drop_common(tokens, common, routes)
    if lexicon is not None:
        listed = vocab.non_topical(lexicon, min_freq_rank)
        tokens = vocab.drop_words(tokens, listed, columns, routes)
    return tokens.select(*keep, "tokens")


def nonempty(tokens: DataFrame) -> DataFrame:
    """Posts that still hold a token."""
    return tokens.filter(F.size("tokens") > 0)


def explode_terms(
    tokens: DataFrame, max_n: int = 2, keep: Sequence[str] = ("created_at",)
) -> DataFrame:
    """One row per term occurrence: every token and n-gram up to ``max_n`` words.

    The tokens are unnested in one pass, each beside the n-grams that begin there, and
    these columns are unpivoted to rows. Grams are null where too few tokens follow. The outer explode
    keeps Catalyst from computing the tokens a second time in a filter of its
    own; the empty row it adds is dropped with the blank topics. The kept columns are
    unpivoted with the grams: beside them, two copies of the plan would not be seen to
    be equal, and their shuffles not be reused.
    """
    each = tokens.select(*keep, "tokens", F.posexplode_outer("tokens").alias("_at", "_gram1"))
    grams = [F.col("_gram1")]
    for n in range(1, max_n):
        grams.append(F.concat(grams[-1], F.lit(" "), F.get("tokens", F.col("_at") + n)))
    names = [f"_term{n}" for n in range(1, max_n + 1)]
    beside = each.select(
        *[F.struct(*keep, gram.alias("topic")).alias(name) for gram, name in zip(grams, names)]
    )
    unnested = beside.unpivot([], names, "_gram", "_term").select("_term.*")
    return drop_blank_topics(unnested)


def union_terms(tokens: DataFrame, keep: Sequence[str] = ("created_at",)) -> DataFrame:
    """The same bag as ``explode_terms``, as a union of words and pairs.

    The union is one of each post's two lists, so that the tokens, and all that they
    come from, are computed once and not for each side.
    """
    words = F.coalesce("tokens", F.array().cast("array<string>"))
    pairs = tk.ngrams(F.col("tokens"), 2)
    united = tokens.select(*keep, F.explode_outer(F.flatten(F.array(words, pairs))).alias("topic"))
    return drop_blank_topics(united)


def drop_blank_topics(terms: DataFrame) -> DataFrame:
    """Drop null and blank topics."""
    return terms.filter(F.col("topic").isNotNull() & (F.length(F.trim("topic")) > 0))


def tag_with(
    posts: DataFrame, factory: Callable[[], Tagger], id_col: str = "post_id"
) -> DataFrame:
    """Run a caller's tagger over the posts: ``(id, lang, cleaned_text, tagged)``.

    ``factory`` is called once per task and returns the tagger, so a model that
    cannot be pickled is loaded where it is used.
    """
    id_type = posts.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, lang string, cleaned_text string, tagged {TAGGED}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = factory()
        for batch in batches:
            tagged = [
                [{"word": w, "pos": p, "rank": r} for w, p, r in tagger(text, lang)]
                for text, lang in zip(batch["cleaned_text"], batch["lang"])
            ]
            yield batch.assign(tagged=tagged)

    return posts.select(id_col, "lang", "cleaned_text").mapInPandas(run, schema)


def topical_from_tags(
    tagged: DataFrame,
    stop_words: Iterable[str] = DEFAULT_STOP_WORDS,
    min_freq_rank: int = vocab.DEFAULT_MIN_FREQ_RANK,
) -> DataFrame:
    """Replace ``tagged`` (see ``tag_with``) by ``tokens``, under the same filters."""
    stop_words = list(stop_words)
    lowered = F.transform(
        "tagged",
        lambda t: F.struct(
            tx.lower_strip(t["word"]).alias("word"),
            t["pos"].alias("pos"),
            F.coalesce(t["rank"], F.lit(0)).alias("rank"),
        ),
    )
    kept = F.filter(
        lowered,
        lambda t: tk.is_word_kept(t["word"], stop_words)
        & t["pos"].isin(*vocab.TOPICAL_POS)
        & ((t["rank"] == 0) | (t["rank"] >= min_freq_rank)),
    )
    usable = (F.length("cleaned_text") > 0) & ~F.col("lang").eqNullSafe("unknown")
    words = F.transform(kept, lambda t: t["word"])
    tokens = tk.combine_hashtags(words, tx.hashtags(F.col("cleaned_text")))
    nothing = F.array().cast("array<string>")
    return tagged.withColumn(
        "tokens", F.when(usable, tokens).otherwise(nothing)
    ).drop("tagged")
