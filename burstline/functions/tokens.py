"""Token arrays as native Column expressions: split, filter, hashtags, n-grams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from burstline.functions.text import SPACE
from burstline.functions.wordlists import NOISE_WORDS

LAUGHTER = r"^(?:(ha){2,}h?|(hi){2,})\z"


def words(cleaned: Column, hashtag_bodies: bool = True) -> Column:
    """Runs of ``[a-z0-9]`` in a cleaned text.

    A hashtag's body counts as a word besides the tag itself; pass
    ``hashtag_bodies=False`` to leave it to the tag alone.
    """
    if not hashtag_bodies:
        cleaned = F.regexp_replace(cleaned, "#[a-z0-9]+", " ")
    # A cleaned text holds nothing but words, "#" and white space. Splitting at a
    # single blank needs no regex, which a split pattern would run at every word.
    spaced = F.regexp_replace(cleaned, f"[#{SPACE}&&[^ ]]", " ")
    return F.array_remove(F.split(spaced, " "), "")


def is_laughter(word: Column) -> Column:
    """True for a run of laughter of any length (``hahaha``, ``hihi``)."""
    may_be = word.startswith("haha") | word.startswith("hihi")
    return may_be & word.rlike(LAUGHTER)


def is_noise(word: Column) -> Column:
    """True for a known noise word or a run of laughter."""
    return word.isin(*NOISE_WORDS) | is_laughter(word)


def is_word_kept(word: Column, stop_words: Iterable[str]) -> Column:
    """Longer than one character, no stop word, no noise.

    Stop words and noise words form one literal set, looked up by hash.
    """
    dropped = [*NOISE_WORDS, *stop_words]
    return ~word.isin(*dropped) & (F.length(word) > 1) & ~is_laughter(word)


def remove_stopwords(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Drop stop words, noise and single characters; order and duplicates stay.

    ``stop_words`` becomes a literal set looked up by hash in each task. For
    lists that are a table, use ``operators.vocabulary.drop_words``.
    """
    if isinstance(stop_words, str):
        raise TypeError("stop_words must be a collection of words, not a string")
    stop_words = list(stop_words)
    return F.filter(tokens, lambda w: is_word_kept(w, stop_words))


def combine_hashtags(tokens: Column, tags: Column) -> Column:
    """Append the lower-cased tags that the list does not hold yet, each once."""
    return F.concat(tokens, F.array_except(F.transform(tags, F.lower), tokens))


def ngrams(tokens: Column, n: int = 2) -> Column:
    """Adjacent groups of ``n`` tokens joined by a space; empty if too few or null.

    Each step zips the list with itself shifted by one, so the work is linear in
    the list length.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    tokens = F.coalesce(tokens, F.array().cast("array<string>"))
    grams = tokens
    for shift in range(1, n):
        length = F.greatest(F.size(tokens) - shift, F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), length),
            F.slice(tokens, F.lit(shift + 1), length),
            lambda left, right: F.concat(left, F.lit(" "), right),
        )
    return grams
