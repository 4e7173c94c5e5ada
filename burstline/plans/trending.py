"""Posts in, trends out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from burstline.functions.wordlists import DEFAULT_STOP_WORDS
from burstline.operators import bursts, terms, vocabulary


def post_terms(
    posts: DataFrame,
    stop_words: Iterable[str] = DEFAULT_STOP_WORDS,
    common: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    min_freq_rank: int = vocabulary.DEFAULT_MIN_FREQ_RANK,
    max_n: int = 2,
    with_id: bool = False,
    at: str = "created_at",
) -> DataFrame:
    """Term occurrences ``(created_at, topic)`` of cleaned posts.

    Posts need ``cleaned_text``, ``lang`` and ``created_at``, or the column ``at`` in
    its place; a lexicon, which regroups tokens by post, also needs ``post_id``.
    ``with_id`` keeps the id.
    """
    keep = [at]
    if with_id or lexicon is not None:
        keep = ["post_id", at]
    tokens = terms.topical_tokens(
        posts, stop_words, common, lexicon, min_freq_rank, keep=keep
    )
    return terms.explode_terms(tokens, max_n, keep if with_id else [at])


def trending(
    posts: DataFrame,
    n: int = 5,
    interval: str = "hour",
    min_count: int = 2,
    baseline: str = "present",
    strategy: str = "window",
    start_offset: str | None = None,
    stop_words: Iterable[str] = DEFAULT_STOP_WORDS,
    common: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    min_freq_rank: int = vocabulary.DEFAULT_MIN_FREQ_RANK,
    max_n: int = 2,
) -> DataFrame:
    """The top ``n`` topics of every window by burst score.

    A topic's burst score is its count in the window over its mean count. Topics
    are words, hashtags and pairs of neighbouring tokens. A topic that occurs in
    one window only scores 1.0 under the ``present`` baseline.
    """
    # Windows are those of the posts. A filter by window above the terms would be pushed
    # below them in one copy of the plan alone, and the counts' shuffle not be reused.
    dated = bursts.with_window_start(posts, interval, start_offset)
    occurrences = post_terms(
        dated, stop_words, common, lexicon, min_freq_rank, max_n, at="start_time"
    )
    counts = bursts.count_by_window(occurrences)
    return bursts.trends_from_counts(counts, n, interval, min_count, baseline, strategy)
