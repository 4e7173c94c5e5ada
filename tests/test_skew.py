"""The whole chain on posts of which a third are copies in one hour, by brute force."""

import math
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from burstline.functions.wordlists import DEFAULT_STOP_WORDS, NOISE_WORDS
from burstline.operators import bursts, terms
from burstline.operators.weights import tfidf
from burstline.plans.trending import post_terms, trending

DROPPED = {*DEFAULT_STOP_WORDS, *NOISE_WORDS}
T0 = datetime(2024, 5, 1)


def fixture():
    """(id, time, cleaned text): 200 of 600 posts are the same text in one hour."""
    rows = []
    for i in range(600):
        if i % 3 == 0:
            rows.append((i, T0 + timedelta(minutes=i % 60), "flood warning for the flood #flood"))
        else:
            words = " ".join(f"w{(i * k) % 17}" for k in range(1, i % 9 + 1))
            rows.append((i, T0 + timedelta(minutes=7 * i % 1440), f"{words} flood the x"))
    return rows


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(
        [(i, "en", t, text) for i, t, text in fixture()],
        "post_id long, lang string, created_at timestamp_ntz, cleaned_text string",
    ).cache()


def tokens_of(text):
    words = [w for w in text.replace("#", " ").split() if len(w) > 1 and w not in DROPPED]
    tags = [w for w in text.split() if w.startswith("#") and len(w) > 1]
    return words + list(dict.fromkeys(tags))


def terms_of(text):
    tokens = tokens_of(text)
    return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


def half_up(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def expected_trends(n, min_count):
    counts = Counter()
    for _, t, text in fixture():
        for topic in terms_of(text):
            counts[t.replace(minute=0), topic] += 1
    per_topic = defaultdict(list)
    for (_, topic), c in counts.items():
        per_topic[topic].append(c)
    by_window = defaultdict(list)
    for (start, topic), c in counts.items():
        if c >= min_count:
            mean = sum(per_topic[topic]) / len(per_topic[topic])
            by_window[start].append((-half_up(c / mean), -c, topic))
    return {
        (start, rank, topic, -c, -score)
        for start, rows in by_window.items()
        for rank, (score, c, topic) in enumerate(sorted(rows)[:n], 1)
    }


@pytest.mark.parametrize("strategy", ["window", "join"])
def test_trends(posts, strategy):
    rows = trending(posts, n=4, min_count=3, strategy=strategy).collect()
    got = {
        (r["start_time"], r["rank"], r["topic"], r["count"], r["burst_score"]) for r in rows
    }
    assert got == expected_trends(4, 3)


def test_post_scores(posts):
    scores = {(s, topic): burst for s, _, topic, _, burst in expected_trends(10**9, 1)}
    expected = {}
    for i, t, text in fixture():
        found = [
            scores[t.replace(minute=0), topic]
            for topic in terms_of(text)
            if (t.replace(minute=0), topic) in scores
        ]
        if terms_of(text):
            expected[i] = (len(found), max(found, default=0.0))
    got = bursts.post_scores(post_terms(posts, with_id=True)).collect()
    assert {r["post_id"]: (r["n_trending"], r["max_score"]) for r in got} == expected


def test_tfidf(posts):
    documents = [tokens_of(text) for _, _, text in fixture()]
    df = Counter(word for d in documents for word in set(d))
    got = {(r["post_id"], r["term"]): r["weight"] for r in tfidf(terms.topical_tokens(posts)).collect()}
    expected = {
        (i, word): count * math.log((len(documents) + 1) / (df[word] + 1))
        for i, d in enumerate(documents)
        for word, count in Counter(d).items()
    }
    assert got.keys() == expected.keys()
    assert all(got[key] == pytest.approx(expected[key], abs=1e-9) for key in got)
