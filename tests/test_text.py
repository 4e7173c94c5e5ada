import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from burstline.functions import text as tx


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("", ""),
        (None, None),
        ("See https://site.example/a?b=1 now", "see  now"),
        ("Hi @someone", "hi"),
        ("New #topic", "new #topic"),
        ("What!!! Now?? So: yes", "what now so yes"),
        ("SHOUTING Words", "shouting words"),
        ("   inner  gap\t", "inner  gap"),
        ("\u00a0\u2003edges\u3000", "edges"),
        ("!@#$%^&*()", "#"),
        ("#word42", "#word42"),
        ("#snake_case", "#snakecase"),
        ("naïve façade", "nave faade"),
        ("don't a.b", "dont ab"),
        ("hearts &lt;3", "hearts  3"),
        ("Salt &amp; Pepper", "salt   pepper"),
        ("it&#39;s", "it#39s"),
        ("http://a.example https://b.example", ""),
        ("Year 2024", "year 2024"),
        ("@äöü_9 x", "x"),
        ("htt@you p://z", "htt pz"),
    ],
)
def test_clean(evaluate, raw, cleaned):
    assert evaluate(tx.clean, raw) == cleaned


def test_null_cleans_to_empty_when_asked(evaluate):
    assert evaluate(tx.clean_or_empty, None) == ""


def stepwise(text):
    """The clean spelled out with Python's own Unicode classes."""
    for pattern, by in (
        (r"&\w+;", " "),
        (r"http\S+|@\w+", ""),
        (r"[!?:;()<>\[\]{}|/\\]", ""),
        (r"[^A-Za-z0-9\s#]", ""),
    ):
        text = re.sub(pattern, by, text)
    return text.lower().strip()


PIECES = st.lists(
    st.one_of(
        st.sampled_from(
            ["http", "https://t.co/x", "@", "@me", "&amp;", "&", ";", "#", "#Tag", " ", "\n",
             "\x1c", "\x85", "\u2028", "\u00a0", "é", "ß", "İ", "日本", "😀", "a", "Z9", "_"]
        ),
        st.text(alphabet=st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), max_size=4),
    ),
    max_size=12,
).map("".join)


@settings(max_examples=8, deadline=None)
@given(st.lists(PIECES, min_size=40, max_size=60))
def test_clean_equals_stepwise(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", tx.clean(F.col("x")).alias("y")).collect()
    assert [r["y"] for r in rows] == [stepwise(r["x"]) for r in rows]


@pytest.mark.parametrize(
    "raw, tags",
    [
        ("Hi #all", ["#all"]),
        ("none here", []),
        ("#One #Two #Three", ["#One", "#Two", "#Three"]),
        ("", []),
        ("mid #way through", ["#way"]),
        ("#under_score", ["#under_score"]),
        ("only a # sign", []),
        ("#été #été", ["#été", "#été"]),
        (None, None),
    ],
)
def test_hashtags(evaluate, raw, tags):
    assert evaluate(tx.hashtags, raw) == tags


def test_single_steps(evaluate):
    assert evaluate(tx.strip_entities, "a&quot;b & c;") == "a b & c;"
    assert evaluate(tx.strip_urls_mentions, "x http://y z @w!") == "x  z !"
    assert evaluate(tx.strip_punct, "a!b?[c]{d}|e/f\\g.h") == "abcdefg.h"
    assert evaluate(tx.keep_alnum_hash, "a-b_c #d\té") == "abc #d\t"
    assert evaluate(tx.lower_strip, "\t A  B \u2029") == "a  b"
