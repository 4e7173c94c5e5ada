import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from burstline.operators import terms, vocabulary as vocab
from burstline.schemas import LEXICON
from checks.queries import QUERIES
from conftest import plan_of

POSTS = "post_id long, lang string, created_at timestamp_ntz, cleaned_text string"


def posts(spark, *rows):
    full = [(i, lang, None, text) for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(full, POSTS)


def tokens_of(df):
    return [r["tokens"] for r in df.orderBy("post_id").collect()]


def test_filters_and_hashtags(spark):
    df = posts(
        spark,
        ("en", "the storm hits lol storm #storm2 #storm2 x"),
        ("unknown", "some words #kept"),
        ("en", ""),
        (None, "een woord hahaha"),
    )
    got = tokens_of(terms.topical_tokens(df, stop_words=["the", "een"]))
    assert got == [
        ["storm", "hits", "storm", "storm2", "storm2", "#storm2"], [], [], ["woord"],
    ]


def test_no_tokens_without_cleaned_words(spark):
    df = posts(spark, ("en", "# a b"))
    assert tokens_of(terms.topical_tokens(df)) == [[]]


def test_common_words_by_route(spark):
    ranks = spark.createDataFrame(
        [("en", "top", 0), ("en", "people", 1), ("en", "time", 2), ("en", "quake", 900),
         ("nl", "mensen", 3)],
        "lang string, word string, rank int",
    )
    df = posts(spark, ("en", "top people time people quake mensen #people"),
               ("fr", "people mensen"), (None, "mensen huis"))
    for threshold, expected in (
        (700, [["top", "quake", "mensen", "#people"], ["people"], ["huis"]]),
        (0, [["top", "people", "time", "people", "quake", "mensen", "people", "#people"],
             ["people", "mensen"], ["mensen", "huis"]]),
    ):
        common = vocab.common_words(ranks, threshold)
        assert tokens_of(terms.topical_tokens(df, stop_words=(), common=common)) == expected
        tokens = terms.topical_tokens(df, stop_words=(), keep=("post_id", "lang"))
        for few in (50_000, 0):
            assert tokens_of(vocab.drop_common(tokens, common, literal_words=few)) == expected


def test_lexicon_drops_by_pos_and_rank(spark):
    lexicon = spark.createDataFrame(
        [("en", "ran", "VERB", None), ("en", "park", "NOUN", 5000), ("en", "people", "NOUN", 5),
         ("en", "rare", "PROPN", 0), ("nl", "park", "VERB", None)],
        LEXICON,
    )
    df = posts(spark, ("en", "ran park people rare novel park #ran"), ("nl", "park ran"),
               ("en", "ran"))
    got = tokens_of(terms.topical_tokens(df, stop_words=(), lexicon=lexicon))
    assert got == [["park", "rare", "novel", "park", "#ran"], ["ran"], []]
    loose = terms.topical_tokens(df, stop_words=(), lexicon=lexicon, min_freq_rank=0)
    assert tokens_of(loose)[0] == ["park", "people", "rare", "novel", "park", "#ran"]


def test_lexicon_join_keeps_hot_words_whole(spark):
    """One word holds most tokens; the shuffle join still keeps every copy."""
    texts = [("en", "hot " * 30 + f"w{i}") for i in range(300)]
    lexicon = spark.createDataFrame([("en", "w7", "VERB", None)], LEXICON)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = tokens_of(terms.topical_tokens(posts(spark, *texts), (), lexicon=lexicon))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [len(t) for t in got] == [31 if i != 7 else 30 for i in range(300)]


def test_posts_may_share_their_id(spark):
    lexicon = spark.createDataFrame([("en", "ran", "VERB", None)], LEXICON)
    df = posts(spark, ("en", "aa bb"), ("en", "cc ran")).withColumn("post_id", F.lit(None).cast("long"))
    got = [r["tokens"] for r in terms.topical_tokens(df, lexicon=lexicon).collect()]
    assert sorted(got) == [["aa", "bb"], ["cc"]]


def dropped_by(spark, rows, listed, **options):
    tokens = spark.createDataFrame(rows, "post_id long, created_at timestamp, lang string, tokens array<string>")
    table = spark.createDataFrame(listed, "lang string, word string")
    return tokens, vocab.drop_words(tokens, table, **options)


@pytest.mark.parametrize("literal_words", [50_000, 300, 0], ids=["literal", "used words", "join"])
def test_drop_words_against_brute_force(spark, literal_words):
    rng = random.Random(6)
    pool = [f"w{i}" for i in range(400)] + ["#w1", "it's", "a\\b", "é", "", "\U0001f600"]
    # one word in a third of all uses; one id is null, one list is
    rows = [
        (i or None, None, rng.choice(["en", "fr", None]),
         [rng.choice([*pool, None]) if rng.random() > 0.3 else "hot" for _ in range(rng.randrange(40))])
        for i in range(120)
    ] + [(500, None, "en", None)]
    listed = [(rng.choice(["en", "nl"]), w) for w in pool if rng.random() < 0.5]
    listed += [("en", "hot"), ("en", "hot"), ("nl", "#w1"), ("xx", "w2"), (None, "w3")]
    listed += [("en", f"never{i}") for i in range(200)]
    drop = {(lang, w) for lang, w in listed if not w.startswith("#")}
    expected = {
        (i, tuple(w for w in tokens or () if ("en" if lang == "en" else "nl", w) not in drop))
        for i, _, lang, tokens in rows
    }
    _, got = dropped_by(spark, rows, listed, literal_words=literal_words)
    assert got.columns == ["post_id", "created_at", "lang", "tokens"]
    assert {(r["post_id"], tuple(r["tokens"] or ())) for r in got.collect()} == expected


def test_few_listed_words_are_dropped_without_a_shuffle(spark):
    rows, listed = [(1, None, "en", ["a", "b"])], [("en", "a")]
    assert "Exchange" not in plan_of(dropped_by(spark, rows, listed)[1])
    joined = dropped_by(spark, rows, listed, literal_words=0)[1]
    assert "getbit" in joined._jdf.queryExecution().toString()
    for options in ({}, {"literal_words": 0}):
        assert dropped_by(spark, [], listed, **options)[1].count() == 0
        assert dropped_by(spark, rows, [], **options)[1].first()["tokens"] == ["a", "b"]


def test_repeated_lexicon_entry_fails(spark):
    lexicon = spark.createDataFrame(
        [("en", "run", "NOUN", None), ("en", "run", "VERB", None)], LEXICON
    )
    with pytest.raises(PySparkException, match="repeats the word: run"):
        vocab.unique_lexicon(lexicon).collect()


def test_freq_rank(spark):
    df = spark.createDataFrame(
        [("en", ["b", "a", "b", "c"]), ("en", ["a"]), ("nl", ["z"])],
        "lang string, tokens array<string>",
    )
    ranks = vocab.freq_rank(df)
    rows = {(r["lang"], r["rank"]): r["word"] for r in ranks.collect()}
    assert rows == {("en", 0): "a", ("en", 1): "b", ("en", 2): "c", ("nl", 0): "z"}


def test_ranks_are_complete_and_any_threshold_works(spark):
    words = [f"{chr(97 + i % 26)}{i}" for i in range(2600)] + ["é", "e", "ez", "€"]
    lists = [("en", words), ("en", words[:1300]), (None, ["x", "y"])]
    df = spark.createDataFrame(lists, "lang string, tokens array<string>")
    ranks = vocab.freq_rank(df)
    got = {(r["lang"], r["word"]): r["rank"] for r in ranks.collect()}
    order = sorted(words[:1300]) + sorted(words[1300:])
    assert got == {("en", w): i for i, w in enumerate(order)} | {(None, "x"): 0, (None, "y"): 1}
    common = vocab.common_words(ranks.filter("lang = 'en'"), 2000).first()["common"]
    assert sorted(common) == sorted(order[1:2000])


def test_stop_word_table_is_a_set(spark):
    table = vocab.stop_words(spark)
    words = [r["word"] for r in table.collect()]
    assert len(words) == len(set(words)) and {"the", "een", "in"} <= set(words)


def test_explode_and_union_give_the_same_bag(spark):
    df = spark.createDataFrame(
        [(None, ["aa", "bb", "aa"]), (None, ["cc"]), (None, []), (None, None)],
        "created_at timestamp, tokens array<string>",
    )
    one = sorted(r["topic"] for r in terms.explode_terms(df).collect())
    two = sorted(r["topic"] for r in terms.union_terms(df).collect())
    assert one == two == ["aa", "aa", "aa bb", "bb", "bb aa", "cc"]
    three = [r["topic"] for r in terms.explode_terms(df, max_n=3).collect()]
    assert "aa bb aa" in three
    assert terms.nonempty(df).count() == 2


def test_grams_are_made_as_tokens_are_unnested(spark):
    rows = [(1, ["a", None, "b", "c"]), (2, None), (3, []), (4, [" ", "d"]), (5, ["e"])]
    tokens = spark.createDataFrame(rows, "post_id int, tokens array<string>")
    unnested = terms.explode_terms(tokens, max_n=3, keep=["post_id"])
    assert "zip_with" not in plan_of(unnested)
    assert sorted(map(tuple, unnested.collect())) == [
        (1, "a"), (1, "b"), (1, "b c"), (1, "c"), (4, "  d"), (4, "d"), (5, "e"),
    ]


def test_blank_topics_go(spark):
    df = spark.createDataFrame([("a",), (" ",), ("",), (None,)], "topic string")
    assert [r["topic"] for r in terms.drop_blank_topics(df).collect()] == ["a"]


def test_tagger_hook(spark):
    def factory():
        verbs = {"ran"}

        def tagger(text, lang):
            return [
                (w, "VERB" if w in verbs else "NOUN", 3 if w == "time" else 0)
                for w in text.split()
            ]

        return tagger

    df = posts(spark, ("en", "fox ran time lol fox #den"), ("unknown", "fox"))
    tagged = terms.tag_with(df, factory)
    got = terms.topical_from_tags(tagged, stop_words=())
    rows = {r["post_id"]: r["tokens"] for r in got.collect()}
    assert rows == {0: ["fox", "fox", "#den"], 1: []}


def test_tokens_come_from_one_scan_without_python(spark):
    plan = plan_of(terms.explode_terms(terms.topical_tokens(posts(spark, ("en", "some text")))))
    assert "Python" not in plan and plan.count("Generate") == 1 and "Exchange" not in plan


def test_union_of_terms_unnests_once(spark):
    rows = [(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["c"]), (4, ["c", " ", "d"])]
    tokens = spark.createDataFrame(rows, "created_at int, tokens array<string>")
    united = terms.union_terms(tokens)
    assert plan_of(united).count("Generate") == 1
    assert Counter(map(tuple, united.collect())) == Counter(map(tuple, terms.explode_terms(tokens).collect()))


@pytest.mark.parametrize("name", ["topical_tokens", "pos_filter", "freq_filter"])
def test_filters_from_the_posts_own_words_clean_them_once(spark, name):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "documents.parquet" not in plan and "events.parquet" not in plan
    assert "doc_id" not in plan and "event_id" not in plan
