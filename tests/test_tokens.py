import pytest
from pyspark.ml.feature import NGram, StopWordsRemover
from pyspark.sql import functions as F

from burstline.functions import tokens as tk
from burstline.functions import wordlists


@pytest.mark.parametrize("word", ["lt3", "rt", "haha", "hahaha", "hahahaha", "hahahahah",
                                  "hihi", "hihihi", "hehe", "hehehehe", "xoxo"])
def test_noise(evaluate, word):
    assert evaluate(tk.is_noise, word) is True


@pytest.mark.parametrize("word", ["spark", "holland", "haha1", "ahaha", "ha", "hi", "hehehe",
                                  "hahahax", "hihih"])
def test_no_noise(evaluate, word):
    assert evaluate(tk.is_noise, word) is False


def test_noise_list_has_31_entries():
    assert len(set(wordlists.NOISE_WORDS)) == 31


def test_stop_words_are_sparks(spark):
    for language, words in (("english", wordlists.ENGLISH_STOP_WORDS),
                            ("dutch", wordlists.DUTCH_STOP_WORDS)):
        assert list(words) == StopWordsRemover.loadDefaultStopWords(language)


@pytest.mark.parametrize(
    "words, stop, kept",
    [
        (["boats", "leave", "old", "piers"], ["and", "old"], ["boats", "leave", "piers"]),
        (["x", "harbour", "7", "oak"], [], ["harbour", "oak"]),
        ([], ["the"], []),
        (["the", "is"], ["the", "is"], []),
        (["#tide", "tide", "rising"], ["tide"], ["#tide", "rising"]),
        (["lt3", "storm", "hihihi", "rt", "warning"], [], ["storm", "warning"]),
        (["b2", "b2", "aa", "b2"], ["aa"], ["b2", "b2", "b2"]),
    ],
)
def test_remove_stopwords(evaluate, words, stop, kept):
    assert evaluate(lambda c: tk.remove_stopwords(c, stop), words, "array<string>") == kept


def test_remove_stopwords_rejects_a_string():
    with pytest.raises(TypeError):
        tk.remove_stopwords(None, "the")


def test_words(evaluate):
    assert evaluate(tk.words, "a  b#c\n#d2 \u2003e") == ["a", "b", "c", "d2", "e"]
    assert evaluate(lambda c: tk.words(c, hashtag_bodies=False), "a #tag b") == ["a", "b"]
    assert evaluate(tk.words, "") == []


def test_combine_hashtags(spark):
    df = spark.createDataFrame(
        [(["aa", "#x", "aa"], ["#X", "#Y", "#y"])], "w array<string>, t array<string>"
    )
    combined = df.select(tk.combine_hashtags(F.col("w"), F.col("t")).alias("c")).first()["c"]
    assert combined == ["aa", "#x", "aa", "#y"]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_ngrams_equal_spark_ml(spark, n):
    lists = [[], ["a"], ["a", "b"], ["a", "b", "c"], ["x", "x", "y", "x", "z"]]
    df = spark.createDataFrame([(words,) for words in lists], "w array<string>")
    ours = df.select("w", tk.ngrams(F.col("w"), n).alias("ours"))
    both = NGram(n=n, inputCol="w", outputCol="theirs").transform(ours)
    assert both.filter("ours != theirs").count() == 0


def test_ngrams_of_null_are_empty(evaluate):
    assert evaluate(lambda c: tk.ngrams(c, 2), None, "array<string>") == []
    with pytest.raises(ValueError):
        tk.ngrams(F.col("x"), 0)
