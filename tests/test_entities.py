import random
from functools import partial

import pytest
from pyspark.errors import PySparkException

from burstline.operators.entities import Automaton, entities
from burstline.schemas import GAZETTEER
from conftest import plan_of


@pytest.fixture
def gazetteer(spark):
    return spark.createDataFrame(
        [("en", "Ada Byron", "PERSON"), ("en", "ada", "PERSON"), ("en", "new delft", "GPE"),
         ("en", "delft", "GPE"), ("en", "delft", "ORG"), ("en", "new delft city", "ORG"),
         ("en", "monday", "DATE"), ("nl", "delft", "GPE")],
        GAZETTEER,
    )


@pytest.fixture(params=["one pass", "join"])
def found(request):
    return partial(_found, most_words=None if request.param == "one pass" else 0)


def _found(spark, gazetteer, *rows, most_words=None, **options):
    if most_words is not None:
        options["most_words"] = most_words
    df = spark.createDataFrame(
        [(i, text, lang) for i, (text, lang) in enumerate(rows)],
        "post_id long, text string, lang string",
    )
    result = entities(df, gazetteer, **options).orderBy("post_id")
    return [r["entities"] for r in result.collect()]


def test_longest_match_from_the_left(spark, gazetteer, found):
    assert found(
        spark, gazetteer,
        ("Ada Byron saw NEW Delft on monday.", "en"),
        ("Ada of New Delft City, Delft", "en"),
        ("new delft", "nl"),
        ("Ada in Delft", "unknown"),
        ("nothing here", "en"),
        ("", "en"),
    ) == ["Ada Byron NEW Delft", "Ada New Delft City Delft", "delft", "", "", ""]


@pytest.mark.parametrize("row", [("text", "fr"), (None, "en"), ("text", None)])
def test_wrong_input_fails(spark, gazetteer, found, row):
    with pytest.raises(PySparkException, match="lang must be one of"):
        found(spark, gazetteer, row)


def test_long_and_punctuated_names(spark, found):
    bank = "United Arab Emirates Central Bank"
    gazetteer = spark.createDataFrame(
        [("en", bank, "ORG"), ("en", "U.S.", "GPE"), ("en", "o'neil-smith", "PERSON"),
         ("en", "united", "ORG"), ("en", "...", "GPE"), ("en", "w " * 40, "ORG")],
        GAZETTEER,
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert found(
            spark, gazetteer, (f"the {bank.upper()}, in the U.S.!", "en"),
            ("United Arab Emirates; O'Neil Smith", "en"), ("w " * 85, "en"),
        ) == [f"{bank.upper()} U S", "United O Neil Smith", " ".join(["w"] * 80)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_languages_can_be_widened(spark, gazetteer, found):
    assert found(spark, gazetteer, ("Ada", "fr"), languages=("en", "fr")) == [""]


def walked(names, words):
    """Leftmost, then longest, by trying every name at every word."""
    out, i = [], 0
    while i < len(words):
        size = max((len(n) for n in names if words[i : i + len(n)] == n), default=0)
        if size:
            out.append((i, i + size))
        i += size or 1
    return out


def test_automaton_against_trying_all_names():
    rng = random.Random(3)
    for _ in range(300):
        names = [rng.choices("abc", k=rng.randrange(1, 6)) for _ in range(rng.randrange(1, 9))]
        words = rng.choices("abcd", k=40)
        own = Automaton(names)
        codes = [own.number.get(w, -1) for w in words]
        assert own.leftmost_longest(codes) == walked(names, words)


def test_random_texts(spark, found):
    rng = random.Random(5)
    pool = ["de", "De", "ß", "É", "x1", "y_", "the"]
    names = [" ".join(rng.choices(pool, k=rng.randrange(1, 5))) for _ in range(25)]
    gazetteer = spark.createDataFrame([(rng.choice(["en", "nl"]), n, "ORG") for n in names], GAZETTEER)
    listed = {lang: [] for lang in ("en", "nl")}
    for r in gazetteer.collect():
        listed[r["lang"]].append(r["surface"].lower().split())
    rows = [(" ".join(rng.choices(pool, k=rng.randrange(30))), rng.choice(["en", "nl"])) for _ in range(60)]
    expected = []
    for text, lang in rows:
        words = text.split()
        spans = walked(listed[lang], [w.lower() for w in words])
        expected.append(" ".join(" ".join(words[a:b]) for a, b in spans))
    assert found(spark, gazetteer, *rows) == expected


def test_shuffles(spark, gazetteer):
    posts = spark.createDataFrame([(1, "Ada", "en")], "post_id long, text string, lang string")
    assert "Exchange" not in plan_of(entities(posts, gazetteer))


def test_an_empty_gazetteer_and_no_posts(spark, gazetteer, found):
    none = spark.createDataFrame([], GAZETTEER)
    assert found(spark, none, ("Ada", "en")) == [""]
    posts = spark.createDataFrame([], "post_id long, text string, lang string")
    assert entities(posts, gazetteer).count() == 0


def test_posts_that_share_an_id_keep_their_own_names(spark, gazetteer):
    posts = spark.createDataFrame(
        [(1, "Ada", "en"), (1, "Delft", "en"), (None, "Ada", "en")], "post_id long, text string, lang string"
    )
    got = [(r["post_id"], r["entities"]) for r in entities(posts, gazetteer).collect()]
    assert sorted(got, key=str) == [(1, "Ada"), (1, "Delft"), (None, "Ada")]
