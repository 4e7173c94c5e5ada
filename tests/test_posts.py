import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from burstline.operators import terms
from burstline.plans.trending import trending
from burstline.sources import posts as src

RECORDS = [
    {
        "interaction": {"content": "sneeuw valt @iemand", "id": "1", "author": {"id": 5}},
        "language": {"tag": "nl"},
        "twitter": {"id": "1", "created_at": "Sat, 04 Feb 2012 09:38:03 +0000",
                    "user": {"geo_enabled": True}, "mentions": ["iemand"]},
    },
    {
        "interaction": {"content": "@ander #winterpret! https://t.example/x"},
        "language": {"tag": "nl"},
        "twitter": {"id": "2", "created_at": "Sat, 04 Feb 2012 09:40:00 +0000"},
        "klout": {"score": 30},
    },
    {
        "interaction": {"content": "RT @derde: nogmaals"},
        "language": {"tag": "en"},
        "twitter": {"id": "3", "retweet": {"created_at": "Sat, 04 Feb 2012 09:41:00 +0000"}},
    },
]


@pytest.fixture
def sample(tmp_path):
    path = tmp_path / "posts.json"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS) + "\n")
    return str(path)


def test_three_in_two_out(spark, sample):
    assert src.read_posts(spark, sample).count() == 3
    df = src.load_posts(spark, sample)
    rows = df.orderBy("post_id").collect()
    assert df.columns == ["post_id", "text", "lang", "created_at", "cleaned_text"]
    assert len(rows) == 2 and rows[0]["lang"] == "nl"
    assert rows[0]["cleaned_text"] == "sneeuw valt"
    assert rows[1]["cleaned_text"] == "#winterpret"
    assert rows[0]["created_at"] == datetime(2012, 2, 4, 9, 38, 3)
    tags = terms.topical_tokens(df).filter("post_id = '2'").first()["tokens"]
    assert tags == ["winterpret", "#winterpret"]


def test_date_range(spark, sample):
    def count(*bounds, **options):
        return src.load_posts(spark, sample, *bounds, **options).count()

    assert count("2099-01-01", "2099-12-31") == 0
    assert count("2012-01-01", "2012-12-31") == 2
    assert count("2012-02-04", "2012-02-04") == 0  # a bare end date is its midnight
    assert count("2012-02-04", "2012-02-04", end_inclusive_day=True) == 2
    assert count("2012-02-04 09:38:03", "2012-02-04 09:38:03") == 1
    for bounds in (("yesterday", None), (None, "2012-13-01")):
        with pytest.raises(ValueError):
            count(*bounds)


def test_parse_created_at(evaluate):
    parse = src.parse_created_at
    expected = datetime(2012, 2, 4, 9, 38, 3)
    assert evaluate(parse, "Sat, 04 Feb 2012 09:38:03 +0000") == expected
    assert evaluate(parse, "Sat, 04 Feb 2012 11:38:03 +0200") == expected
    for bad in (None, "", "n/a", "2012-02-04", "Sat, 99 Feb 2012 09:38:03 +0000"):
        assert evaluate(parse, bad) is None


def test_bad_lines_are_kept_aside(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{bad\n{"twitter": {"id": "9"}}\n')
    raw = src.read_posts(spark, str(path)).cache()
    assert raw.filter(F.col("_corrupt_record").isNotNull()).count() == 1
    assert src.load_posts(spark, str(path)).count() == 0


def test_missing_path_raises(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        src.read_posts(spark, "/tmp/burstline-no-such-file.json").count()


def test_only_the_needed_leaves_are_read(spark, sample):
    plan = src.load_posts(spark, sample)._jdf.queryExecution().executedPlan().toString()
    assert "geo_enabled" not in plan and "Python" not in plan


def test_trends_from_json(spark, sample):
    trends = trending(src.load_posts(spark, sample), interval="day", min_count=1, n=50)
    topics = {r["topic"] for r in trends.collect()}
    assert topics == {"sneeuw", "valt", "sneeuw valt", "winterpret", "#winterpret",
                      "winterpret #winterpret"}
