import json

import pytest

from burstline import jobs


@pytest.fixture
def sample(tmp_path):
    path = tmp_path / "posts.json"
    with path.open("w") as out:
        for minute in range(6):
            out.write(json.dumps({
                "interaction": {"content": "storm harbour" if minute % 2 else "harbour"},
                "language": {"tag": "en"},
                "twitter": {"id": str(minute),
                            "created_at": f"Sat, 04 Feb 2012 09:0{minute}:00 +0000"},
            }) + "\n")
    return str(path)


def test_run(spark, sample, tmp_path, capfd):
    stored = jobs.run_trending(sample, str(tmp_path / "out"), spark=spark)
    rows = {r["topic"]: (r["count"], r["rank"]) for r in stored.collect()}
    assert rows == {"harbour": (6, 1), "storm": (3, 2), "storm harbour": (3, 3)}
    assert "harbour" in capfd.readouterr().out


def test_counters(spark, sample, tmp_path, caplog):
    with caplog.at_level("INFO", logger="burstline"):
        jobs.run_trending(sample, str(tmp_path / "out"), spark=spark)
    expected = {"read": 6, "dated": 6, "with_tokens": 6, "terms": 12, "trends": 3}
    assert str(expected) in caplog.text


@pytest.mark.parametrize("arguments", [
    {"input_path": None}, {"input_path": 7}, {"output_path": None}, {"n": 0}, {"n": "five"},
    {"n": True}, {"interval": "month"}, {"interval": None}, {"start_date": 2012},
    {"end_date": 2012}, {"start_date": "soon"}, {"min_count": 0},
])
def test_wrong_arguments_raise(spark, sample, tmp_path, arguments):
    given = {"input_path": sample, "output_path": str(tmp_path / "out"), "spark": spark}
    with pytest.raises(ValueError):
        jobs.run_trending(**(given | arguments))
    assert not (tmp_path / "out").exists()


def test_errors_are_not_swallowed(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.run_trending(str(tmp_path / "none.json"), str(tmp_path / "out"), spark=spark)
