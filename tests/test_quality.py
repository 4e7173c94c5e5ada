from datetime import datetime

from burstline.operators import terms
from burstline.plans import quality
from burstline.plans.trending import trending
from conftest import plan_of

GOOD = "Sat, 04 Feb 2012 09:38:03 +0000"
ROWS = [
    ("1", "fine text", "en", GOOD),
    ("1", "fine text", "en", GOOD),
    ("2", None, "nl", GOOD),
    ("3", "  ", "nl", "soon"),
    ("4", "text", "tlh", None),
    ("5", "text", None, GOOD),
]


def posts(spark, rows=ROWS):
    return spark.createDataFrame(
        rows, "post_id string, text string, lang string, created_at string"
    )


def test_report(spark):
    report = quality.dq_report(posts(spark), ("en", "nl"))
    got = {r["check_name"]: (r["total"], r["failed"]) for r in report.collect()}
    assert got == {
        "text_present": (6, 1), "text_not_blank": (6, 1), "lang_present": (6, 1),
        "lang_accepted": (6, 1), "created_at_present": (6, 1), "created_at_parses": (6, 1),
        "post_id_unique": (6, 1),
    }
    empty = quality.dq_report(posts(spark, []), ("en",)).collect()
    assert all(r["total"] == 0 and r["failed"] == 0 and r["ratio"] is None for r in empty)


def test_report_reads_once(spark):
    assert plan_of(quality.dq_report(posts(spark), ("en",))).count("Scan") == 1


def test_quarantine_splits_all_rows(spark):
    marked = quality.with_verdict(posts(spark), ("en", "nl")).collect()
    assert [r["post_id"] for r in marked if r["verdict"] == "accepted"] == ["1", "1"]
    assert sorted(r["post_id"] for r in marked if r["verdict"] == "rejected") == ["2", "3", "4", "5"]


def test_normalise(spark):
    rows = [("1", " Text ", " EN ", GOOD), ("2", None, None, "x")]
    got = [tuple(r) for r in quality.normalise_columns(posts(spark, rows)).collect()]
    assert got == [("1", "Text", "en", datetime(2012, 2, 4, 9, 38, 3)),
                   ("2", "", "unknown", None)]


def test_stage_counts(spark):
    prepared = spark.createDataFrame(
        [("1", "en", datetime(2012, 2, 4), "storm harbour"), ("2", "en", datetime(2012, 2, 4), "")],
        "post_id string, lang string, created_at timestamp, cleaned_text string",
    )
    counts = quality.stage_counts(posts(spark), trending(prepared, min_count=1))
    got = {r["stage"]: r["rows"] for r in counts.collect()}
    assert got == {"read": 6, "dated": 4, "with_tokens": 3, "terms": 7, "trends": 3}
