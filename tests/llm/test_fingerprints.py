"""Sketches against set arithmetic, and the edited texts against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from burstline.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, uid string, next int"


def paragraphs(text):
    # Java splits off no empty first piece here; empty pieces are dropped anyway
    return {p for p in re.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+|\n", text) if p}


def alike(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return 1.0 if not a | b else len(a & b) / len(a | b)


def brute(rows):
    """(doc_id, text) with distinct, non-null ids -> expected results by id."""
    rows = sorted((d, t or "") for d, t in rows)
    out = {}
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        out[d] = (
            len(t), hashlib.sha256(edited.encode()).hexdigest(), alike(t, edited),
            alike(t, after), len(paragraphs(t) ^ paragraphs(edited)),
        )
    return out


def check(got, expected):
    assert len(got) == len(expected)
    for r in got:
        n, sha, near_edited, near_next, differing = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.n_differing) == (n, sha, differing)
        assert r.near_edited == pytest.approx(near_edited)
        assert r.near_next == pytest.approx(near_next)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = fp.edited_likeness(docs)
    nodes = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in nodes and "Pandas" not in nodes and "Arrow" not in nodes
    check(got.collect(), brute(rows))


def test_small_and_odd_texts(spark):
    rows = [(3, "one"), (5, None), (9, ""), (11, "é.\nü! ö"), (12, "a. " * 900), (20, "\n\n \n"),
            (21, ". ".join(f"part {i}" for i in range(1500))), (22, "one"), (-4, "x")]
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA)
    got = fp.edited_likeness(docs).collect()
    check(got, brute(rows))
    own = {r.doc_id: r for r in got}
    assert own[3].fingerprint == own[22].fingerprint
    assert own[5].fingerprint == own[9].fingerprint != own[20].fingerprint
    assert own[21].n_differing_next == 1501


def test_null_repeated_and_lone_ids(spark):
    rows = [(None, "a. b"), (None, "c"), (1, "same. text"), (1, "same. text"), (1, "other")]
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA)
    got = fp.edited_likeness(docs).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == ["1", "1", "1", "None", "None"]
    assert len({r for r in got if r.n_chars == len("same. text")}) == 1
    one = fp.edited_likeness(docs.filter("text = 'c'")).collect()
    assert [(r.near_edited, r.near_next) for r in one] == [(1.0, 1.0)]
    assert fp.edited_likeness(docs.limit(0)).collect() == []


def test_peeling_recovers_digests(spark):
    sets = [([1, 2, 3], [2, 3, 4]), (list(range(400)), list(range(200, 700))), ([], [5]), ([], [])]
    df = spark.createDataFrame(sets, "a array<long>, b array<long>")
    df = df.withColumn("ca", fp.sketch(F.col("a"))).withColumn("cb", fp.sketch(F.col("b")))
    df = df.withColumn("d", fp.differing(F.col("a"), F.col("b"), F.col("ca"), F.col("cb")))
    for r in df.collect():
        a, b = set(r.a), set(r.b)
        assert sorted((x.k, x.s) for x in r.d) == sorted(
            [(k, 1) for k in a - b] + [(k, -1) for k in b - a]
        )


def test_text_form_round_trip(spark):
    df = spark.createDataFrame([(list(range(30)),), ([],), ([-(2**63), 2**63 - 1],)], "a array<long>")
    df = df.withColumn("c", fp.sketch(F.col("a")))
    df = df.withColumn("back", fp.parse(fp.render(F.col("a"), F.col("c"))))
    assert all(r.c == r.back for r in df.collect())


def test_each_given_text_is_cut_once(spark):
    """The next document brings its digests and its sketch instead of being cut again."""
    df = spark.createDataFrame([(i, f"One {i}. Two. Three {i % 3}.") for i in range(40)], "doc_id long, text string")
    result = fp.edited_likeness(df)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("split(") == 2  # the texts, and the edited ones
