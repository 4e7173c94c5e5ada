"""Language identification and the quality classifier."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from burstline.llm import langid, quality
from burstline.llm.queries import QUERIES
from burstline.llm.textbytes import flat

SF = "/root/testdata/sf0.01"


def brute_bits(training: bytes, text: bytes, order: int) -> float:
    """Code length of a text after one training text, from plain counts."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    padded = bytes(order) + training
    for i in range(order, len(padded)):
        for k in range(order + 1):
            counts[k][padded[i - k : i]][padded[i]] += 1
    total, padded = 0.0, bytes(order) + text
    for i in range(order, len(padded)):
        p = 1 / 256
        for k in range(order + 1):
            seen = counts[k].get(padded[i - k : i])
            if seen:
                mass = sum(seen.values()) + len(seen)
                hit = seen.get(padded[i])
                p = hit / mass if hit else p * len(seen) / mass
        total -= math.log2(p)
    return total


@pytest.mark.parametrize("order", [0, 1, 3])
def test_code_lengths_are_exact(order):
    training = {"x": "the cat sat on the mat. the end\n" * 3, "y": "öde äpfel überall und über"}
    counts = {
        lang: langid.count_grams(*flat(pa.array([t])), order) for lang, t in training.items()
    }
    model = langid.Model(counts, order)
    texts = ["the cat", "über", "", "zzz!", "öde mat\n" * 20]
    bits = model.code_lengths(*flat(pa.array(texts)))
    for i, lang in enumerate(model.languages):
        for j, text in enumerate(texts):
            expected = brute_bits(training[lang].encode(), text.encode(), order)
            assert bits[i, j] == pytest.approx(expected, rel=1e-5, abs=1e-6)


def test_language_edges(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(i, t * 9, x, "clash") for i, (t, x) in enumerate(
        [("the cat and the dog ", "en"), ("der hund und die katze ", "de")] * 20)]
    rows += [(90, None, "en", ""), (91, "12 !?", "de", ""), (92, "", None, ""), (None, "the cat", None, "")]
    rows += [(93, "und die katze " * 20000, None, "")]
    docs = spark.createDataFrame(rows, schema)
    model = langid.train(docs)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert len(got) == len(rows)
    assert [got[i].lang_pred for i in (0, 1, 90, 91, 92, None, 93)] == [
        "en", "de", "und", "und", "und", "en", "de"
    ]
    assert got[90].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    none = langid.train(docs.filter("lang = 'xx'"))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).collect() == []


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op4_language"](spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.98


def test_pairs_in_linear_time():
    rng = np.random.default_rng(0)
    machine = quality.Machine(
        0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, 3)),
        np.ones(quality.FEATURES),
    )
    feature = np.array([1, 5, 9, quality.WORD_BUCKETS + 2])
    value = np.array([0.2, 0.5, 1.0, 0.7])
    raw, _ = machine.parts(np.zeros(4, int), feature, value, 1)
    expected = 0.3 + (machine.weights[feature] * value).sum()
    for i in range(4):
        for j in range(i + 1, 4):
            pair = machine.factors[feature[i]] @ machine.factors[feature[j]]
            expected += pair * value[i] * value[j]
    assert raw[0] == pytest.approx(expected)


def test_features_of_odd_texts():
    row, feature, value = quality.features(pa.array(["", None, " \n", "A b! b\nA b! b", "é" * 50]))
    assert set(row.tolist()) == set(range(5)) and np.isfinite(value).all()
    empty = feature == quality.WORD_BUCKETS + quality.STATISTICS.index("empty")
    assert value[empty].tolist() == [1, 1, 0, 0, 0]
    repeated = feature == quality.WORD_BUCKETS + quality.STATISTICS.index("repeated_line")
    assert value[repeated][3] == 0  # the lines differ in their ends
    again = quality.features(pa.array(["A b! b\nA b! b"]))
    mine = row == 3
    for a, b in zip((feature[mine], value[mine]), again[1:]):
        assert sorted(a.tolist()) == sorted(b.tolist())


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op8_quality"](spark, SF)
    assert got.count() == 1000
    held = got.join(labels, "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)
    assert sum(r.predicted == r.quality for r in held) / len(held) >= 0.95


def test_quality_without_labels(spark):
    schema = "doc_id long, text string, score int"
    docs = spark.createDataFrame([(1, "a b", 0), (None, None, 0)], schema)
    labels = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int")
    machine = quality.train(docs, labels)
    assert [r.score for r in quality.score(docs, machine).collect()] == pytest.approx([0.5, 0.5])
    one = quality.train(docs, labels.selectExpr("doc_id", "1 AS quality", "toxic"))
    assert min(r.score for r in quality.score(docs, one).collect()) > 0.9
    assert quality.score(docs.limit(0), one).collect() == []
