"""Phrase mining against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstline.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, a int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least, most):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in cands.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        found = []
        for p, a in cands.items():
            if 100 * inside[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            text = " ".join(p)
            found.append((-score, -a, text.encode(), text, counts[p[:k]], counts[p[k:]]))
        for i, (score, a, _, text, left, right) in enumerate(sorted(found)[:most]):
            out.add((lang, i + 1, text, -a, left, right, n[lang], -score))
    return out


def rows_of(rng, n, vocabulary):
    marks = [" ", " ", " ", "\t", "  ", ". ", ", ", "\n", " ? ", "!", ";", "\r"]
    return [
        (
            rng.choice([1, None]),
            rng.choice([None, ""] + ["".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(40))] * 8),
            rng.choice(["en", "en", "de", None, "xx"]), "p", 1,
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("budget", [1, 40, 1 << 20])
def test_against_brute_force(spark, budget):
    rng = random.Random(budget)
    vocabulary = ["The"] * 6 + ["of"] * 4 + ["a-b", "É", "é", "x", "y", "中文", "\U0001f600", "￿", "don't"]
    rows = rows_of(rng, 80, vocabulary)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = collocations.collocations(df, least=3, most=25, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_force(rows, 3, 25)


def test_prefixes_are_extended_down_to_four_words(spark):
    rows = [(1, "a b c d " * 50 + ". e f", "en", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).select("text", "lang")
    surveyed = collocations.survey(docs, 0).filter("cell >= 0")
    groups = collocations.grouped(docs, surveyed, 0, 10)
    assert set(groups.words.values()) == {2, 3, 4}
    got = collocations.collocations(docs, least=3, budget=10).collect()
    assert {tuple(r) for r in got} == brute_force(rows, 3, 2000)


def test_repeats_ties_and_one_very_long_text(spark):
    rows = [(i % 3, "same words here. same words here", "en", None, None) for i in range(40)]
    rows += [(7, "x" * 500_000 + " " + "one two " * 300_000, "de", None, None)]
    rows += [(8, f"{w} {w}{w}", "en", None, None) for w in "zyx\U0001f600￿" for _ in range(3)]
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), least=3, most=4, budget=1000)
    assert {tuple(r) for r in got.collect()} == brute_force(rows, 3, 4)


def test_nothing(spark):
    for rows in ([], [(1, None, None, None, None)], [(1, " . , ", "en", None, None)]):
        assert collocations.collocations(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_words_with_one_key_get_other_keys(spark, monkeypatch):
    real, salts = collocations.survey, []

    def weak(docs, salt):
        salts.append(salt)
        found = real(docs, salt)
        return found if salt else found.withColumn("key", F.lit(1).cast("long"))

    monkeypatch.setattr(collocations, "survey", weak)
    rows = [(1, "one two. " * 5 + "two three. " * 4, "en", None, None)]
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), least=3)
    assert {tuple(r) for r in got.collect()} == brute_force(rows, 3, 2000)
    assert salts == [0, 1]


def test_counts_beyond_64_bit_products():
    keys = np.array([5, 9], np.uint64)
    words = np.array([[1, 2, 0, 0]], np.uint64)
    packed = [collocations._packed(words, np.array([0]), np.array([4_000_000_000]), keys) for _ in range(3)]
    nodes = collocations.subtrees(packed, 2, 1)
    assert nodes[["w1", "w2", "w3", "w4", "a", "part"]].values.tolist() == [[5, 9, 0, 0, 12_000_000_000, False]]
