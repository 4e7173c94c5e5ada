"""Source divergence against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstline.llm import divergence, wordkeys

SCHEMA = "doc_id long, text string, lang string, source string, term string, count int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least_docs, most):
    docs = [((r[1] or "").translate(LOWER), r[2] or "", r[3] or "") for r in rows]
    seen, uses, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        found = TERM.findall(text)
        groups[lang].add(source)
        seen[lang].update(set(found))
        uses[lang, source].update(found)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= least_docs)
        whole = Counter()
        for s in sources:
            whole.update({t: uses[lang, s][t] for t in kept})

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(uses[lang, s]) for s in sources}
        for s in sources:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            own = [(q[t] - p[s][t], t.encode(), t) for t in kept if uses[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(own)[:most])):
                for i, (value, _, item) in enumerate(found):
                    out.add((lang, s, part, item, -value, i + 1))
    return out


def rows_of(rng, n, sources, words):
    names = [f"s{i}" for i in range(sources)] + [None, ""]
    pool = [f"{w}{c}" for w in words for c in ("", "x", "É", "中")]
    return [
        (
            rng.choice([1, 2, None]),
            rng.choice([None, ""] + [" ".join(rng.choices(pool, k=rng.randrange(1, 30))) for _ in range(6)]),
            rng.choice(["en", "de", None, "xx"]) if i else "lone", rng.choice(names), "t", 1,
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", 20)
    monkeypatch.setattr(divergence, "TILE", 2)
    rng = random.Random(seed)
    rows = rows_of(rng, 60, 4, ["Apple", "b-c", "don't", "x9y", "ZZ"])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = divergence.divergence(df, least_docs=3, most_terms=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_force(rows, 3, 4)


def test_ties_are_cut_in_utf8_order(spark):
    words = ["\U0001f600a", "￿a", "za", "zb", "ya"]
    rows = [(i, w, "en", "a", None, None) for i, w in enumerate(words)] + [(9, "common words", "en", "b", None, None)]
    got = divergence.divergence(spark.createDataFrame(rows, SCHEMA), least_docs=1, most_terms=4)
    terms = got.filter("part = 'term' and source = 'a'").orderBy("rank").collect()
    assert [r.item for r in terms] == sorted(words, key=str.encode)[:4]
    assert len({r.value for r in terms}) == 1


def test_no_kept_term_and_no_row(spark):
    rows = [(1, "one", "en", "a", None, None), (2, None, "en", "b", None, None)]
    got = divergence.divergence(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_very_long_text(spark):
    rows = [(1, "aB" * 700_000 + " " + "word Word " * 200_000, "en", "a", None, None), (2, "word", "en", "b", None, None)]
    got = divergence.divergence(spark.createDataFrame(rows, SCHEMA), least_docs=1)
    assert {tuple(r) for r in got.collect()} == brute_force(rows, 1, 50)


def test_shares_beyond_64_bits(spark):
    big = 9 * 10**13
    df = spark.createDataFrame([(big, big + 7, 3)], "c long, n long, v long")
    got = df.select(divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (big + 5) // (big + 7 + 15)


def test_words_that_share_a_key_are_told_apart(monkeypatch):
    texts = ["same", "else", "same", "a" * 100, "b" * 100, "a" * 100]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    real, salts = wordkeys.word_keys, []

    def weak(data, starts, ends, salt=0):
        salts.append(salt)
        return real(data, starts, ends, salt) if salt > 2 else np.zeros(len(starts), np.uint64)

    monkeypatch.setattr(wordkeys, "word_keys", weak)
    number, sample = wordkeys.number_words(data, starts, ends, np.zeros(len(texts), np.int64))
    assert salts == [1, 2, 3] and len(sample) == 4
    assert number[0] == number[2] and number[3] == number[5] and len(set(number.tolist())) == 4
