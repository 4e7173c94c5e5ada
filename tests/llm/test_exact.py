"""Exact de-duplication, its codes, and the exchange."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from burstline.llm import exact

SCHEMA = "doc_id long, text string, sha string, keep_id int"


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups[body].append((-len(t or ""), d is None, d or 0, d))
    out = Counter()
    for body, members in groups.items():
        best = min(members)
        for n, _, _, d in members:
            kept = d == best[3] and n == best[0]
            sha = hashlib.sha256(body.encode()).hexdigest()
            out[d, best[3], len(members), kept, sha] += 1
    return out


def rows():
    rng = np.random.default_rng(1)
    base = ["".join(rng.choice(list("abcé \n\t"), int(rng.integers(0, 12)))) for _ in range(150)]
    out = [(int(d), t) for d, t in zip(rng.permutation(150), base)]
    out += [(1000 + i, "hot  text") for i in range(300)] + [(2000, "h o t t e x t")]
    out += [(None, "hottext"), (None, None), (3000, None), (3001, ""), (3002, " \x0b\x0c"), (7, "lone" * 9000)]
    return out + [(1, "same"), (1, "same"), (1, "sa me"), (4000, "a b"), (4001, "a b")]


@pytest.mark.parametrize("chunks", [1, 13])
def test_against_brute_force(spark, chunks):
    docs = spark.createDataFrame([(d, t, "x", 0) for d, t in rows()], SCHEMA).repartition(6)
    got = exact.duplicate_groups(docs, chunks)
    assert Counter(map(tuple, got.collect())) == brute(rows())


def test_keep_first_copies(spark):
    docs = spark.createDataFrame([(d, t, "x", 0) for d, t in rows()], SCHEMA)
    kept = exact.keep_first_copies(docs)
    assert kept.columns == docs.columns
    expected = {(k[0], k[4]) for k in brute(rows()) if k[3]}
    assert len(kept.collect()) >= len(expected)
    assert {r.doc_id for r in kept.collect()} == {k[0] for k in expected}


def test_one_row_of_each_text_stays(spark):
    docs = spark.createDataFrame([(d, t, str(i % 2), i % 3) for i, (d, t) in enumerate(rows())], SCHEMA)
    odd = [(8, "twice told", "x", 0)] * 3 + [(None, "no id", "x", i) for i in range(50)]
    odd += [(9, "w h ite", "x", 0), (9, "wh i te", "x", 0), (9, "white", "x", 0)]
    docs = docs.unionAll(spark.createDataFrame(odd, SCHEMA))
    every = docs.unionAll(docs)  # a table that was delivered twice
    kept = exact.keep_first_copies(every.repartition(7)).collect()
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept]
    source = docs.collect()
    assert Counter(bodies) == {re.sub(r"[\x20\x09-\x0D]", "", r.text or ""): 1 for r in source}
    assert set(kept) <= set(source)
    expected = {(k[1], k[4]) for k in brute([(r.doc_id, r.text) for r in source])}
    assert {(r.doc_id, hashlib.sha256(b.encode()).hexdigest()) for r, b in zip(kept, bodies)} == expected
    assert len(next(r for r in kept if r.doc_id == 9).text) == 7
    again = exact.keep_first_copies(every.repartition(3)).collect()
    assert Counter(kept) == Counter(again)


def test_maps_and_odd_columns_pass(spark):
    docs = spark.createDataFrame(
        [(None, "a b", {"k": 1}, 5), (None, "ab", {"k": 2}, 6), (1, "c", None, 7)],
        "doc_id long, text string, row map<string, int>, name int",
    )
    kept = exact.keep_first_copies(docs.unionAll(docs))
    assert kept.columns == docs.columns
    assert sorted((r.text, r.name) for r in kept.collect()) == [("a b", 5), ("c", 7)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.duplicate_groups(empty).collect() == []
    assert exact.keep_first_copies(empty).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000])
@pytest.mark.parametrize("top", [1, 2**20, 2**64])
def test_rice_round_trip(n, top):
    values = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64)
    values = np.sort(values)
    assert (exact.rice_decode(exact.rice_encode(values)) == values).all()


def test_rice_code_is_small():
    values = np.sort(np.random.default_rng(0).integers(0, 2**40, 4096, dtype=np.uint64))
    assert len(exact.rice_encode(values)) < 4096 * 4 < 4096 * 8


def test_suspects_are_the_repeated_prints(spark):
    prints = [(p, c) for c in range(5) for p in range(c * 10, c * 10 + 15)] + [(99, 2), (99, 2)]
    df = spark.createDataFrame([(p * 2**56 - 2**62, c) for p, c in prints], "print long, chunk int")
    got = exact.suspect_prints(df, 3, 5)
    counts = Counter(p for p, _ in prints)
    expected = {p * 2**56 - 2**62 for p, n in counts.items() if n > 1}
    assert {r.print for r in got.collect()} == expected
