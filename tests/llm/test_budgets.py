"""Mixing to targets and packing into sequences."""

import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from burstline.llm import mixing, packing

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, size string, length int"


def water_level(sizes, share=1.5, weights=(5, 2, 1), most=2):
    """Targets by repeated dealing; sizes in the order of their sources."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    rest = share * sum(sizes)
    while open_:
        level = rest / sum(w[i] for i in open_)
        full = {i for i in open_ if most * sizes[i] <= level * w[i]}
        for i in full:
            target[i] = most * sizes[i]
        rest -= sum(target[i] for i in full)
        open_ -= full
        if not full:
            for i in open_:
                target[i] = level * w[i]
            break
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5, 7, 300], [0, 0], [0, 8], [5], [3, 100, 100, 2]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", s) for i, s in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long"))
    got = {r.source: r.target for r in got.collect()}
    assert [got[s] for s, _ in rows] == pytest.approx(water_level(sizes))


def test_sources_are_ordered_by_code_point_null_last(spark):
    rows = [(None, 100), ("\U0001f600", 100), ("￿", 100), ("B", 100), ("a", 100)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long"))
    got = {r.source: r.target for r in got.collect()}
    order = ["B", "a", "￿", "\U0001f600", None]
    assert [got[s] for s in order] == pytest.approx(water_level([100] * 5))


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        lengths = np.unique(rng.integers(0, 15, int(rng.integers(1, 5))))
        counts = rng.integers(0, 4, len(lengths))
        budget = int(rng.integers(0, 60))
        taken = mixing.bounded_knapsack(lengths, counts, budget)
        assert (taken <= counts).all() and (taken >= 0).all()
        best = max(
            s for c in itertools.product(*(range(k + 1) for k in counts))
            if (s := int((np.array(c) * lengths).sum())) <= budget
        )
        assert int((taken * lengths).sum()) == best


def test_fit_meets_large_budgets():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.lognormal(6, 1.2, 4000).astype(int))
    counts = rng.integers(1, 900, len(lengths))
    size = int((lengths * counts).sum())
    for share in (0.0, 0.01, 0.37, 0.999):
        taken = mixing.fit(lengths, counts, share * size)
        assert (taken <= counts).all()
        assert abs(int((taken * lengths).sum()) - share * size) <= 1


def nearest(lengths, counts, budget, most):
    sums = {0}
    for x, n in zip(lengths, counts):
        sums = {s + k * int(x) for s in sums for k in range(int(n) + 1)}
    return min(abs(s - budget) for s in sums if s <= most)


@pytest.mark.parametrize("lengths, counts, budget, total", [
    ([200000, 201000], [1, 1], 250000, 201000),
    ([120000, 100000, 99000], [1, 1, 1], 199000, 199000),
    ([300000, 700000], [1, 1], 680000, 700000),  # the nearest sum is above the budget
    ([150000, 270000], [2, 1], 285000, 270000),  # the share of the first is handed back
    ([60000, 150000, 260000], [1, 2, 1], 318000, 320000),
    ([0, 900000], [5, 3], 1000000, 900000),
    ([400000, 500000], [1, 1], 100000, 0),
])
def test_fit_of_few_long_documents(lengths, counts, budget, total):
    lengths, counts = np.array(lengths), np.array(counts)
    taken = mixing.fit(lengths, counts, budget)
    assert (taken <= counts).all() and (taken >= 0).all()
    assert int((taken * lengths).sum()) == total


def test_fit_is_nearest():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 400, int(rng.integers(1, 7)))) * int(rng.choice([1, 6, 1000, 3001]))
        counts = rng.integers(1, 4, len(lengths))
        size = int((lengths * counts).sum())
        budget = int(rng.integers(1, size))
        most = int(rng.choice([budget, budget + size // 50, size]))
        taken = mixing.fit(lengths, counts, budget, most)
        assert (taken <= counts).all() and (taken >= 0).all()
        total = int((taken * lengths).sum())
        assert total <= most
        assert abs(total - budget) == nearest(lengths, counts, budget, most)


def test_fit_of_many_long_documents():
    rng = np.random.default_rng(6)
    lengths = np.unique(rng.integers(70000, 400000, 500))
    size = int(lengths.sum())
    for share in (0.001, 0.1, 0.37, 0.9):
        taken = mixing.fit(lengths, np.ones(len(lengths), np.int64), share * size)
        total = int((taken * lengths).sum())
        assert abs(total - share * size) <= (1 if share > 0.01 else 70000)


def test_mix_of_long_documents(spark):
    rows = [(1, "w " * 200000, "a"), (2, "w " * 201000, "a"), (3, "w " * 300000, "b")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert got[1].target == pytest.approx(1051500 * 5 / 7) and got[3].target == pytest.approx(1051500 * 2 / 7)
    # 350071 of 401000 more than a whole round and 300429 of 300000
    assert [got[i].copies for i in (1, 2, 3)] == [2, 2, 1]


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_mix(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(0, 80)), ["a", "b", None][i % 3]) for i in range(400)]
    rows += [(1000 + i, "hot words here", "a") for i in range(300)]
    rows += [(5000, None, "c"), (None, "x\x0by\x0cz q", "a"), (1, "same id", "b"), (1, "same id", "b")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = mixing.mix(docs.repartition(5)).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), words(t)) for d, t, _ in rows)
    names = ["a", "b", "c", None]
    sizes = [sum(words(t) for _, t, s in rows if s == name) for name in names]
    expected = dict(zip(names, water_level(sizes)))
    taken = defaultdict(int)
    for r in got:
        assert r.taken == r.copies * r.size <= 2 * r.size
        assert r.target == pytest.approx(expected[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 2 for s in names)
    assert mixing.mix(docs.limit(0)).collect() == []


ODD = ["", None, "it's Bob's 'twas don't!! a.'s b'll.x", "ΑΣ ΣΑΣ. İstanbul ÅÉ é 12ab", "  \t\n ",
       "<|endoftext|> a<|endoftext|>b", "中文 字。hello!世界", "I'VE'RE '' s't", "--- ... .'s 's. .\"'s",
       "\x0b\x0c\x1c\x85 x y", "a" * 5000, "é ́ क्षि ﬁ"]


def test_ids_equal_the_tokenizers():
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    ids, offsets = packing.WordTokenizer(PATH).encode(pa.array(ODD, pa.string()))
    for i, text in enumerate(ODD):
        expected = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids[offsets[i] : offsets[i + 1]].tolist() == expected, text


def check(got, texts, most):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for d, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[d], key=lambda r: r.piece)
        assert [r.start for r in pieces] == list(range(0, len(ids), most))
        for r in pieces:
            part = np.array(ids[r.start : r.start + most], "<u4")
            assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return len(by_sequence), -(-sum(r.length for r in got) // most)


def test_packing_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    used, least = check(packing.packed(docs, PATH).collect(), texts, 4096)
    assert used <= 1.01 * least + 1


def test_packing_odd_texts(spark):
    rows = [(i, t, None, "clash", 1) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = packing.packed(docs, PATH, most=16, ids=True).collect()
    check(got, dict(enumerate(ODD)), 16)
    assert all(len(r.token_ids) == r.length for r in got)
    twice = packing.packed(docs.unionAll(docs), PATH, most=16).collect()
    assert len(twice) == 2 * len(got)
    assert packing.packed(docs.limit(0), PATH).collect() == []


def test_sum_of_squares_rule():
    lengths = np.array([9, 6, 6, 4, 3, 1, 1, 10])
    sequence, offset = packing.sum_of_squares(lengths, 10)
    fill = defaultdict(list)
    for s, o, n in zip(sequence, offset, lengths):
        fill[s].append((o, n))
    assert all(sum(n for _, n in parts) <= 10 for parts in fill.values())
    # each choice against all choices by the definition
    gaps, used = {}, 0
    for n, own in zip(lengths.tolist(), sequence.tolist()):
        def squares(gap, rest):
            state = [g for g in gaps.values() if 0 < g]
            if gap != 10:
                state.remove(gap)
            count = defaultdict(int)
            for g in state + ([rest] if rest else []):
                count[g] += 1
            return sum(c * c for c in count.values())

        options = {g: squares(g, g - n) for g in {*gaps.values(), 10} if g >= n}
        chosen = gaps.get(own, 10)
        assert options[chosen] == min(options.values())
        gaps[own] = chosen - n


def test_rows_whose_nulls_change_places_are_different_rows(spark):
    rows = [(1, None, "a"), (1, "a", None), (None, "1", "a"), (1, "x y", "b"), (1, "x y", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = {}
    for r in mixing.mix(docs).collect():
        copies[r["doc_id"], r["source"], r["size"]] = copies.get((r["doc_id"], r["source"], r["size"]), 0) + r["copies"]
    got = {}
    for r in mixing.mixed_rows(docs).collect():
        own = (r["doc_id"], r["source"], len((r["text"] or "").split()))
        got[own] = got.get(own, 0) + 1
    assert got == {k: n for k, n in copies.items() if n}
