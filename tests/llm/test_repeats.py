"""Substring operators against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from burstline.llm import recompression, suffixes
from burstline.llm.textbytes import mix

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_words(rows, window):
    """rows: (doc_id, text) -> multiset of (doc_id, n_words, n_removed, sha)."""
    split = [(d, WORD.findall((t or "").encode())) for d, t in rows]
    first = {}
    for d, w in split:
        rank = 2**63 - 1 if d is None else d
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, rank), rank)
    out = Counter()
    for d, w in split:
        rank = 2**63 - 1 if d is None else d
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < rank:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def brute_bytes(rows, length):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(hash(b[i : i + length]) for _, b in raw for i in range(len(b) - length + 1))
    out = Counter()
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[hash(b[i : i + length])] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def planted(seed=3):
    """Documents with shared, overlapping, periodic and nearly equal passages."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(400)]

    def text(n, v=400):
        return [vocabulary[i] for i in rng.integers(0, v, n)]

    passage, other = text(90), text(70)
    rows = []
    for d in range(40):
        words = text(int(rng.integers(0, 200)))
        if d % 3 == 0:
            a = int(rng.integers(0, 30))
            words += passage[a : a + int(rng.integers(45, 60))] + text(5)
        if d % 4 == 0:
            words += other
        if d % 5 == 0:
            words += other[:60] + ["same"] * int(rng.integers(10, 200))
        if d % 7 == 0:
            words += ["x", "y"] * 60
        rows.append((int(rng.integers(0, 10**12)) if d % 2 else d, " \t".join(words) + "\n"))
    base = text(300)
    for d in range(30):
        copy = list(base)
        copy[int(rng.integers(0, 300))] = "edit"
        rows.append((10**6 + d, " ".join(copy)))
    rows += [(77, " ".join(base))] * 3 + [(78, None), (None, " ".join(base)), (79, ""), (80, " \n ")]
    rows += [(None, "short text"), (81, "z" * 3000), (82, "z" * 900), (77, "another text of one id")]
    return rows


SCHEMA = "doc_id long, text string, uid string, spans int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("window", [50, 8])
def test_words_against_brute_force(spark, window):
    rows = planted()
    got = recompression.remove_repeats(frame(spark, rows), window)
    for row in got.collect():
        assert hashlib.sha256(row.kept_text.encode()).hexdigest() == row.kept_sha256
    got = Counter(map(tuple, got.drop("kept_text").collect()))
    assert got == brute_words(rows, window)
    assert sum(k[2] > 0 for k in got) > 20


@pytest.mark.parametrize("length", [400, 256])
def test_bytes_against_brute_force(spark, length):
    rows = planted()
    got = suffixes.remove_repeats(frame(spark, rows), length)
    got = Counter(map(tuple, got.drop("kept").collect()))
    assert got == brute_bytes(rows, length)
    assert sum(k[2] > 0 for k in got) > 20


def test_whole_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = recompression.remove_repeats(docs, 50, texts=False)
    assert Counter(map(tuple, got.collect())) == brute_words(rows, 50)
    got = suffixes.remove_repeats(docs, 400, texts=False)
    assert Counter(map(tuple, got.collect())) == brute_bytes(rows, 400)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert recompression.remove_repeats(empty).collect() == []
    assert suffixes.remove_repeats(empty).collect() == []


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    for kinds in (1, 2, 3, 40):
        base = rng.integers(0, kinds, 300)
        docs = []
        for _ in range(12):
            a = int(rng.integers(0, 250))
            docs.append(np.concatenate([
                rng.integers(0, kinds, int(rng.integers(0, 100))),
                base[a : a + int(rng.integers(10, 60))],
                rng.integers(0, kinds, int(rng.integers(0, 30))),
            ]))
        words = np.concatenate(docs)
        bounds = np.cumsum([0] + [len(d) for d in docs])
        seen = defaultdict(set)
        names = mix(words.astype(np.uint64) + np.uint64(7))
        for start, key, place in zip(*recompression.anchors(names, bounds, 20)):
            seen[tuple(words[start : start + 20])].add((int(key), int(place - start)))
            assert 0 <= place - start < 20
        assert all(len(x) == 1 for x in seen.values())


def test_suffix_arrays():
    rng = np.random.default_rng(1)
    for trial in range(120):
        kinds = int(rng.integers(1, 5))
        text = np.append(rng.integers(1, kinds + 1, int(rng.integers(1, 150))), 0)
        if trial % 5 == 0:
            text = np.append(np.tile(rng.integers(1, kinds + 1, 3), 40), 0)
        order = suffixes.suffix_array(text, kinds + 1)
        assert list(order) == sorted(range(len(text)), key=lambda i: list(text[i:]))
        most = (7, 1000)[trial % 2]
        shared = suffixes.permuted_prefixes(text, order, most)
        for a, b in zip(order[:-1], order[1:]):
            same = 0
            while max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            assert min(shared[b], most) == min(same, most)


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_polynomial_hashes_confuse_stay(spark, size):
    odd = ["".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(size)) for swap in (0, 1)]
    rest = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{rest} {odd[0]}"), (2, f"{rest} {odd[1]}")]
    got = recompression.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 50)
    assert {r.doc_id: r.n_removed for r in got.collect()} == {1: 0, 2: 60}


@pytest.mark.parametrize("remove, size", [(recompression.remove_repeats, 50), (suffixes.remove_repeats, 400)])
def test_rows_whose_nulls_change_places_are_different_texts(spark, remove, size):
    rows = [(1, None), (None, "1"), (2, "1 " * 700)]
    got = remove(spark.createDataFrame(rows, "doc_id long, text string"), size)
    assert sorted(r.doc_id or 0 for r in got.collect()) == [0, 1, 2]
