"""The Jaccard join and components against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from burstline.llm import jaccard
from burstline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size=5):
    sets = [shingle_set(t, size) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                root[find(i)] = find(j)
    big = 2**63
    least = defaultdict(lambda: big)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], big if d is None else d)
    return Counter(
        (d, len(sets[i]), None if least[find(i)] == big else least[find(i)])
        for i, (d, _) in enumerate(rows)
    )


def planted(seed):
    rng = np.random.default_rng(seed)
    words = [f"W{i}" if i % 5 else f"é{i}" for i in range(300)]

    def text(n):
        return [words[i] for i in rng.integers(0, 300, n)]

    rows, passage = [], text(60)
    for n in list(range(1, 30)) * 3 + [60, 90, 200, 400]:
        base = text(n)
        for _ in range(int(rng.integers(1, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 1 + max(1, n // 12)))):
                at = int(rng.integers(0, len(own)))
                kind = rng.integers(0, 3)
                if kind == 0:
                    own[at] = "edit"
                elif kind == 1:
                    own = own[:at] + own[at + 1 :] or ["rest"]
                else:
                    own.append(words[int(rng.integers(0, 300))])
            rows.append(" ".join(own) if rng.integers(0, 2) else "\n ".join(own).upper())
    for _ in range(40):  # one passage in otherwise different documents
        rows.append(" ".join(text(25) + passage + text(25)))
    rows += ["same words"] * 4 + [None, None, "", "  \n", "a b c d", "A B C D", "a b c"]
    ids = rng.permutation(len(rows)).tolist()
    out = [(None if i % 41 == 0 else ids[i], t) for i, t in enumerate(rows)]
    return out + out[:3] + [(5, "one id and another text that is long enough")]


SCHEMA = "doc_id long, text string, node string, n int"


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA).repartition(4)
    return Counter(map(tuple, jaccard.near_duplicates(docs).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = planted(seed)
    assert run(spark, rows) == brute(rows)


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Counter(map(tuple, jaccard.near_duplicates(docs).collect()))
    assert got == brute(rows)
    kept = jaccard.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for k in got if k[0] == k[2])


def test_one_row_of_each_component_stays(spark):
    a, b, c, d, e = ([f"{k}{i}" for i in range(40)] for k in "abcde")
    say = " ".join
    rows = [
        (1, say(a)), (2, say(a + ["x"])), (2, say(b)),  # 2 is linked to 1, and another text besides
        (3, say(b + ["x"])), (None, say(b + ["y"])), (None, say(a + ["z"])),
        (None, say(c)), (None, say(c + ["x"])), (None, say(c)),  # no id at all
        (4, say(d)), (4, say(d + ["x"])), (4, say(d)),  # one id, near texts, a repeated row
        (5, say(e)), (6, None), (6, ""), (None, " \n"), (None, " \n"),
    ]
    docs = spark.createDataFrame([(i, t, "clash", n % 2) for n, (i, t) in enumerate(rows)], SCHEMA)
    kept = jaccard.keep_one_each(docs.repartition(5)).collect()
    assert set(kept) <= set(docs.collect())
    worded = sorted(((r.doc_id, r.text.split()[0]) for r in kept if (r.text or "").split()), key=str)
    assert worded == [(1, "a0"), (2, "b0"), (4, "d0"), (5, "e0"), (None, "c0")]
    wordless = Counter((r.doc_id, r.text) for r in kept if not (r.text or "").split())
    assert wordless == {(6, None): 1, (6, ""): 1, (None, " \n"): 2}
    again = jaccard.keep_one_each(docs.repartition(3)).collect()
    assert Counter(kept) == Counter(again)


def test_one_row_stays_in_planted_components(spark):
    rows = planted(7)
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one_each(docs).collect()]
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 4 * len(s & sets[j]) >= 3 * len(s | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    first = {}
    for i, (d, t) in enumerate(rows):
        if sets[i]:
            first[root[i]] = min(first.get(root[i], 2**63), 2**63 if d is None else d)
    of_row = {(d, t): root[i] for i, (d, t) in enumerate(rows)}
    worded = [k for k in kept if shingle_set(k[1])]
    assert Counter(of_row[k] for k in worded) == dict.fromkeys(first, 1)
    assert all((2**63 if d is None else d) == first[of_row[d, t]] for d, t in worded)
    assert len(kept) - len(worded) == sum(1 for s in sets if not s)


def test_every_bound_of_light_sets(spark, monkeypatch):
    rows = planted(4)
    expected = brute(rows)
    for bound in (0, 5, 9):
        monkeypatch.setattr(jaccard, "light_bound", lambda sizes, bound=bound: bound)
        assert run(spark, rows) == expected


def test_light_bound_follows_the_cost():
    assert jaccard.light_bound({}) == 0
    assert jaccard.light_bound({4: 1000}) >= 4
    assert jaccard.light_bound({12: 1000}) < 12


def test_empty_table(spark):
    assert run(spark, []) == Counter()


def test_components(spark):
    rng = np.random.default_rng(0)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)]
    links += [tuple(map(int, p)) for p in rng.integers(200, 260, (40, 2))]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    root = {}
    for x in range(300):
        root[x] = x
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.node: r.root for r in found} == {
        x: root[x] for pair in links if pair[0] != pair[1] for x in pair
    }


def thue_morse(size, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(size))


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_polynomial_hashes_confuse_are_different(spark, size):
    rows = [(1, thue_morse(size)), (2, thue_morse(size, True)), (3, thue_morse(size))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 2, 3: 1}


def test_the_largest_id_is_no_null(spark):
    top = 2**63 - 1
    rows = [(top, "one two three four five six"), (None, "one two three four five six"), (None, "else"), (None, None)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sorted(((r.doc_id, r.component_id, r.n_shingles) for r in got.collect()), key=str)
    assert found == sorted([(top, top, 2), (None, top, 2), (None, None, 1), (None, None, 0)], key=str)


def edited_copies(seed, count, size=150, edits=(2, 3, 4, 5)):
    """Copies of one text that is in no row, each with its own edits."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        own = [f"w{k}" for k in range(size)]
        for at in rng.choice(size, int(rng.choice(edits)), replace=False):
            own[at] = f"edit{i}x{at}" if rng.integers(0, 4) else "same edit"
        rows.append((i, " ".join(own)))
    return rows


def test_near_copies_around_the_limit_are_not_compared_in_all_pairs(spark, monkeypatch):
    rows = edited_copies(3, 160)
    pairs, real = [], jaccard.compare

    def counted(given, sets):
        pairs.append(given.count())
        return real(given, sets)

    monkeypatch.setattr(jaccard, "compare", counted)
    assert run(spark, rows) == brute(rows)
    assert sum(pairs) < 160 * 20  # of 160 * 159 / 2


@pytest.mark.parametrize("close", [-1.0, 0.35, 1.0])
def test_pairs_by_difference_and_by_lists_lose_no_link(spark, monkeypatch, close):
    rows = edited_copies(5, 60, 80, (1, 2, 3)) + [
        (100 + d, t) for d, t in edited_copies(6, 60, 200, (4, 5, 6, 7))
    ] + [(None if d is None else 1000 + d, t) for d, t in planted(8)]
    monkeypatch.setattr(jaccard, "CLOSE", close)
    assert run(spark, rows) == brute(rows)
