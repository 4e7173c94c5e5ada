"""The pipeline's stages, each on its own input."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from test_jaccard import brute as components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def texts(seed, n):
    import numpy as np

    rng = np.random.default_rng(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    return [" ".join(rng.choice(words, int(rng.integers(10, 60)))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(d, text, source="a"):
    return (d, text, "en", source, None if text is None else len(text), "clash")


def test_language_rejects_what_has_no_letters(spark):
    rows = [row(i, t) for i, t in enumerate(texts(1, 30))]
    docs = frame(spark, rows + [row(90, "12 34 !!"), row(91, None), row(92, "")])
    kept = pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(rows)
    assert pipeline.language(spark, docs.limit(0), "").collect() == []


def test_exact_copies(spark):
    a, b = texts(2, 2)
    rows = [row(1, a), row(2, f" {a} "), row(3, a.replace(" ", "")), row(4, b), row(5, b),
            row(6, None), row(7, " ")]
    docs = frame(spark, rows)
    kept = pipeline.exact_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 7]


def test_near_copies(spark):
    base = texts(3, 12)
    rows = [row(i, t) for i, t in enumerate(base)]
    rows += [row(100 + i, t + " more") for i, t in enumerate(base)]
    docs = frame(spark, rows)
    kept = pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    expected = components([(r[0], r[1]) for r in rows])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k[0] for k in expected if k[0] == k[2])


def test_mixture(spark):
    rows = [row(i, t, "abc"[i % 3]) for i, t in enumerate(texts(4, 60))]
    docs = frame(spark, rows)
    taken = pipeline.mixture(spark, docs, "")
    assert taken.columns == docs.columns
    times = Counter(map(tuple, taken.collect()))
    assert set(times) <= set(rows) and max(times.values()) <= 2
    sizes, mixed = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(r[1].split())
        mixed[r[3]] += times[r] * len(r[1].split())
    goal = {"a": min(2 * sizes["a"], 1.5 * sum(sizes.values()) * 5 / 8)}
    rest = 1.5 * sum(sizes.values()) - goal["a"]
    goal |= {"b": min(2 * sizes["b"], rest * 2 / 3)}
    goal |= {"c": rest - goal["b"]}
    assert all(abs(mixed[s] - goal[s]) <= 20 for s in goal)


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    assert [name for name, _ in pipeline.STAGES] == [
        "language", "exact_copies", "near_copies", "mixture", "packing"
    ]
    out = pipeline.run(spark, sf).collect()
    fill = defaultdict(list)
    for r in out:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
