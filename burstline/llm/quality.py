"""Quality scores by a factorisation machine.

A document is a sparse vector: the shares of its hashed words, statistics of its
structure, and its length as metadata. The score is a logistic function of

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

where the pairs are summed in time linear in the features, as half of
``|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.textbytes import SMALL_STEP, SPACE, flat, lowest_share, span_hash, steps, words

#: Buckets that words are hashed to; structure statistics follow them.
WORD_BUCKETS = 1 << 14
STATISTICS = (
    "upper", "digit", "mark", "space", "high", "line", "word_length", "long_word",
    "word_with_mark", "distinct", "top", "doubled", "size", "empty", "repeated_line", "words",
)
FEATURES = WORD_BUCKETS + len(STATISTICS)

_UPPER, _DIGIT, _MARK = np.zeros((3, 256), bool)
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _sum(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def features(texts: pa.Array):
    """Sparse rows of whole texts: row number, feature and value of each entry.

    A text without words has its statistics alone, and ``empty`` set.
    """
    data, offsets = flat(texts)
    n = len(offsets) - 1
    starts, ends, bounds = words(data, offsets)
    size, count = np.diff(offsets), np.diff(bounds)
    some, any_word = np.maximum(size, 1), np.maximum(count, 1)
    hashes = span_hash(data, starts, ends)
    row = np.repeat(np.arange(n), count)
    bucket = (hashes >> np.uint64(64 - (WORD_BUCKETS - 1).bit_length())).astype(np.int64)
    cell, times = np.unique(row * WORD_BUCKETS + bucket, return_counts=True)
    owner, feature = cell // WORD_BUCKETS, cell % WORD_BUCKETS
    share = times / any_word[owner]
    top = np.zeros(n)
    np.maximum.at(top, owner, share)
    kinds = np.bincount(owner, minlength=n)
    doubled = np.zeros(len(hashes), bool)
    doubled[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    length = ends - starts
    marks = _MARK[data]
    marked = np.concatenate([[0], np.cumsum(marks)])
    with_mark = marked[ends] > marked[starts]
    line_ends = np.flatnonzero(data == 10)
    cuts = np.unique(np.concatenate([offsets[:-1], line_ends + 1, offsets[-1:]]))
    line_row = np.searchsorted(offsets, cuts[:-1], "right") - 1
    lines = np.bincount(line_row, minlength=n)
    line_hash = span_hash(data, cuts[:-1], cuts[1:])
    distinct_lines = np.unique(np.stack([line_row.astype(np.uint64), line_hash], 1), axis=0)
    unlike = np.bincount(distinct_lines[:, 0].astype(np.int64), minlength=n)
    statistics = [
        _sum(_UPPER[data], offsets) / some, _sum(_DIGIT[data], offsets) / some,
        _sum(marks, offsets) / some, _sum(SPACE[data], offsets) / some,
        _sum(data > 127, offsets) / some, np.minimum(1, lines / any_word * 10),
        np.minimum(1, np.bincount(row, length, n) / any_word / 20),
        np.bincount(row, length > 20, n) / any_word, np.bincount(row, with_mark, n) / any_word,
        kinds / any_word, top, np.bincount(row, doubled, n) / any_word,
        np.log1p(size) / 16, size == 0, 1 - unlike / np.maximum(lines, 1), np.log1p(count) / 16,
    ]
    values = np.array(statistics, np.float64)
    return (
        np.concatenate([owner, np.tile(np.arange(n), len(values))]),
        np.concatenate([feature, np.repeat(WORD_BUCKETS + np.arange(len(values)), n)]),
        np.concatenate([np.sqrt(share), values.ravel()]),
    )


@dataclass
class Machine:
    """Parameters of a fitted machine."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    scale: np.ndarray

    def parts(self, row, feature, value, n: int):
        """The raw score of each row and its sums of factors."""
        value = value * self.scale[feature]
        linear = np.bincount(row, self.weights[feature] * value, n)
        sums, squares = np.zeros((2, n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            each = self.factors[feature, f] * value
            sums[:, f] = np.bincount(row, each, n)
            squares[:, f] = np.bincount(row, each * each, n)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(1), sums

    def score(self, row, feature, value, n: int) -> np.ndarray:
        raw, _ = self.parts(row, feature, value, n)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(row, feature, value, labels: np.ndarray, rank: int = 4, rounds: int = 60,
        step: float = 0.08, shrink: float = 1e-3, seed: int = 5) -> Machine:
    """Fit by gradient steps over mini-batches, each step scaled per parameter.

    Both labels count the same in total. With no row or one label only, the
    machine scores every document by the mean label.
    """
    random = np.random.default_rng(seed)
    scale = np.ones(FEATURES)
    squares = np.bincount(feature, value * value, FEATURES) / max(1, len(labels))
    statistic = np.arange(FEATURES) >= WORD_BUCKETS
    scale[statistic] = 1 / np.sqrt(squares[statistic] + 1e-4)
    machine = Machine(0.0, np.zeros(FEATURES), random.normal(0, 0.02, (FEATURES, rank)), scale)
    mean = labels.mean() if len(labels) else 0.5
    if mean in (0, 1) or not len(labels):
        machine.factors[:] = 0
        machine.bias = float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
        return machine
    importance = np.where(labels == 1, 0.5 / mean, 0.5 / (1 - mean))
    order = np.argsort(row, kind="stable")
    row, feature, value = row[order], feature[order], value[order]
    begin = np.searchsorted(row, np.arange(len(labels) + 1))
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-3), np.full((FEATURES, rank), 1e-3), 1e-3
    for _ in range(rounds):
        for batch in np.array_split(random.permutation(len(labels)), max(1, len(labels) // 256)):
            size = begin[batch + 1] - begin[batch]
            take = np.repeat(begin[batch] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            r, f, v = np.repeat(np.arange(len(batch)), size), feature[take], value[take]
            raw, sums = machine.parts(r, f, v, len(batch))
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) * importance[batch]
            error /= len(batch)
            x = v * scale[f]
            used, slot = np.unique(f, return_inverse=True)
            slope = np.bincount(slot, error[r] * x) + shrink * machine.weights[used] / len(batch)
            seen_w[used] += slope**2
            machine.weights[used] -= step * slope / np.sqrt(seen_w[used])
            for k in range(rank):
                own = machine.factors[:, k]
                each = error[r] * (x * sums[r, k] - own[f] * x * x)
                slope = np.bincount(slot, each) + shrink * own[used] / len(batch)
                seen_v[used, k] += slope**2
                machine.factors[used, k] -= step * slope / np.sqrt(seen_v[used, k])
            seen_b += error.sum() ** 2
            machine.bias -= step * error.sum() / np.sqrt(seen_b)
    return machine


def train(
    docs: DataFrame, labels: DataFrame, sample_docs: int = 4000, seed: int = 3, **options
) -> Machine:
    """Fit on the documents that ``labels`` marks with a ``quality`` of 0 or 1.

    The machine is fitted on a bounded sample: of each label about
    ``sample_docs`` documents, those whose hash of id and seed lies below the
    share that makes so many. Rows without a label are left out; a null text
    counts as empty. Features are made where the rows are; only they come to the
    driver. The sampled ids, twice ``sample_docs`` at most, are broadcast.
    """
    marked = labels.filter(F.col("quality").isin(0, 1)).select(
        "doc_id", F.col("quality").cast("int").alias("quality"),
        F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)).alias("hash"),
    )
    counts = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}
    below = F.lit(False)
    for q, n in counts.items():
        below |= (F.col("quality") == q) & lowest_share(F.col("hash"), sample_docs / n)
    sample = F.broadcast(marked.filter(below).withColumnRenamed("doc_id", "_id"))
    rows = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("_id"))
    sample = rows.select("quality", "text", "hash")

    def vectors(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            row, feature, value = features(batch.column("text"))
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            feature, value = feature[order].astype(np.int32), value[order].astype(np.float32)
            packed = [
                (feature[a:b].tobytes(), value[a:b].tobytes())
                for a, b in zip(cut[:-1], cut[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), batch.column("hash"),
                 pa.array([p[0] for p in packed], pa.binary()),
                 pa.array([p[1] for p in packed], pa.binary())],
                ["quality", "hash", "feature", "value"],
            )

    made = sample.mapInArrow(vectors, "quality int, hash long, feature binary, value binary")
    found: pd.DataFrame = made.toPandas().sort_values(["hash", "quality"], ignore_index=True)
    feature = [np.frombuffer(x, np.int32) for x in found["feature"]]
    value = [np.frombuffer(x, np.float32) for x in found["value"]]
    row = np.repeat(np.arange(len(found)), [len(x) for x in feature])
    return fit(
        row, np.concatenate([*feature, np.empty(0, np.int32)]).astype(np.int64),
        np.concatenate([*value, np.empty(0, np.float32)]).astype(np.float64),
        found["quality"].to_numpy(np.float64), **options,
    )


def score(docs: DataFrame, machine: Machine, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` to the columns ``keep``.

    Every whole text is scored, empty and null ones by their statistics.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches, "burstline_text", SMALL_STEP):
            scores = shared.value.score(*features(batch.column("burstline_text")), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [*keep, "score", "predicted"],
            )

    rows = docs.select(*keep, F.col("text").alias("burstline_text"))
    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
