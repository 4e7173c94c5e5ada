"""Substring de-duplication by recompression.

Words get global names, hashes of their content. A round replaces every maximal
run of one symbol by the name of (symbol, length), then splits the symbols in
two classes by their names and replaces every pair of a left symbol followed by a
right one by the name of the pair. As a name is a hash of what it stands for,
equal substrings have equal names in all documents without exchanging
dictionaries, and a round needs no shuffle.

What a symbol became depends on its neighbours, so each carries the range of
words that decided it. Inside a window, the symbols whose range lies in the window
are the same wherever the window occurs. Of these, from the highest round that
has any, the one with the smallest name is the window's anchor. Its key is the
hash of its name and of the words in its range, some fifteen after three rounds.
Anchors shared between documents show the candidates; windows are then compared by
their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.repeats import RUNS, fetch_plan, shared_runs, stored, with_uid
from burstline.llm.textbytes import flat, mix, range_hash, signed, steps, words
from burstline.llm.wordkeys import word_keys

#: Rounds of run and pair naming; the symbols of the last one serve as anchors.
ROUNDS = 3


class Symbols:
    """Symbols of all texts of a step: name, first word, and the deciding range."""

    def __init__(self, names, doc, begin, low, high, edges):
        self.names, self.doc, self.begin = names, doc, begin
        self.low, self.high, self.edges = low, high, edges

    def _joined(self, heads: np.ndarray, names: np.ndarray, low, high) -> Symbols:
        return Symbols(names, self.doc[heads], self.begin[heads], low, high, self.edges)

    def _neighbours(self):
        """Ranges of the symbols before and after; beyond a text's end, outside it."""
        n = len(self.names)
        low_before, high_after = np.empty((2, n), np.int64)
        low_before[1:], high_after[:-1] = self.low[:-1], self.high[1:]
        first, last = np.ones((2, n), bool)
        first[1:] = self.doc[1:] != self.doc[:-1]
        last[:-1] = first[1:]
        low_before[first] = self.edges[self.doc[first]] - 1
        high_after[last] = self.edges[self.doc[last] + 1] + 1
        return first, last, low_before, high_after

    def runs(self) -> Symbols:
        """Name every maximal run; a single symbol keeps its name."""
        if not len(self.names):
            return self
        first, _, low_before, high_after = self._neighbours()
        head = first.copy()
        head[1:] |= self.names[1:] != self.names[:-1]
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(head)) - 1
        size = (tails - heads + 1).astype(np.uint64)
        single = self.names[heads]
        names = np.where(size > 1, mix(single * np.uint64(0x9FB21C651E98DF25) + size), single)
        return self._joined(heads, names, low_before[heads], high_after[tails])

    def pairs(self, number: int) -> Symbols:
        """Name every left symbol with a right one after it."""
        if not len(self.names):
            return self
        first, last, low_before, high_after = self._neighbours()
        right = (mix(self.names + np.uint64(number)) & np.uint64(1)).astype(bool)
        second = np.zeros(len(right), bool)
        second[1:] = right[1:] & ~right[:-1]
        second &= ~first
        heads = np.flatnonzero(~second)
        paired = np.zeros(len(right), bool)
        paired[:-1] = second[1:]
        follower = np.minimum(heads + 1, len(right) - 1)
        names = np.where(
            paired[heads],
            mix(self.names[heads] * np.uint64(0xC2B2AE3D27D4EB4F) ^ mix(self.names[follower])),
            self.names[heads],
        )
        # an unpaired right symbol hangs on the one before it, an unpaired left on the next
        low = np.where(~paired & right, low_before, self.low)[heads]
        high = np.where(
            paired[heads], self.high[follower],
            np.where(right, self.high, high_after)[heads],
        )
        return self._joined(heads, names, low, high)


def recompress(names: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """The symbols after each round, the words themselves first."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(names), dtype=np.int64)
    levels = [Symbols(names, doc, place, place, place + 1, bounds)]
    for number in range(rounds):
        levels.append(levels[-1].runs().pairs(number))
    return levels


def _smallest(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the first smallest value in each non-empty ``[begin, end)``."""
    out = np.empty(len(begin), np.int64)
    size = end - begin
    level, best = 0, np.arange(len(values))
    while True:
        width = 1 << level
        now = np.flatnonzero((size >= width) & (size < 2 * width))
        left, right = best[begin[now]], best[end[now] - width]
        out[now] = np.where(values[right] < values[left], right, left)
        if not (size >= 2 * width).any():
            return out
        a, b = best[: len(best) - width], best[width:]
        best = np.where(values[b] < values[a], b, a)
        level += 1


def anchors(names: np.ndarray, bounds: np.ndarray, window: int, rounds: int = ROUNDS):
    """For every window: its first word, and its anchor's key and first word."""
    count = np.maximum(np.diff(bounds) - window + 1, 0)
    total = int(count.sum())
    starts = np.arange(total) + np.repeat(bounds[:-1] - (np.cumsum(count) - count), count)
    key, place = np.zeros(total, np.uint64), np.zeros(total, np.int64)
    todo = np.arange(total)
    for level, symbols in reversed(list(enumerate(recompress(names, bounds, rounds)))):
        if not len(todo):
            break
        begin = np.searchsorted(symbols.low, starts[todo], "left")
        end = np.searchsorted(symbols.high, starts[todo] + window, "right")
        has = end > begin
        rank = mix(symbols.names + np.uint64(0x5851F42D))
        best = _smallest(rank, begin[has], end[has])
        used, slot = np.unique(best, return_inverse=True)
        context = range_hash(names, symbols.low[used], symbols.high[used])
        context = mix(context + mix(symbols.names[used] + np.uint64(level)))
        key[todo[has]] = context[slot]
        place[todo[has]] = symbols.begin[best]
        todo = todo[~has]
    return starts, key, place


def _windows_runs(window: int, rounds: int):
    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            data, offsets = flat(batch.column("text"))
            begin, end, bounds = words(data, offsets)
            names = word_keys(data, begin, end)
            starts, key, place = anchors(names, bounds, window, rounds)
            if not len(starts):
                continue
            row = np.searchsorted(bounds, starts, "right") - 1
            head = np.ones(len(starts), bool)
            head[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            heads = np.flatnonzero(head)
            n = np.diff(np.append(heads, len(starts)))
            lo = starts[heads]
            shape = ((place[heads] - lo) * 4096 + n).astype(np.uint64)
            variant = mix(range_hash(names, lo, lo + n + window - 1) + mix(shape))
            row = row[heads]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(key[heads])), pa.array(signed(variant)),
                    batch.column("uid").take(pa.array(row)),
                    batch.column("doc").take(pa.array(row)),
                    pa.array(lo - bounds[row]), pa.array(n.astype(np.int32)),
                ],
                ["key", "variant", "uid", "doc", "lo", "n"],
            )

    return cut


def _read_windows(window: int):
    """Hashes of the windows at the wanted places of each text."""

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            data, offsets = flat(batch.column("text"))
            begin, end, bounds = words(data, offsets)
            names = word_keys(data, begin, end)
            places = batch.column("places")
            row = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
            items = places.flatten()
            lo, n, key = (
                items.field(f).to_numpy(zero_copy_only=False) for f in ("lo", "n", "key")
            )
            item = np.repeat(np.arange(len(lo)), n)
            place = lo[item] + np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
            start = place + bounds[row[item]]
            order = np.argsort(start, kind="stable")
            content = range_hash(names, start[order], start[order] + window)
            item, place = item[order], place[order]
            owner = pa.array(row[item])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[item]), pa.array(signed(content)),
                    batch.column("uid").take(owner), pa.array(place.astype(np.int32)),
                    batch.column("doc").take(owner),
                ],
                ["key", "content", "uid", "place", "doc"],
            )

    return read


def _keys(runs: DataFrame) -> DataFrame:
    """Keys that several documents have, and whether their runs are all alike."""
    return (
        runs.groupBy("key")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"),
             F.min("variant").alias("v1"), F.max("variant").alias("v2"))
        .filter(F.col("least") < F.col("most"))
        .select("key", "least", (F.col("v1") == F.col("v2")).alias("alike"))
    )


def repeated_windows(docs: DataFrame, window: int = 50, rounds: int = ROUNDS) -> DataFrame:
    """Windows of words that also start in a document with a smaller id.

    ``docs`` is a result of ``with_uid``. Returns ``uid, spans``: the first window
    and the number of windows of each block.

    A run that a smaller document has as a whole repeats in all its windows. So
    only the first document of each variant has to be looked at window by window;
    there, windows are compared under their key by a hash of their words.
    """
    runs = docs.select("uid", "doc", "text").mapInArrow(_windows_runs(window, rounds), RUNS)
    shared = shared_runs(runs, _keys)
    alike = shared.filter("alike").select("uid", "lo", "n", F.col("doc") > F.col("least"))
    unlike = shared.filter("not alike").drop("least", "alike")
    least = unlike.groupBy("variant").agg(F.min("doc").alias("least"))
    placed = stored(unlike.join(least, "variant"), "unlike")
    whole = alike.toDF("uid", "lo", "n", "later").unionAll(
        placed.select("uid", "lo", "n", F.col("doc") > F.col("least"))
    ).filter("later")
    plan = fetch_plan(placed.filter("doc = least"), ["lo", "n", "key"])
    # the same columns as in the last join, so that the texts are shuffled once
    read = docs.join(plan, "uid", "left").filter("places IS NOT NULL").mapInArrow(
        _read_windows(window), "key long, content long, uid long, place int, doc long"
    )
    best = read.groupBy("key", "content").agg(F.min("doc").alias("best"))
    single = read.join(best, ["key", "content"]).filter("doc > best")
    spans = whole.select("uid", F.struct(F.col("lo").cast("int").alias("lo"), "n").alias("span"))
    spans = spans.unionAll(
        single.select("uid", F.struct(F.col("place").alias("lo"), F.lit(1).alias("n")))
    )
    return spans.groupBy("uid").agg(F.collect_list("span").alias("spans"))


def _rewrite(window: int, texts: bool):
    def rewrite(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            data, offsets = flat(batch.column("text"))
            begin, end, bounds = words(data, offsets)
            spans = batch.column("spans")
            size = pc.fill_null(spans.value_lengths(), 0).to_numpy()
            row = np.repeat(np.arange(batch.num_rows), size)
            items = spans.flatten()
            first = items.field("lo").to_numpy() + bounds[row]
            delta = np.zeros(len(begin) + 1, np.int32)
            np.add.at(delta, first, 1)
            np.add.at(delta, first + items.field("n").to_numpy() + window - 1, -1)
            removed = np.cumsum(delta[:-1]) > 0
            yield _kept(batch, data, begin, end, bounds, removed, texts)

    return rewrite


def _kept(batch, data, begin, end, bounds, removed, texts: bool) -> pa.RecordBatch:
    """Digests of the kept words of each text, joined by one space."""
    kept = ~removed
    size = np.where(kept, end - begin + 1, 0)
    place = np.concatenate([[0], np.cumsum(size)])
    out = np.full(int(place[-1]), 0x20, np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[begin[kept]] += 1
    np.add.at(inside, end[kept], -1)
    target = np.ones(len(out), bool)
    target[place[1:][kept] - 1] = False
    out[target] = data[np.cumsum(inside[:-1]).astype(bool)]
    raw = out.tobytes()
    cut = [
        raw[place[a] : max(place[a], place[b] - 1)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]
    gone = np.concatenate([[0], np.cumsum(removed)])
    columns = [
        batch.column("doc_id"), pa.array(np.diff(bounds)),
        pa.array(gone[bounds[1:]] - gone[bounds[:-1]]),
        pa.array([hashlib.sha256(x).hexdigest() for x in cut]),
    ]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    if texts:
        columns.append(pa.array([x.decode("utf-8", "replace") for x in cut]))
        names.append("kept_text")
    return pa.RecordBatch.from_arrays(columns, names)


def remove_repeats(
    docs: DataFrame, window: int = 50, rounds: int = ROUNDS, texts: bool = True
) -> DataFrame:
    """Remove words covered by a window that also starts in a document with a smaller id.

    Returns one row per row of ``docs``: ``doc_id, n_words, n_removed,
    kept_sha256`` and, if ``texts``, ``kept_text``: the kept words joined by one
    space. Windows are judged on the input. A null text has no words; a null id
    counts as larger than every other; rows with one id are no smaller than each
    other. Columns other than ``doc_id`` and ``text`` are not used.
    """
    own = with_uid(docs)
    found = repeated_windows(own, window, rounds)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, "
    schema += "n_removed long, kept_sha256 string" + ", kept_text string" * texts
    return own.join(found, "uid", "left").mapInArrow(_rewrite(window, texts), schema)
