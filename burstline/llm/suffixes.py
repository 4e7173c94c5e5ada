"""Substring de-duplication with suffix arrays by induced sorting.

Every window of ``length`` bytes has an anchor, the place of the smallest hash
among the strings of ``ANCHOR`` bytes in it. Equal windows have equal anchors, so
windows are dealt by them: runs of windows with one anchor whose bytes are all
equal are settled by their hashes; of the others, one copy of each variant's
bytes goes to a shard. A shard joins its strings, sorts their suffixes by induced
sorting, and takes the common prefix of neighbours, in text order, as the
permuted array. A window repeats if a neighbour shares ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.repeats import RUNS, fetch_plan, stored, with_uid
from burstline.llm.textbytes import SMALL_STEP, flat, mix, range_hash, signed, span_hash, steps

#: Bytes of a string whose hash makes it an anchor.
ANCHOR = 128
#: Windows of a variant that go to a shard together.
CLASS = 128
#: Bytes that a shard sorts at once, about.
SHARD_BYTES = 4 << 20


def _suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last is."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.zeros(n, bool)
    smaller[-1] = True
    if len(differs):
        place = np.searchsorted(differs, np.arange(differs[-1] + 1))
        smaller[: differs[-1] + 1] = (text[1:] > text[:-1])[differs[place]]
    return smaller


class _Buckets:
    """Growing lists of suffixes per first symbol."""

    def __init__(self, symbols: int):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def add(self, text: np.ndarray, suffixes: np.ndarray) -> None:
        if not len(suffixes):
            return
        symbol = text[suffixes]
        order = np.argsort(symbol, kind="stable")
        symbol, suffixes = symbol[order], suffixes[order]
        cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for part in np.split(suffixes, cuts):
            self.parts[text[part[0]]].append(part)

    def take(self, symbol: int) -> np.ndarray:
        return np.concatenate([*self.parts[symbol], np.empty(0, np.int64)])


def _induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """Sort all suffixes from the leftmost-smaller ones, given in order.

    First the larger ones, by ascending first symbol: a suffix that is placed
    places the one before it. Then the smaller ones by descending symbol. Within
    a symbol, those placed by the symbol itself follow round by round.
    """
    seeded, large, small = _Buckets(symbols), _Buckets(symbols), _Buckets(symbols)
    seeded.add(text, seeds)

    def closure(buckets: _Buckets, symbol: int, kind: bool) -> np.ndarray:
        own = latest = buckets.take(symbol)
        rounds = [own]
        while len(latest):
            before = latest[latest > 0] - 1
            latest = before[(smaller[before] == kind) & (text[before] == symbol)]
            rounds.append(latest)
        return np.concatenate(rounds)

    ordered_large: list[np.ndarray] = []
    for symbol in range(symbols):
        own = closure(large, symbol, False)
        ordered_large.append(own)
        scanned = np.concatenate([own, seeded.take(symbol)])
        before = scanned[scanned > 0] - 1
        large.add(text, before[~smaller[before] & (text[before] > symbol)])
    out: list[np.ndarray] = []
    for symbol in range(symbols - 1, -1, -1):
        own = closure(small, symbol, True)
        if symbol == 0:
            own = np.array([len(text) - 1])
        scanned = np.concatenate([own, ordered_large[symbol][::-1]])
        out.append(scanned)
        before = scanned[scanned > 0] - 1
        small.add(text, before[smaller[before] & (text[before] < symbol)])
    return np.concatenate(out)[::-1]


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Sort suffixes of a string of many symbols by ranks of doubled length."""
    n, width = len(names), 1
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.full(n, -1, np.int64)
        after[: n - width] = rank[width:]
        both = rank * (n + 1) + after + 1
        order = np.argsort(both)  # equal ones get equal ranks, in whatever order
        fresh = np.concatenate([[0], np.cumsum(both[order][1:] != both[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffixes in order; ``text`` ends in its only 0 and has values below ``symbols``.

    The substrings between leftmost-smaller suffixes are sorted by induction and
    named; the string of their names is sorted the same way, unless it has so
    many symbols that few share a bucket, and gives the order of the seeds.
    """
    text = np.asarray(text, np.uint16 if symbols <= 1 << 16 else np.int64)
    if len(text) < 3:
        return np.arange(len(text))[::-1] if len(text) == 2 else np.arange(len(text))
    smaller = _suffix_types(text)
    leftmost = np.zeros(len(text), bool)
    leftmost[1:] = smaller[1:] & ~smaller[:-1]
    seeds = np.flatnonzero(leftmost)
    if len(seeds) > 1:
        order = _induce(text, smaller, seeds, symbols)
        order = order[leftmost[order]]
        ends = np.append(seeds[1:] + 1, len(text))
        content = range_hash(text.astype(np.uint64) + np.uint64(1), seeds, ends)
        slot = np.empty(len(text), np.int64)
        slot[seeds] = np.arange(len(seeds))
        sorted_content = content[slot[order]]
        fresh = np.concatenate([[0], np.cumsum(sorted_content[1:] != sorted_content[:-1])])
        names = np.empty(len(seeds), np.int64)
        names[slot[order]] = fresh
        kinds = int(fresh[-1]) + 1
        if kinds == len(seeds):
            seeds = order
        elif kinds * 64 < len(seeds):
            seeds = seeds[suffix_array(names, kinds)]
        else:
            seeds = seeds[_by_doubling(names)]
    return _induce(text, smaller, seeds, symbols)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes ``a[i]`` and ``b[i]``, four symbols at a time.

    The text's last symbol occurs once, so no comparison passes its end.
    """
    padded = np.concatenate([text, np.zeros(8, text.dtype)])
    n = len(text)
    if text.dtype == np.uint16:
        lanes = 4
        block = padded[:n].astype(np.uint64)
        for k in range(1, lanes):
            block |= padded[k : n + k].astype(np.uint64) << np.uint64(16 * k)
    else:
        lanes, block = 1, padded[:n].astype(np.uint64)
    shared = np.zeros(len(a), np.int64)
    todo, a, b = np.arange(len(a)), a.copy(), b.copy()
    while len(todo):
        differ = block[a] ^ block[b]
        same = differ == 0
        if lanes > 1:
            ended = differ[~same]
            own = np.zeros(len(ended), np.int64)
            for k in range(1, lanes):
                own += (ended & np.uint64((1 << 16 * k) - 1)) == 0
            shared[todo[~same]] += own
        todo, a, b = todo[same], a[same] + lanes, b[same] + lanes
        shared[todo] += lanes
    return shared


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """In text order, the prefix each suffix shares with the one before it in order.

    Up to ``most``. A suffix whose neighbour is the successor of its
    predecessor's, after equal symbols, shares one less than that; only the
    others are compared.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    chained = np.zeros(n, bool)
    chained[1:] = (before[1:] > 0) & (before[:-1] >= 0) & (before[1:] == before[:-1] + 1)
    chained[1:] &= text[np.maximum(before[1:] - 1, 0)] == text[:-1]
    shared = np.zeros(n, np.int64)
    heads = np.flatnonzero(~chained & (before >= 0))
    shared[heads] = _common(text, heads, before[heads])
    head = np.maximum.accumulate(np.where(chained, 0, np.arange(n)))
    return np.minimum(np.maximum(shared[head] - (np.arange(n) - head), 0), most)


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, the places where a string of ``length`` bytes starts that
    also starts elsewhere, in it or another."""
    sizes = np.array([len(s) for s in strings], np.int64)
    joined = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(sizes + 1) - 1
    joined[ends] = 1
    text = np.append(joined, np.uint16(0))
    order = suffix_array(text, 258)
    shared = permuted_prefixes(text, order, length)
    enough = shared >= length
    # a common prefix of that length must not pass the end of its string
    left = np.repeat(ends, sizes + 1) - np.arange(len(joined))
    enough[:-1] &= left >= length
    enough[-1] = False
    found = enough.copy()
    place = np.flatnonzero(enough[order])
    found[order[place - 1]] = True
    begin = ends - sizes
    return [np.flatnonzero(found[b:e]) for b, e in zip(begin, ends, strict=True)]


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int = ANCHOR):
    """For every window of ``length`` bytes: its start, its anchor's hash and place.

    Of equal hashes the first place wins.
    """
    size = np.diff(offsets)
    count = np.maximum(size - length + 1, 0)
    total = int(count.sum())
    none = np.empty(0, np.int64)
    if not total:
        return none, np.empty(0, np.uint64), none
    rolling, width = mix(data.astype(np.uint64) + np.uint64(1)), 1
    while width < anchor:  # anchor is a power of two
        rolling = rolling[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + rolling[width:]
        rolling ^= rolling >> np.uint64(29)
        width *= 2
    least = mix(rolling)
    best = (least & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(least), dtype=np.uint64)
    choices, width = length - anchor + 1, 1
    while 2 * width <= choices:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    rest = choices - width
    if rest:
        best = np.minimum(best[: len(best) - rest], best[rest:])
    starts = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(count) - count), count)
    place = (best[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return starts, least[place], place


def _runs(length: int):
    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches, most=SMALL_STEP):
            data, offsets = flat(batch.column("text"))
            starts, key, place = window_anchors(data, offsets, length)
            if not len(starts):
                continue
            row = np.searchsorted(offsets, starts, "right") - 1
            head = np.ones(len(starts), bool)
            head[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
            heads = np.flatnonzero(head)
            n = np.diff(np.append(heads, len(starts)))
            lo, row = starts[heads], row[heads]
            shape = ((place[heads] - lo) * 4096 + n).astype(np.uint64)
            variant = mix(span_hash(data, lo, lo + n + length - 1) + mix(shape))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(key[heads])), pa.array(signed(variant)),
                    batch.column("uid").take(pa.array(row)),
                    batch.column("doc").take(pa.array(row)),
                    pa.array(lo - offsets[row]), pa.array(n.astype(np.int32)),
                ],
                ["key", "variant", "uid", "doc", "lo", "n"],
            )

    return cut


def _strings(length: int, shards: int):
    """The bytes of the wanted variants, cut in classes of windows.

    A class has the windows whose distances from the anchor fall in one range.
    All of a class hold the bytes that every such window has, so only classes
    that agree in them can share a window.
    """

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches, most=SMALL_STEP):
            data, offsets = flat(batch.column("text"))
            places = batch.column("places")
            row = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
            items = places.flatten()
            lo, n, key, variant, times = (
                items.field(f).to_numpy(zero_copy_only=False)
                for f in ("lo", "n", "key", "variant", "times")
            )
            raw = data.tobytes()
            out: list[tuple] = []
            begin = lo + offsets[:-1][row]
            _, _, anchor = window_anchors_at(data, begin, length)
            last = anchor - begin  # distance of the first window; it falls by one per window
            for i in range(len(lo)):
                at = 0
                while at < n[i]:
                    distance = int(last[i]) - at
                    low = distance // CLASS * CLASS
                    count = min(distance - low + 1, int(n[i]) - at)
                    place = int(begin[i]) + at
                    core = int(anchor[i]) - low, int(anchor[i]) - low - CLASS + 1 + length
                    digest = hashlib.blake2b(
                        raw[core[0] : core[1]] + key[i].tobytes() + low.to_bytes(4, "little"),
                        digest_size=8,
                    ).digest()
                    group = int.from_bytes(digest, "little", signed=True)
                    string = raw[place : place + count + length - 1]
                    out.append((group % shards, group, key[i], variant[i], at, times[i], string))
                    at += count
            if out:
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                         pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["shard", "grp", "key", "variant", "at", "times", "string"],
                )

    return read


def window_anchors_at(data: np.ndarray, begin: np.ndarray, length: int):
    """The anchors of single windows that start at ``begin``."""
    if not len(begin):
        none = np.empty(0, np.int64)
        return none, np.empty(0, np.uint64), none
    size = np.full(len(begin), length)
    take = np.repeat(begin, length) + np.tile(np.arange(length), len(begin))
    offsets = np.concatenate([[0], np.cumsum(size)])
    starts, key, place = window_anchors(data[take], offsets, length)
    return begin, key, place - starts + begin


def _sort_shard(length: int):
    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        shared = rows.groupby("grp")["string"].transform("size") > 1
        rows = rows[shared].reset_index(drop=True)
        if not len(rows):
            return pd.DataFrame({"key": [], "variant": [], "at": []}).astype("object")
        found = repeated_starts(list(rows["string"]), length)
        rows["starts"] = [(f + a).tolist() for f, a in zip(found, rows["at"], strict=True)]
        rows = rows[rows["starts"].map(len) > 0]
        return rows[["key", "variant"]].assign(at=rows["starts"])

    return sort


def repeated_windows(docs: DataFrame, length: int = 400) -> DataFrame:
    """Windows of bytes that also start elsewhere, in the same text or another.

    ``docs`` is a result of ``with_uid``. Returns ``uid, spans``: the first
    windows of blocks, each with its length or the list of places in it.
    """
    runs = stored(docs.select("uid", "doc", "text").mapInArrow(_runs(length), RUNS), "runs")
    keys = (
        runs.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("variant").alias("v1"), F.max("variant").alias("v2"))
        .filter("n > 1")
        .select("key", (F.col("v1") == F.col("v2")).alias("alike"))
    )
    shared = stored(runs.join(keys, "key"), "shared")
    nowhere = F.lit(None).cast("array<int>")
    full = F.struct("lo", "n", nowhere.alias("at")).alias("span")
    variants = stored(
        shared.filter("not alike").groupBy("key", "variant")
        .agg(F.min(F.struct("uid", "lo", "n")).alias("first"), F.count("*").alias("times"))
        .select("key", "variant", "times", "first.uid", "first.lo", "first.n"),
        "variants",
    )
    number = variants.agg(F.sum(F.col("n") * (1 + length // CLASS) + length)).first()[0] or 0
    shards = int(1 + number // SHARD_BYTES)
    plan = fetch_plan(variants.filter("times = 1").unionAll(variants.filter("times > 1")),
                      ["lo", "n", "key", "variant", "times"])
    strings = plan.join(docs, "uid").dropDuplicates(["uid"]).select("text", "places").mapInArrow(
        _strings(length, shards),
        "shard int, grp long, key long, variant long, at int, times long, string binary",
    )
    starts = strings.groupBy("shard").applyInPandas(
        _sort_shard(length), "key long, variant long, at array<int>"
    )
    places = starts.groupBy("key", "variant").agg(F.flatten(F.collect_list("at")).alias("at"))
    single = variants.filter("times = 1").join(places, ["key", "variant"]).select(
        "uid", F.struct("lo", "n", "at").alias("span")
    )
    several = shared.filter("not alike").join(
        variants.filter("times > 1").select("key", "variant"), ["key", "variant"], "left_semi"
    ).select("uid", full)
    whole = shared.filter("alike").select("uid", full)
    return whole.unionAll(several).unionAll(single).groupBy("uid").agg(
        F.collect_list("span").alias("spans")
    )


def _rewrite(length: int, texts: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts

    def rewrite(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches, most=SMALL_STEP):
            data, offsets = flat(batch.column("text"))
            rows = []
            spans = batch.column("spans").to_pylist()
            for row, found in enumerate(spans):
                own = data[offsets[row] : offsets[row + 1]]
                gone, pieces = 0, 0
                if found:
                    delta = np.zeros(len(own) + 1, np.int32)
                    for span in found:
                        if span["at"] is None:
                            delta[span["lo"]] += 1
                            delta[span["lo"] + span["n"] + length - 1] -= 1
                        else:
                            at = np.asarray(span["at"]) + span["lo"]
                            np.add.at(delta, at, 1)
                            np.add.at(delta, at + length, -1)
                    removed = np.cumsum(delta[:-1]) > 0
                    gone = int(removed.sum())
                    pieces = int(removed[0]) + int((removed[1:] & ~removed[:-1]).sum())
                    kept = own[~removed].tobytes()
                else:
                    kept = own.tobytes()
                rows.append((len(own), gone, pieces, hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(c) for c in list(zip(*rows, strict=True))[: 4 + texts]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return rewrite


def remove_repeats(docs: DataFrame, length: int = 400, texts: bool = True) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts elsewhere.

    Texts are judged as UTF-8; matches don't cross documents, and one within the
    same document counts. Returns one row per row of ``docs``: ``doc_id,
    n_bytes, n_removed, n_spans, kept_sha256`` and, if ``texts``, the remaining
    bytes as ``kept``, which may cut a character. A null text is empty; fully
    equal rows are copies of each other. Columns other than ``doc_id`` and
    ``text`` are not used.
    """
    own = with_uid(docs)
    found = repeated_windows(own, length)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, "
    schema += "n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return own.join(found, "uid", "left").select("doc_id", "text", "spans").mapInArrow(
        _rewrite(length, texts), schema
    )
