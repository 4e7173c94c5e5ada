"""Phrases whose words occur together more often than their parts would.

The suffixes of all pieces of text, cut after four words, form a tree whose node
totals are the phrase counts. The tree is never whole anywhere: it is partitioned
vertically. Every word has a key; the top bits of the keys of a suffix's first words
are its prefix, two words at first. Prefixes in order are put into one group as long
as the group's suffixes fit the memory budget; a prefix that has more suffixes than
that by itself is extended by the next word, as often as needed. The texts are then
read once, each suffix goes to the group of its prefix, and each group builds its
subtrees alone: sorted suffixes and the number of words that neighbours share.

What a step sends to a group is one array with equal suffixes combined, so a phrase
that is very frequent is few rows. Nodes above a group's prefix are added up over
its groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstline.llm.repeats import stored
from burstline.llm.textbytes import LOWER, STEP_BYTES, flat, mix, steps
from burstline.llm.wordkeys import number_words, runs, strings, text_key, word_keys

#: Bytes that end a piece, and those that only part words.
PIECE_END = np.zeros(256, np.uint8)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = 1
IN_WORD = PIECE_END == 0
IN_WORD[[0x20, 0x09]] = False

LONGEST = 4
#: Suffixes that a group may hold: some 100 bytes each while its subtrees are built.
BUDGET = 1 << 20
#: Bits that a word adds to a prefix.
CELL_BITS = 8
SCALE = 2_000_000


@dataclass
class Suffixes:
    """The words of one step, and how far the pieces go on after each."""

    keys: np.ndarray
    follows: list[np.ndarray]
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    lang: np.ndarray
    langs: np.ndarray


def read_step(batch: pa.RecordBatch, salt: int) -> Suffixes:
    """Words with keys that also tell the languages apart."""
    data, offsets = flat(batch.column("text"))
    data = LOWER[data]
    starts, ends, first = runs(IN_WORD[data], offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    lang, langs = pd.factorize(batch.column("lang").to_pandas())
    own = np.array([text_key(x, salt) for x in langs], np.uint64)
    keys = np.maximum(mix(word_keys(data, starts, ends, salt) ^ own[lang[doc]]), np.uint64(1))
    ended = np.cumsum(PIECE_END[data], dtype=np.int64)[starts] if len(starts) else starts
    on = np.zeros(len(starts), bool)
    on[:-1] = (ended[1:] == ended[:-1]) & (doc[1:] == doc[:-1])
    follows = [on]
    for _ in range(LONGEST - 2):
        on = np.append(follows[-1][1:], False) & follows[0]
        follows.append(on)
    return Suffixes(keys, follows, data, starts, ends, doc, lang, langs)


def cells(keys: np.ndarray, follows: list[np.ndarray], words: int) -> np.ndarray:
    """Prefix of each suffix by its first ``words`` words; a missing one counts as 0."""
    bits = keys >> np.uint64(64 - CELL_BITS)
    cell = bits.copy()
    for k in range(1, words):
        later = np.append(bits[k:], np.zeros(min(k, len(bits)), np.uint64))
        cell = (cell << np.uint64(CELL_BITS)) | np.where(follows[k - 1], later, np.uint64(0))
    return cell


def survey(docs: DataFrame, salt: int) -> DataFrame:
    """Words and two-word prefixes of every step: ``cell, key, lang, word, n``.

    Rows of words have no ``cell``, rows of prefixes nothing but it and ``n``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, most=STEP_BYTES):
            own = read_step(batch, salt)
            # sorted by key and compared by their words, so that two words with one
            # key stay two rows
            number, sample = number_words(own.data, own.starts, own.ends, own.lang[own.doc])
            n = np.bincount(number, minlength=len(sample))
            cell = cells(own.keys, own.follows, 2)[own.follows[0]]
            cell, prefixes = np.unique(cell, return_counts=True)
            nothing = pa.nulls(len(cell), pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(len(sample), -1), cell.astype(np.int64)])),
                    pa.array(np.concatenate([own.keys[sample], np.zeros(len(cell), np.uint64)]).view(np.int64)),
                    pa.concat_arrays([pa.array(own.langs, pa.string()).take(pa.array(own.lang[own.doc[sample]])), nothing]),
                    pa.concat_arrays([strings(own.data, own.starts[sample], own.ends[sample]), nothing]),
                    pa.array(np.concatenate([n, prefixes])),
                ],
                ["cell", "key", "lang", "word", "n"],
            )

    return docs.mapInArrow(read, "cell long, key long, lang string, word string, n long")


@dataclass
class Groups:
    """Where each prefix goes: the first prefix of each group, and those extended."""

    begins: dict[int, np.ndarray]
    numbers: dict[int, np.ndarray]
    extended: dict[int, np.ndarray]
    words: dict[int, int]

    def of(self, keys: np.ndarray, follows: list[np.ndarray]) -> np.ndarray:
        """The group of each suffix."""
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for words in sorted(self.begins):
            cell = cells(keys, follows, words)[rest]
            later = np.isin(cell, self.extended[words])
            if len(self.begins[words]):
                place = np.searchsorted(self.begins[words], cell, "right") - 1
                out[rest] = self.numbers[words][np.maximum(place, 0)]
            rest = rest[later]
        return out


def grouped(docs: DataFrame, prefixes: DataFrame, salt: int, budget: int) -> Groups:
    """Put prefixes into groups of at most ``budget`` suffixes.

    One row per prefix comes to the driver: 65536 at first, and 256 for each that is
    extended, of which there are fewer than there are budgets in all suffixes. What
    the tasks get is 8 bytes a group.
    """
    groups = Groups({}, {}, {}, {})
    words, number = 2, 0
    found = prefixes.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
    while True:
        cell, n = found["cell"].to_numpy(np.uint64), found["n"].to_numpy(np.int64)
        more = (n > budget) & (words < LONGEST)
        begins, numbers, filled = [], [], budget
        for c, size in zip(cell[~more].tolist(), n[~more].tolist()):
            if filled + size > budget:
                begins.append(c)
                numbers.append(number)
                groups.words[number] = words
                number, filled = number + 1, 0
            filled += size
        groups.begins[words] = np.array(begins, np.uint64)
        groups.numbers[words] = np.array(numbers, np.int64)
        groups.extended[words] = cell[more]
        if not more.any():
            return groups
        words += 1
        found = _extended(docs, salt, groups, words).groupBy("cell").agg(F.sum("n").alias("n"))
        found = found.orderBy("cell").toPandas()


def _extended(docs: DataFrame, salt: int, groups: Groups, words: int) -> DataFrame:
    """Counts of the prefixes of ``words`` words whose shorter ones are extended."""
    hot = groups.extended[words - 1]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, most=STEP_BYTES):
            own = read_step(batch, salt)
            cell = cells(own.keys, own.follows, words)[own.follows[0]]
            cell = cell[np.isin(cell >> np.uint64(CELL_BITS), hot)]
            cell, n = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(n)], ["cell", "n"])

    return docs.mapInArrow(read, "cell long, n long")


def _packed(words: np.ndarray, rows: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> bytes:
    """Suffixes as bytes: their keys once, and numbers of words for each of them."""
    used = np.zeros(len(keys) + 1, bool)
    used[words[rows]] = True
    used[0] = True
    renamed = (np.cumsum(used) - 1).astype("<u4")
    parts = [
        np.array([len(rows), int(used.sum()) - 1], "<u8"), keys[used[1:]].astype("<u8"),
        *renamed[words[rows]].T, counts[rows].astype("<u4"),
    ]
    return zstandard.compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.decompress(packed)
    n, d = np.frombuffer(data, "<u8", 2).tolist()
    keys = np.frombuffer(data, "<u8", d, 16)
    numbers = np.frombuffer(data, "<u4", n * (LONGEST + 1), 16 + 8 * d).reshape(LONGEST + 1, n)
    return keys, numbers[:LONGEST], numbers[LONGEST]


def suffixes(docs: DataFrame, salt: int, groups: Groups) -> DataFrame:
    """The suffixes of at least two words by group: ``group, packed``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, most=STEP_BYTES):
            own = read_step(batch, salt)
            keys, number = np.unique(own.keys, return_inverse=True)
            number = number.astype(np.uint64) + np.uint64(1)
            group = groups.of(own.keys, own.follows)
            columns = [number]
            for k in range(1, LONGEST):
                later = np.append(number[k:], np.zeros(min(k, len(number)), np.uint64))
                columns.append(np.where(own.follows[k - 1], later, np.uint64(0)))
            own_rows = np.flatnonzero(own.follows[0])
            words = np.stack(columns, 1)[own_rows]
            group = group[own_rows]
            if len(keys) < 1 << 16:
                shifts = np.array([48, 32, 16, 0], np.uint64)
                _, sample, counts = np.unique(
                    (words << shifts).sum(1, dtype=np.uint64), return_index=True, return_counts=True
                )
            else:
                high, low = ((words[:, i] << np.uint64(32)) | words[:, i + 1] for i in (0, 2))
                order = np.lexsort((low, high))
                high, low = high[order], low[order]
                fresh = np.ones(len(order), bool)
                fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
                sample = order[fresh]
                counts = np.diff(np.append(np.flatnonzero(fresh), len(order)))
            words, group = words[sample], group[sample]
            order = np.argsort(group, kind="stable")
            bounds = np.flatnonzero(np.diff(group[order])) + 1
            parts = np.split(order, bounds) if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(group[p[0]]) for p in parts], pa.int64()),
                    pa.array([_packed(words, p, counts, keys) for p in parts], pa.binary()),
                ],
                ["group", "packed"],
            )

    return docs.mapInArrow(read, "group long, packed binary")


def subtrees(packed: list[bytes], complete: int, least: int) -> pd.DataFrame:
    """Nodes of a group's subtrees: ``w1 ... w4, a, part``.

    Leaves are the sorted suffixes; the words that a leaf shares with the one before
    say where nodes of each depth begin, and a node's total is that of its leaves.
    Nodes of fewer than ``complete`` words may go on in other groups and are all
    returned, as parts; of the others those that occur ``least`` times.
    """
    read = [_unpacked(p) for p in packed]
    keys = np.unique(np.concatenate([k for k, _, _ in read]))
    renamed = [np.concatenate([[0], np.searchsorted(keys, k) + 1]).astype(np.uint64) for k, _, _ in read]
    high, low = (
        np.concatenate(
            [(own[w[i]] << np.uint64(32)) | own[w[i + 1]] for own, (_, w, _) in zip(renamed, read)]
        )
        for i in (0, 2)
    )
    counts = np.concatenate([n for _, _, n in read]).astype(np.int64)
    del read, renamed
    order = np.lexsort((low, high))
    leaf = np.stack([high[order], low[order]], 1)
    counts = counts[order]
    words = np.empty((len(order), LONGEST), np.uint32)
    words[:, 0::2] = leaf >> np.uint64(32)
    words[:, 1::2] = leaf & np.uint64(0xFFFFFFFF)
    shared = np.zeros(len(order), np.int8)
    same = np.ones(len(order) - 1, bool)
    for k in range(LONGEST):
        same &= words[1:, k] == words[:-1, k]
        shared[1:] += same
    spelled = np.append(np.zeros(1, np.uint64), keys)
    out = []
    for depth in range(2, LONGEST + 1):
        begins = np.flatnonzero(shared < depth)
        total = np.add.reduceat(counts, begins)
        part = depth < complete
        own = (words[begins, depth - 1] > 0) & (part | (total >= least))
        node = spelled[words[begins[own]]]
        node[:, depth:] = 0
        frame = pd.DataFrame(node.view(np.int64), columns=[f"w{i + 1}" for i in range(LONGEST)])
        out.append(frame.assign(a=total[own], part=part))
    return pd.concat(out, ignore_index=True)


WORDS = [f"w{i + 1}" for i in range(LONGEST)]


def phrase_counts(docs: DataFrame, least: int, budget: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of one to four words that occur ``least`` times, words, languages' totals.

    ``docs`` has ``text`` and ``lang`` without nulls. Phrases are ``w1 ... w4, a`` by
    the keys of their words, 0 after the last; words are ``key, lang, word``. Two words
    with one key are noticed, and the keys are chosen anew.
    """
    salt = 0
    while True:
        surveyed = stored(survey(docs, salt), "survey")
        words = surveyed.filter("cell < 0").repartition("key").groupBy("key", "lang", "word")
        words = stored(words.agg(F.sum("n").alias("n")).withColumn("frequent", F.col("n") >= least), "words")
        if words.groupBy("key").count().filter("count > 1").isEmpty():
            break
        salt += 1
    groups = grouped(docs, surveyed.filter("cell >= 0"), salt, budget)
    complete = groups.words

    def build(key, rows: pd.DataFrame) -> pd.DataFrame:
        return subtrees(rows["packed"].tolist(), complete[int(key[0])], least)

    nodes = stored(
        suffixes(docs, salt, groups).groupBy("group").applyInPandas(
            build, ", ".join(f"{w} long" for w in WORDS) + ", a long, part boolean"
        ),
        "nodes",
    )
    parts = nodes.filter("part").groupBy(*WORDS).agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    single = words.filter("frequent").select(
        F.col("key").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in WORDS[1:]], F.col("n").alias("a")
    )
    phrases = nodes.filter("not part").select(*WORDS, "a").unionByName(parts).unionByName(single)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return phrases, words.filter("frequent").select("key", "lang", "word"), totals


def _padded(columns: list) -> list:
    return [*columns, *[F.lit(0).cast("long")] * (LONGEST - len(columns))]


def collocations(
    docs: DataFrame, least: int = 30, most: int = 2000, cover: int = 80, budget: int = BUDGET
) -> DataFrame:
    """Each language's first ``most`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` has ``text`` and ``lang``; other columns are not read, null texts are empty
    and null languages ``und``. Texts are lower-cased in ASCII; pieces end at ``.,;:!?``
    and line ends, and words lie between spaces and tabs. A candidate has two to four
    words and occurs ``least`` times; its score is ``2000000 * a / (l + r)`` of its
    worst cut into a first part that occurs ``l`` times and a rest that occurs ``r``
    times, rounded down; of equal cuts the first one. One that lies in a longer candidate with at least
    ``cover`` percent of its occurrences is dropped. Ties go to the more frequent, then to
    the smaller phrase in UTF-8 order. Repeated rows count as often as they occur; no
    row or no word gives no rows.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    phrases, words, totals = phrase_counts(texts, least, budget)
    phrases = stored(phrases, "phrases")
    candidates = phrases.filter("w2 <> 0")
    size = F.lit(2) + (F.col("w3") != 0).cast("int") + (F.col("w4") != 0).cast("int")
    own = [F.col(w) for w in WORDS]

    # the counts of all parts: one request for the first part and one for the rest of each cut
    requests = []
    for k in range(1, LONGEST):
        cut = size > k
        requests.append(F.when(cut, F.struct(F.lit(k).alias("k"), F.lit(True).alias("first"), *[
            c.alias(f"q{i}") for i, c in enumerate(_padded(own[:k]), 1)])))
        requests.append(F.when(cut, F.struct(F.lit(k).alias("k"), F.lit(False).alias("first"), *[
            c.alias(f"q{i}") for i, c in enumerate(_padded(own[k:]), 1)])))
    asked = candidates.select(*WORDS, "a", F.explode(F.array_compact(F.array(*requests))).alias("ask"))
    asked = asked.select(*WORDS, "a", "ask.*")
    parts = phrases.select(*[F.col(w).alias(f"q{i}") for i, w in enumerate(WORDS, 1)], F.col("a").alias("of_part"))
    answered = asked.join(parts, [f"q{i}" for i in range(1, LONGEST + 1)])
    part = [
        F.max(F.when((F.col("k") == k) & (F.col("first") == first), F.col("of_part"))).alias(f"{name}{k}")
        for k in range(1, LONGEST) for first, name in ((True, "l"), (False, "r"))
    ]
    cuts = answered.groupBy(*WORDS, "a").agg(*part)
    scores = []
    for k in range(1, LONGEST):
        up = F.col("a").cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
        down = F.col(f"l{k}").cast("decimal(19,0)") + F.col(f"r{k}").cast("decimal(19,0)")
        scores.append(F.when(F.col(f"l{k}").isNotNull(), F.struct(
            F.call_function("div", up, down).alias("score"), F.lit(k).alias("k"),
            F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        )))
    # a struct's first fields decide, so the first cut wins a tie
    scored = cuts.select(*WORDS, "a", F.array_min(F.array_compact(F.array(*scores))).alias("cut"))

    # of the longer candidates around one, those with one more word occur most often
    longer = candidates.filter("w3 <> 0")
    last = F.when(F.col("w4") != 0, F.lit(4)).otherwise(3)
    inner = F.array(
        F.struct(*[F.when(last > i, c).otherwise(0).alias(f"v{i}") for i, c in enumerate(own, 1)]),
        F.struct(*[c.alias(f"v{i}") for i, c in enumerate(_padded(own[1:]), 1)]),
    )
    around = longer.select("a", F.explode(inner).alias("of")).groupBy(
        *[F.col(f"of.v{i}").alias(f"v{i}") for i in range(1, LONGEST + 1)]
    ).agg(F.max("a").alias("around"))
    match = [F.col(w) == F.col(f"v{i}") for i, w in enumerate(WORDS, 1)]
    covered = F.col("around").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * cover
    left = scored.join(around, match, "left").filter(~F.coalesce(covered, F.lit(False)))

    spelled = words.select(F.col("key").alias("w1"), "lang")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # ties stay until the phrases are spelled
    first = (
        left.join(spelled, "w1")
        .select("lang", *WORDS, "a", "cut.l", "cut.r", "cut.score")
        .withColumn("place", F.rank().over(by_score))
        .filter(F.col("place") <= most)
    )
    first = stored(first.drop("place"), "first")
    letters = (
        first.select(*WORDS, F.posexplode(F.array(*own)).alias("pos", "key")).filter("key <> 0")
        .join(words.select("key", "word"), "key")
        .groupBy(*WORDS).agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("spelling"))
        .select(*WORDS, F.array_join(F.col("spelling.word"), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        first.join(letters, WORDS).withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= most).join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
