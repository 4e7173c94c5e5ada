"""Sum-of-squares packing of tokenised documents into sequences.

Documents become token ids, each ended by a separator id. Only those longer
than a sequence are cut. The pieces are dealt to shards by a hash of their
document; a shard packs its pieces on its own, so no task holds more than a
shard. Within a shard, pieces go from long to short, and each goes where the sum
of the squared numbers of open sequences per remaining gap becomes smallest; of
equal choices the tightest gap wins, and a new sequence is the last choice.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.textbytes import LOWER, SPACE, flat, steps
from burstline.sources.layout import work_path

#: Words whose ids a task remembers.
REMEMBERED = 1 << 18

_LETTER = np.zeros(256, bool)
_LETTER[np.r_[ord("A") : ord("Z") + 1, ord("a") : ord("z") + 1]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in '!"#$%&()*+,-./:;<=>?@[]^_`{|}~']] = True


class WordTokenizer:
    """Ids of whole texts from the ids of their distinct words.

    For tokenizers that drop white space, lower-case, and never join letters,
    marks and spaces into one token: cutting a text at white space, and between
    an ASCII letter and an ASCII mark other than the apostrophe, changes none of
    its ids. Each distinct part is encoded once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ending = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ending[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = [np.empty(0, np.uint32)]
        self.sizes = [np.empty(0, np.int64)]

    def _learn(self, parts: list[str]) -> None:
        """Encode parts of letters in long runs, whose ids end at word ends; others singly."""
        rest = [x for x in parts if not x.isalpha()]
        simple = [x for x in parts if x.isalpha()]
        for begin in range(0, len(simple), 20000):
            some = simple[begin : begin + 20000]
            ids = self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids
            ids = np.asarray(ids, np.uint32)
            stops = np.flatnonzero(self.ending[ids]) + 1
            if len(stops) == len(some):
                self._add(some, ids, np.diff(stops, prepend=0))
            else:  # a vocabulary without word ends
                rest += some
        for begin in range(0, len(rest), 20000):
            some = rest[begin : begin + 20000]
            codes = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            codes = [code.ids for code in codes]
            flat_ids = np.fromiter(chain.from_iterable(codes), np.uint32)
            self._add(some, flat_ids, np.fromiter(map(len, codes), np.int64, len(codes)))

    def _add(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts))))
        self.pool.append(ids)
        self.sizes.append(sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the offsets of the texts in it."""
        data, offsets = flat(texts)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        data = LOWER[data]
        letter, mark = _LETTER[data], _MARK[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])
        cut[offsets[(offsets > 0) & (offsets < len(data))]] = True
        cuts = np.flatnonzero(cut)
        spaced = np.full(len(data) + len(cuts), 0x20, np.uint8)
        own = np.ones(len(spaced), bool)
        own[cuts + np.arange(len(cuts))] = False
        spaced[own] = data
        joined = pa.LargeStringArray.from_buffers(
            1, pa.py_buffer(np.array([0, len(spaced)], np.int64)), pa.py_buffer(spaced)
        )
        parts = pc.ascii_split_whitespace(joined).flatten()
        parts = parts.filter(pc.not_equal(pc.binary_length(parts), 0))
        coded = parts.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        pool, first, lengths = self._codes(coded.dictionary.to_pylist())
        each = lengths[which]
        ends = np.cumsum(each)
        place = np.repeat(first[which] - (ends - each), each)
        place += np.arange(len(place))
        fresh = ~SPACE[spaced]
        fresh[1:] &= ~fresh[:-1].copy()
        at = np.searchsorted(
            np.flatnonzero(fresh), offsets + np.searchsorted(cuts, offsets, "right")
        )
        return pool[place], np.concatenate([[0], ends])[at]

    def _codes(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where in it each part's ids begin and how many they are."""
        missing = [x for x in distinct if x not in self.known]
        if len(self.known) + len(missing) > REMEMBERED:
            self._forget()
            missing = distinct
        self._learn(missing)
        self.pool, self.sizes = [np.concatenate(self.pool)], [np.concatenate(self.sizes)]
        sizes = self.sizes[0]
        rows = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return self.pool[0], (np.cumsum(sizes) - sizes)[rows], sizes[rows]


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this process, kept with what it has learnt for later tasks."""
    return WordTokenizer(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, most: int = 4096, separator: int = 1, ids: bool = True
) -> DataFrame:
    """Cut each document's ids into pieces of at most ``most``.

    Returns ``doc_id, piece, start, length, ids_crc32`` and, if ``ids``, the
    token ids themselves. A null or empty text is the separator alone; repeated
    rows are packed as often as they occur. ``tokenizer`` is the file's path.
    """
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, row int"
    columns += ", token_ids array<int>" if ids else ""
    names = [c.split()[0] for c in columns.split(", ")]

    def cut(batches):
        encoder = word_tokenizer(tokenizer)
        for batch in steps(batches):
            codes, offsets = encoder.encode(batch.column("text"))
            # each text's ids with the separator after them, in one array
            sizes = np.diff(offsets) + 1
            codes = np.insert(codes, offsets[1:], separator).astype("<u4", copy=False)
            pieces = -(-sizes // most)
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = (np.cumsum(sizes) - sizes)[row] + piece * most
            length = np.minimum(most, sizes[row] - piece * most)
            bounds = zip(begin.tolist(), (begin + length).tolist())
            sums = [zlib.crc32(codes[a:b].data) for a, b in bounds]
            columns = [
                batch.column("doc_id").cast(pa.int64()).take(pa.array(row)), pa.array(piece.astype(np.int32)),
                pa.array(piece * most), pa.array(length), pa.array(sums, pa.int64()),
                pa.array(row.astype(np.int32)),
            ]
            if ids:  # the pieces lie one after another
                cuts = np.append(begin, len(codes)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(codes.view(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(cut, columns)


def sum_of_squares(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length; ``lengths`` are taken in their order.

    ``open_[g]`` counts the open sequences with gap g. Putting a piece of size s
    into a gap g takes one from ``open_[g]`` and adds one to ``open_[g - s]``, so
    the sum of squares changes by ``2 * (open_[g - s] - open_[g]) + 2``; a new
    sequence changes it by ``2 * open_[most - s] + 1``; full ones don't count.
    """
    open_ = np.zeros(most + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(most + 1)]
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    used = 0
    for i, s in enumerate(map(int, lengths)):
        taken = open_[s:most]
        gaps = np.flatnonzero(taken)
        best = most
        if len(gaps):
            after = open_[gaps]
            change = 2 * (after - taken[gaps]) + 2
            if gaps[0] == 0:  # the piece fills a sequence, which then is no longer open
                change[0] = 1 - 2 * taken[0]
            pick = int(np.argmin(change))
            if change[pick] <= 2 * open_[most - s] + 1:
                best = int(gaps[pick]) + s
        if best == most:
            own, used = used, used + 1
        else:
            own = stacks[best].pop()
            open_[best] -= 1
        rest = best - s
        sequence[i], offset[i] = own, most - best
        if rest:
            stacks[rest].append(own)
            open_[rest] += 1
    return sequence, offset


def pack(pieces: DataFrame, most: int = 4096, shard_tokens: int = 16_000_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` up to ``most``.

    Pieces go to as many shards as their tokens fill, by a hash of document and
    piece. ``pieces`` is read twice; give a stored table. An empty table gives no
    rows.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = pieces.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards))
    )
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields]

    def one(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="shard").sort_values(
            ["length", "doc_id", "piece", "ids_crc32"],
            ascending=[False, True, True, True], kind="stable",
        )
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), most)
        return rows.assign(sequence_id=sequence * shards + int(key[0]), offset=offset)

    return dealt.groupBy("shard").applyInPandas(
        one, ", ".join(fields) + ", sequence_id long, offset long"
    )


def packed(
    docs: DataFrame, tokenizer: str, most: int = 4096, separator: int = 1, ids: bool = False
) -> DataFrame:
    """Tokenise, cut and pack ``docs``; see ``token_pieces`` and ``pack``.

    With ``ids`` the token ids are joined back by document and piece.
    """
    spark = docs.sparkSession
    path = work_path(spark, "pieces")
    token_pieces(docs, tokenizer, most, separator, ids).drop("row").write.parquet(path)
    stored = spark.read.parquet(path)
    placed = pack(stored.drop("token_ids"), most)
    if not ids:
        return placed
    key = ["doc_id", "piece", "ids_crc32", "length", "start"]
    texts = stored.dropDuplicates(key).withColumnsRenamed({c: f"_{c}" for c in key})
    same = [placed[c].eqNullSafe(texts[f"_{c}"]) for c in key]
    return placed.join(texts, same, "left").drop(*[f"_{c}" for c in key])
