"""Count tokens with a finite-state transducer compiled from a piece vocabulary.

A byte-fallback piece model joins neighbouring symbols, best score first, while
their concatenation is a piece. Two facts turn that into a deterministic machine:

* a sequence of pieces is the encoding of its concatenation exactly if each piece
  is its own encoding and each two neighbours are the encoding of their
  concatenation;
* hence each prefix of a text has one last piece: the one piece ending there that
  is compatible with the last piece of the prefix before it.

A state holds the longest ending of what was read that begins a piece, and for it
and each shorter such ending the last piece before it and how many fewer pieces
the prefix there has. Reading a character changes the number of pieces of the
prefix by an amount that the state and the character determine; this is what a
transition emits. States get numbers when they are first reached, and transitions
are kept in a hash table that numpy reads for all lanes at once.

Where no piece holds two neighbouring characters side by side, no join crosses, so
the machine starts anew; characters that no piece holds are one token a byte.
Stretches without such a place are cut into chunks. A chunk's state map says for
entry states which state it ends in and how many tokens it emits; the maps are
closed under what the chunks before can end in, and then composed in pairs, pairs
of pairs and so on, as in a parallel prefix scan.
"""

from __future__ import annotations

import struct
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.textbytes import SMALL_STEP, flat, mix, steps

#: Characters of a chunk of a stretch without a place to start anew.
CHUNK = 64
#: States that are kept from one step to the next; a fuller machine is forgotten.
MOST_STATES = 1 << 17
#: Classes 0 to 3 are characters of one to four bytes that no piece holds.
FOREIGN = 4
SPACE_MARK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
TEXT = "_text_of_row"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        shift, at = shift + 7, at + 1
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of one protocol-buffers message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        elif tag & 7 == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif tag & 7 == 5:
            (value,), at = struct.unpack_from("<f", data, at), at + 4
        else:
            (value,), at = struct.unpack_from("<d", data, at), at + 8
        yield tag >> 3, value


def read_pieces(path: str) -> dict[str, float]:
    """Pieces and scores of a model file of kind BPE with byte fallback.

    Raises on models this machine would count wrongly: other kinds, models that
    rewrite the text beyond marking its spaces, and pieces that are matched before
    any joining.
    """
    with open(path, "rb") as file:
        data = file.read()
    pieces: dict[str, float] = {}
    trainer: dict = {}
    normal: dict = {}
    for field, value in _fields(data):
        if field == 1:
            entry = dict(_fields(value))
            kind = entry.get(3, _NORMAL)
            if kind == _NORMAL:
                pieces[entry[1].decode()] = entry.get(2, 0.0)
            elif kind not in (_UNKNOWN, _CONTROL, _BYTE):
                raise ValueError(f"{path} has pieces of a kind that is not supported: {kind}")
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normal = dict(_fields(value))
    plain = (
        trainer.get(3) == 2 and trainer.get(35) == 1 and not trainer.get(24)
        and not normal.get(2) and normal.get(3, 1) == 1 and normal.get(4, 1) == 0
        and normal.get(5, 1) == 1
    )
    if not plain:
        raise ValueError(f"{path} is no plain BPE model with byte fallback")
    return pieces


class Transducer:
    """The machine of one vocabulary; it grows with what it reads, within a bound."""

    def __init__(self, pieces: dict[str, float]):
        self.score = pieces
        chars = sorted({c for piece in pieces for c in piece})
        if missing := [c for c in chars if c not in pieces]:
            raise ValueError(f"characters that are no pieces themselves: {missing[:5]}")
        self.classes = FOREIGN + len(chars)
        points = np.arange(0x110000)
        self.class_of = np.digitize(points, [0x80, 0x800, 0x10000]).astype(np.int32)
        self.class_of[[ord(c) for c in chars]] = np.arange(FOREIGN, self.classes)
        self.class_of[ord(" ")] = self.class_of[ord(SPACE_MARK)]
        self._char = dict(enumerate(chars, FOREIGN))
        joined = {(a, b) for piece in pieces for a, b in zip(piece, piece[1:])}
        keys = [self.classes * self._class(a) + self._class(b) for a, b in joined]
        bits = np.zeros(self.classes**2, bool)
        bits[keys] = True
        self._joined = np.packbits(bits, bitorder="little")
        self._compile_trie()
        self._fits: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}
        self._forget()

    def _class(self, char: str) -> int:
        return int(self.class_of[ord(char)])

    def _compile_trie(self) -> None:
        """The beginnings of pieces, each with its next shorter ending that begins one."""
        self._children: list[dict[int, int]] = [{}]
        self._piece: list[str | None] = [None]
        self._depth = [0]
        for piece in self.score:
            node = 0
            for char in piece:
                code = self._class(char)
                after = self._children[node].get(code)
                if after is None:
                    after = len(self._depth)
                    self._children[node][code] = after
                    self._children.append({})
                    self._piece.append(None)
                    self._depth.append(self._depth[node] + 1)
                node = after
            self._piece[node] = piece
        self._shorter = [0] * len(self._depth)
        queue = deque(self._children[0].values())
        while queue:
            node = queue.popleft()
            for code, after in self._children[node].items():
                self._shorter[after] = self._go(self._shorter[node], code)
                queue.append(after)

    def _go(self, node: int, code: int) -> int:
        while node and code not in self._children[node]:
            node = self._shorter[node]
        return self._children[node].get(code, 0)

    def encode(self, text: str) -> list[str]:
        """The pieces of a short text, by joining; all its characters are pieces."""
        parts = list(text)
        while len(parts) > 1:
            scores = [
                (-self.score[a + b], i)
                for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score
            ]
            if not scores:
                break
            _, i = min(scores)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _stands(self, before: str | None, piece: str) -> bool:
        """Whether ``piece`` is its own encoding and may follow ``before``."""
        whole = self._whole.get(piece)
        if whole is None:
            whole = self._whole[piece] = self.encode(piece) == [piece]
        if not whole or before is None:
            return whole
        fits = self._fits.get((before, piece))
        if fits is None:
            fits = self.encode(before + piece) == [before, piece]
            self._fits[before, piece] = fits
        return fits

    def _forget(self) -> None:
        begin = (0, ((0, None, 0),))
        self._states = [begin]
        self._number = {begin: 0}
        if len(self._fits) > 2 * MOST_STATES:
            self._fits.clear()
        self._slots(1 << 16)
        self._filled = 0

    def _slots(self, size: int) -> None:
        self._shift = np.uint64(64 - (size.bit_length() - 1))
        self._keys = np.full(size, -1, np.int64)
        self._next = np.zeros(size, np.int32)
        self._emits = np.zeros(size, np.int32)

    def _step(self, state: int, code: int) -> tuple[int, int]:
        """Next state and emitted tokens of one character that a piece holds."""
        node, endings = self._states[state]
        before = {depth: (last, fewer) for depth, last, fewer in endings}
        reached = at = self._go(node, code)
        emitted, last = None, None
        while at:
            piece = self._piece[at]
            if piece is not None and emitted is None:
                previous, fewer = before[self._depth[at] - 1]
                if self._stands(previous, piece):
                    emitted, last = fewer + 1, piece
            at = self._shorter[at]
        now, at = [], reached
        while at:
            depth = self._depth[at]
            previous, fewer = before[depth - 1]
            now.append((depth, previous, fewer - emitted))
            at = self._shorter[at]
        now.append((0, last, 0))
        new = (reached, tuple(now))
        number = self._number.get(new)
        if number is None:
            number = self._number[new] = len(self._states)
            self._states.append(new)
        return number, emitted

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> self._shift).astype(np.int64)

    def _learn(self, keys: np.ndarray) -> None:
        """Add the transitions of new keys, ``state * classes + code``."""
        results = [self._step(*divmod(int(k), self.classes)) for k in keys]
        after = np.array(results, np.int64).reshape(-1, 2)
        if 2 * (self._filled + len(keys)) > len(self._keys):
            used = self._keys >= 0
            old = self._keys[used], self._next[used], self._emits[used]
            size = len(self._keys)
            while size < 4 * (self._filled + len(keys)):
                size *= 2
            self._slots(size)
            self._put(*old)
        self._put(keys, after[:, 0], after[:, 1])
        self._filled += len(keys)

    def _put(self, keys, after, emits) -> None:
        """Write distinct keys to free slots, each the next free one from its place on."""
        rest, slot = np.arange(len(keys)), self._place(keys)
        while len(rest):
            free = self._keys[slot] < 0
            self._keys[slot[free]] = keys[rest[free]]  # of several, the last one stays
            done = self._keys[slot] == keys[rest]
            own = slot[done]
            self._next[own], self._emits[own] = after[rest[done]], emits[rest[done]]
            rest, slot = rest[~done], (slot[~done] + 1) % len(self._keys)

    def _move(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted tokens of all lanes."""
        keys = states.astype(np.int64) * self.classes + codes
        slot = self._place(keys)
        found = self._keys[slot]
        other = np.flatnonzero(found != keys)
        while len(other):
            vacant = found[other] < 0
            if vacant.any():
                self._learn(np.unique(keys[other[vacant]]))
                return self._move(states, codes)
            slot[other] = (slot[other] + 1) % len(self._keys)
            found[other] = self._keys[slot[other]]
            other = other[found[other] != keys[other]]
        return self._next[slot], self._emits[slot]

    def _run(self, codes, starts, lengths, states) -> tuple[np.ndarray, np.ndarray]:
        """Read each lane from its state: the states at the ends and tokens emitted."""
        order = np.argsort(-lengths, kind="stable")
        at, states = starts[order], states[order].astype(np.int32)
        emitted = np.zeros(len(order), np.int64)
        alive = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")
        for j, n in enumerate(alive):
            states[:n], emits = self._move(states[:n], codes[at[:n] + j])
            emitted[:n] += emits
        ends, tokens = np.empty_like(states), np.empty_like(emitted)
        ends[order], tokens[order] = states, emitted
        return ends, tokens

    def _run_chunked(self, codes, starts, lengths) -> np.ndarray:
        """Tokens of stretches longer than a chunk, by composing their chunks' maps."""
        number = -(-lengths // CHUNK)
        owner = np.repeat(np.arange(len(starts)), number)
        first = np.cumsum(number) - number
        place = np.arange(len(owner)) - first[owner]
        begin = starts[owner] + place * CHUNK
        size = np.minimum(CHUNK, lengths[owner] - place * CHUNK)
        cells = np.full((len(owner), CHUNK), -1, np.int32)
        inside = np.arange(CHUNK) < size[:, None]
        cells[inside] = codes[(begin[:, None] + np.arange(CHUNK))[inside]]
        rows = cells.view(np.dtype((np.void, cells.dtype.itemsize * CHUNK))).ravel()
        _, sample, kind = np.unique(rows, return_index=True, return_inverse=True)
        # equal chunks have one map; a map is closed when it has an entry for every
        # state that a chunk before one of its chunks ends in
        follows = np.unique(np.stack([kind[:-1], kind[1:]], 1)[place[1:] > 0], axis=0)
        entries: list[dict[int, int]] = [{} for _ in sample]
        ends: list[list[int]] = [[] for _ in sample]
        tokens: list[list[int]] = [[] for _ in sample]
        successors: dict[int, list[int]] = {}
        for a, b in follows.tolist():
            successors.setdefault(a, []).append(b)
        wanted = [(k, 0) for k in range(len(sample))]
        while wanted:
            for k, state in wanted:
                entries[k][state] = len(entries[k])
            kinds = np.array([k for k, _ in wanted])
            end, n = self._run(
                codes, begin[sample[kinds]], size[sample[kinds]],
                np.array([s for _, s in wanted]),
            )
            more = {}
            for (k, _), e, t in zip(wanted, end.tolist(), n.tolist()):
                ends[k].append(e)
                tokens[k].append(t)
                for b in successors.get(k, ()):
                    if e not in entries[b]:
                        more[b, e] = None
            wanted = list(more)
        widest = max(map(len, entries))
        count = np.zeros((len(owner), widest), np.int64)
        leads = np.zeros((len(owner), widest), np.int64)
        for i, k in enumerate(kind.tolist()):
            count[i, : len(tokens[k])] = tokens[k]
            if i + 1 < len(owner) and place[i + 1]:
                following = entries[kind[i + 1]]
                leads[i, : len(ends[k])] = [following[e] for e in ends[k]]
        # pairs of neighbours become one map in each round
        while len(owner) > len(starts):
            left = np.flatnonzero(place % 2 == 0)
            right = np.minimum(left + 1, len(owner) - 1)
            paired = (right > left) & (owner[right] == owner[left])
            through = leads[left]
            count[left] += np.where(
                paired[:, None], np.take_along_axis(count[right], through, 1), 0
            )
            leads[left] = np.where(
                paired[:, None], np.take_along_axis(leads[right], through, 1), through
            )
            owner, place, count, leads = owner[left], place[left] // 2, count[left], leads[left]
        return count[:, 0]

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of tokens of each text of a batch of UTF-8 bytes."""
        if len(self._states) > MOST_STATES:
            self._forget()
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        cuts = heads[offsets]
        codes = self.class_of[points]
        # a mark before each text that isn't empty
        filled = np.diff(cuts) > 0
        codes = np.insert(codes, cuts[:-1][filled], self._class(SPACE_MARK))
        cuts = cuts + np.concatenate([[0], np.cumsum(filled)])
        own = codes >= FOREIGN
        pair = codes[:-1].astype(np.int64) * self.classes + codes[1:]
        joined = (self._joined[pair >> 3] >> (pair & 7).astype(np.uint8)) & 1
        anew = np.ones(len(codes), bool)
        anew[1:] = joined == 0
        anew[cuts[:-1][filled]] = True
        begins = np.flatnonzero(anew)
        ends = np.append(begins[1:], len(codes))
        tokens = np.empty(len(begins), np.int64)
        foreign = ~own[begins]
        tokens[foreign] = codes[begins[foreign]] + 1
        short = np.flatnonzero(~foreign & (ends - begins <= CHUNK))
        length = (ends - begins)[short]
        tokens[short] = self._run(codes, begins[short], length, np.zeros(len(short), np.int32))[1]
        long = np.flatnonzero(ends - begins > CHUNK)
        if len(long):
            tokens[long] = self._run_chunked(codes, begins[long], (ends - begins)[long])
        total = np.concatenate([[0], np.cumsum(tokens)])
        return np.diff(total[np.searchsorted(begins, cuts)])


@lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    """The machine of this process, kept with its states for later tasks."""
    return Transducer(read_pieces(path))


def token_counts(
    docs: DataFrame, model: str, limit: int = 4096, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, and ``n_bytes, n_tokens, over_limit`` of each ``text``.

    Tokens are those of the model file at ``model``, without any at the begin or end.
    Null and empty texts have none. Every row is counted alone, so repeated rows,
    ties and other columns make no difference, and an empty table gives no rows. A
    text is read by one task, in memory in proportion to its length.
    """
    fields = [docs.schema[c] for c in keep]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    schema += "n_bytes long, n_tokens long, over_limit boolean"
    rows = docs.select(*[c for c in keep if c != "text"], F.col("text").alias(TEXT))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in steps(batches, TEXT, SMALL_STEP):
            data, offsets = flat(batch.column(TEXT))
            tokens = machine.count(data, offsets)
            columns = [batch.column(TEXT if c == "text" else c) for c in keep]
            columns += [pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(
                columns, [*keep, "n_bytes", "n_tokens", "over_limit"]
            )

    return rows.mapInArrow(count, schema)
