"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``order`` bytes. A byte that
was seen after a context costs its share of that context's counts; one that was
not costs the escape, as likely as the number of distinct bytes seen there, and
then what it costs after the next shorter context, down to all bytes alike. The
counts are frozen after training, so a text's code length is the sum of the costs
of its bytes, each of which depends on the ``order`` bytes before it alone. The
shortest code names the language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.textbytes import SMALL_STEP, flat, lowest_share, mix, steps

#: Label of texts without a letter.
UNDETERMINED = "und"
#: Names of columns that only travel with a batch.
TEXT, LETTER = "burstline_text", "burstline_letter"


def grams(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """For each byte the last ``size`` bytes up to it as a number, zeros before a text."""
    out = data.astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(1, size):
        before = np.zeros(len(data), np.uint64)
        before[back:] = data[: len(data) - back]
        before[place < back] = 0
        out |= before << np.uint64(8 * back)
    return out


def count_grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(grams(data, offsets, order + 1), return_counts=True)


class ContextTree:
    """Frozen counts of one language: distinct grams of ``order + 1`` bytes."""

    def __init__(self, full: np.ndarray, counts: np.ndarray, order: int):
        self.order, self.levels = order, []
        for k in range(order + 1):  # contexts of k bytes
            kept = np.uint64((1 << 8 * (k + 1)) - 1)
            gram, where = np.unique(full & kept, return_inverse=True)
            count = np.bincount(where, counts).astype(np.float64)
            context, owner = np.unique(gram >> np.uint64(8), return_inverse=True)
            total, kinds = np.bincount(owner, count), np.bincount(owner)
            self.levels.append((gram, count, context, total, kinds))

    def cost(self, full: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each gram takes after the bytes before it."""
        probability = np.full(len(full), 1 / 256)
        for k, (gram, count, context, total, kinds) in enumerate(self.levels):
            if not len(gram):
                continue
            part = full & np.uint64((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(context, part >> np.uint64(8)), len(context) - 1)
            known = context[at] == part >> np.uint64(8)
            mass = total[at] + kinds[at]
            hit = np.minimum(np.searchsorted(gram, part), len(gram) - 1)
            seen = gram[hit] == part
            escaped = probability * kinds[at] / mass
            probability = np.where(seen, count[hit] / mass, np.where(known, escaped, probability))
        return -np.log2(probability)


class Model:
    """Context trees of all languages, with the costs of the trained grams tabled."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int):
        self.languages = sorted(counts)
        self.order = order
        self.trees = [ContextTree(*counts[x], order) for x in self.languages]
        every = [counts[x][0] for x in self.languages]
        known = np.unique(np.concatenate([*every, np.empty(0, np.uint64)]))
        self.bits = max(10, int(len(known) * 4).bit_length())
        slots = (mix(known) >> np.uint64(64 - self.bits)).astype(np.int64)
        self.gram = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.gram[slots] = known
        costs = np.array([tree.cost(self.gram) for tree in self.trees], np.float32)
        self.costs = costs.reshape(len(self.languages), len(self.gram))

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language, one row per language."""
        out = np.zeros((len(self.languages), len(offsets) - 1))
        if not len(data) or not self.languages:
            return out
        full = grams(data, offsets, self.order + 1)
        slots = (mix(full) >> np.uint64(64 - self.bits)).astype(np.int64)
        miss = np.flatnonzero(self.gram[slots] != full)
        odd, where = np.unique(full[miss], return_inverse=True)
        some = np.flatnonzero(np.diff(offsets))
        for i, tree in enumerate(self.trees):
            cost = self.costs[i][slots].astype(np.float64)
            cost[miss] = tree.cost(odd)[where]
            out[i, some] = np.add.reduceat(cost, offsets[some])
        return out


def train(
    labelled: DataFrame, order: int = 3, sample_docs: int = 400, seed: int = 7,
    most_bytes: int = 4_000_000,
) -> Model:
    """Learn from rows with ``text`` and a non-null ``lang``.

    The model is fitted on a bounded sample: of each language about
    ``sample_docs`` documents, those whose hash of id and seed lies below the
    share that makes so many, taken whole while they are at most ``most_bytes``
    together. Null and empty texts are left out. Without any row the model knows
    no language.
    """
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))
    rows = labelled.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", "text", hashed.alias("place")
    )
    counts = rows.groupBy("lang").count().collect()
    below = F.lit(False)
    for r in counts:
        share = sample_docs / r["count"]
        below |= (F.col("lang") == r["lang"]) & lowest_share(F.col("place"), share)
    sample = rows.filter(below)

    def count(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "text"], ignore_index=True)
        size = pdf["text"].str.encode("utf-8").str.len().cumsum()
        texts = pdf["text"][(size <= most_bytes) | (pdf.index == 0)]
        gram, n = count_grams(*flat(pa.array(texts, pa.large_string())), order)
        return pd.DataFrame({"lang": key[0], "gram": [gram.tobytes()], "n": [n.astype("<i8").tobytes()]})

    counted = sample.groupBy("lang").applyInPandas(count, "lang string, gram binary, n binary")
    return Model(
        {
            r["lang"]: (np.frombuffer(r["gram"], np.uint64), np.frombuffer(r["n"], np.int64))
            for r in counted.collect()
        },
        order,
    )


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``bits_per_byte`` to the columns ``keep``.

    Every whole text is scored. ``score`` is the share of the predicted language
    in likelihoods of the text shortened to at most 64 bytes' worth of evidence,
    so that it says how clear the choice is. A null text and one without any letter is
    ``und`` with score 0, and so is every text under a model without languages.
    Ties go to the first label. Repeated rows are scored alike.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    def score(batches: Iterator[pa.RecordBatch]):
        own = shared.value
        for batch in steps(batches, TEXT, SMALL_STEP):
            data, offsets = flat(batch.column(TEXT))
            bits = own.code_lengths(data, offsets)
            size = np.maximum(np.diff(offsets), 1)
            lettered = batch.column(LETTER).to_numpy(zero_copy_only=False).astype(bool)
            if own.languages:
                best = bits.argmin(0)
                least = bits.min(0)
                spread = np.exp2(-(bits - least) / np.maximum(1, size / 64))
                sure = 1 / spread.sum(0)
                labels = np.array(own.languages, object)[best]
            else:
                least, sure = np.zeros(len(size)), np.zeros(len(size))
                labels, lettered = np.full(len(size), UNDETERMINED, object), lettered & False
            labels = np.where(lettered, labels, UNDETERMINED)
            columns = [batch.column(TEXT if c == "text" else c) for c in keep] + [
                pa.array(labels, pa.string()),
                pa.array(np.where(lettered, sure, 0.0)),
                pa.array(least / size),
            ]
            names = [*keep, "lang_pred", "score", "bits_per_byte"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        *[c for c in keep if c != "text"], F.col("text").alias(TEXT), letter.alias(LETTER)
    )
    return rows.mapInArrow(score, f"{schema}, lang_pred string, score double, bits_per_byte double")
