"""Mixing sources to target weights by fitting their budgets.

Each source has a target of words. Whole rounds of a source are taken first. Of
the rest of its budget, every exact document length gives its share of documents;
what is then left is filled by dynamic programming over the lengths that remain,
each at most as often as documents of it remain. So far only counts per length
are handled. Last, the documents of each length are chosen by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstline.llm.repeats import row_hash
from burstline.sources.layout import work_path

#: Rest of a budget, in words, that is left to the dynamic programme at least ...
DP_WORDS = 1 << 16
#: ... and as a multiple of a source's longest document.
FEW = 8
#: Parts that the documents of one length are cut into by their hash.
PARTS = 256


def word_count(text) -> F.Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    spaces = "\t\n\x0b\x0c\r "
    text = F.coalesce(text, F.lit(""))
    plain = F.translate(text, spaces, " " * len(spaces))
    return F.size(F.filter(F.split(plain, " "), lambda w: w != "")).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, weights=(5.0, 2.0, 1.0), most: float = 2.0):
    """Words to take from each source.

    ``sizes`` has one row per source: ``source, source_size``. Sources ordered by
    code point, null last, weigh ``weights`` in turn. ``share`` of all words is
    dealt by weight; a source stops at ``most`` times its size, and the excess is
    dealt to the others by weight until none is above. Returns ``source,
    source_size, target``.

    The level of the deal rises step by step: with sources ordered by the level
    at which they are full, a source is full if dealing the rest to it and all after
    it would exceed it. From the first that is not on, these levels fall, so the
    largest of theirs is the final one.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sized = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rest = share * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    level = sized.withColumn("level", rest / open_weight)
    fits = F.col("cap") <= F.col("level") * F.col("weight")
    final = F.max(F.when(~fits, F.col("level"))).over(everything)
    first_open = level.withColumn("final", final)
    dealt = F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap")))
    return first_open.select("source", "source_size", dealt.cast("double").alias("target"))


def bounded_knapsack(
    lengths: np.ndarray, counts: np.ndarray, budget: int, above: int = 0
) -> np.ndarray:
    """How many of each length to take so that their sum is nearest to ``budget``.

    The sum is at most ``above`` more than ``budget``; of two that are equally near
    the smaller counts. A length's count is cut into powers of two, and every
    reachable sum remembers the first such part that reached it, by which the
    nearest one is traced back.
    """
    taken = np.zeros(len(lengths), np.int64)
    usable = (lengths > 0) & (counts > 0) & (lengths <= budget + above)
    if budget <= 0 or not usable.any():
        return taken
    unit = int(np.gcd.reduce(lengths[usable]))
    top, goal = (budget + above) // unit, budget // unit
    if goal < top and 2 * (budget - goal * unit) > unit:
        goal += 1  # no sum can be nearer to the budget
    reach, first, steps = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int32), []
    reach[0] = True
    for i in np.argsort(-lengths, kind="stable"):
        if not usable[i]:
            continue
        length = int(lengths[i]) // unit
        count, part = min(int(counts[i]), top // length), 1
        while count and not reach[goal]:
            part = min(part, count)
            step = part * length
            new = np.flatnonzero(reach[:-step] & ~reach[step:]) + step
            reach[new], first[new] = True, len(steps)
            steps.append((i, part))
            count -= part
            part *= 2
    sums = np.flatnonzero(reach)
    total = int(sums[np.abs(sums * unit - budget).argmin()])
    while total:
        i, part = steps[first[total]]
        taken[i] += part
        total -= part * int(lengths[i]) // unit
    return taken


def fit(
    lengths: np.ndarray, counts: np.ndarray, budget: float, most: float | None = None
) -> np.ndarray:
    """Documents to take of each length, for a budget below the sum of all.

    The same share of every length, rounded down; then single documents from
    long to short while more than a window is left; then the dynamic programme over
    all that is left, for the sum nearest to the budget but not above ``most``. The
    window is ``DP_WORDS``, or ``FEW`` of the longest documents if that is more, so
    it has room for several of any length. If the budget is not met, documents
    are handed back, long ones first, until a window is open, and the
    nearer of both results counts: a budget within one window is met as nearly as
    whole documents allow.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    size = int((lengths * counts).sum())
    budget = int(round(budget))
    if budget <= 0 or not size:
        return np.zeros(len(lengths), np.int64)
    most = size if most is None else int(most)
    longest = int(lengths[counts > 0].max())
    window = max(DP_WORDS, FEW * longest)
    from_long = [i for i in np.argsort(-lengths, kind="stable") if lengths[i] > 0]

    def left(taken: np.ndarray) -> int:
        return budget - int((lengths * taken).sum())

    def filled(taken: np.ndarray) -> np.ndarray:
        taken, rest = taken.copy(), left(taken)
        for i in from_long:
            if rest <= window:
                break
            more = min(int(counts[i] - taken[i]), (rest - window) // int(lengths[i]))
            taken[i] += more
            rest -= more * int(lengths[i])
        above = max(0, min(longest, rest, most - budget))
        return taken + bounded_knapsack(lengths, counts - taken, rest, above)

    share = np.minimum(counts, np.floor(counts * min(1.0, budget / size)).astype(np.int64))
    found = filled(share)
    if not left(found):
        return found
    fewer, rest = share.copy(), left(share)
    for i in from_long:
        if rest >= window:
            break
        back = min(int(fewer[i]), (window - rest) // int(lengths[i]))
        fewer[i] -= back
        rest += back * int(lengths[i])
    return min((found, filled(fewer)), key=lambda taken: (abs(left(taken)), -left(taken)))


def mix(docs: DataFrame, share: float = 1.5, weights=(5.0, 2.0, 1.0), most: float = 2.0,
        seed: int = 11, keep_key: bool = False) -> DataFrame:
    """Choose how often each document is taken.

    Returns one row per row of ``docs``: ``doc_id, source, size, source_size,
    target, copies, taken`` with ``taken = copies * size``. A null source is a
    source of its own; a null or empty text has size 0 and ``copies`` as its
    source's whole rounds. Of equal documents, with one id, the choice goes by
    the hash of their text; rows equal in all are exchangeable. Empty tables give
    no rows. The columns of ``docs`` other than ``doc_id, text, source`` are
    not used. With ``keep_key`` a hash of these three is added as ``key``.
    """
    spark = docs.sparkSession
    path = work_path(spark, "sizes")
    drawn = F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text"), F.lit(seed))
    docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), drawn.alias("drawn"),
        _row_key(docs).alias("key"),
    ).write.parquet(path)
    sized = spark.read.parquet(path).withColumn(
        "part", F.shiftrightunsigned("drawn", 64 - (PARTS - 1).bit_length())
    )
    parts = sized.groupBy("source", "size", "part").agg(F.count("*").alias("n"))
    lengths = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    planned = targets(sources, share, weights, most)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        rounds = int(target // size) if size else 0
        pdf = pdf.sort_values("size", ignore_index=True)
        more = fit(
            pdf["size"].to_numpy(), pdf["n"].to_numpy(), target - rounds * size,
            (most - rounds) * size,
        )
        return pdf.assign(rounds=rounds, more=more)

    same_source = lengths["source"].eqNullSafe(planned["source"])
    counted = lengths.join(planned, same_source).select(lengths["*"], "source_size", "target")
    chosen_path = work_path(spark, "chosen")
    counted.groupBy("source").applyInPandas(
        choose,
        "source string, size long, n long, source_size long, target double, rounds int, more long",
    ).write.parquet(chosen_path)
    chosen = spark.read.parquet(chosen_path)

    by_part = Window.partitionBy("source", "size").orderBy("part")
    before = F.sum("n").over(by_part) - F.col("n")
    cuts = parts.withColumn("before", before).withColumnsRenamed(
        {"source": "s", "size": "z", "part": "p", "n": "m"}
    )
    plan = chosen.join(
        cuts, chosen["source"].eqNullSafe(cuts["s"]) & (chosen["size"] == cuts["z"])
    ).select(
        "s", "z", "p", "source_size", "target", "rounds",
        F.least(F.greatest(F.col("more") - F.col("before"), F.lit(0)), F.col("m")).alias("wanted"),
        "m",
    )
    joined = sized.join(
        plan,
        sized["source"].eqNullSafe(plan["s"])
        & (sized["size"] == plan["z"]) & (sized["part"] == plan["p"]),
    )
    in_part = Window.partitionBy("source", "size", "part").orderBy("drawn", "doc_id")
    extra = (F.row_number().over(in_part) <= F.col("wanted")).cast("int")
    copies = F.col("rounds") + extra
    return joined.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), *["key"] * keep_key,
    )


def _row_key(docs: DataFrame) -> Column:
    """128 bits of hash of id, text and source, of which nulls are values of their own."""
    own = (docs["doc_id"].cast("string"), docs["text"], docs["source"])
    return F.struct(row_hash(*own).alias("a"), row_hash(*own, seed=1).alias("b"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``.

    Rows equal in ``doc_id, text, source`` are taken together, with the other
    columns of one of them.
    """
    names = list(docs.columns)
    keyed = docs.select(F.struct(*names).alias("row"), _row_key(docs).alias("key"))
    own = docs.select("doc_id", "text", "source")
    chosen = mix(own, **options, keep_key=True).groupBy("key").agg(
        F.sum("copies").alias("copies")
    )
    rows = keyed.groupBy("key").agg(F.first("row").alias("row"))
    taken = rows.join(chosen.filter("copies > 0"), "key")
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select("row", times.alias("time")).select("row.*")
