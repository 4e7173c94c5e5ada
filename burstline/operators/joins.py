"""Joins that hold up when a few keys carry most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A membership filter has at most so many bits (4 MB), and at least 64.
MOST_BITS = 1 << 25
#: Bits for each key, while the filter is below its bound.
BITS_PER_KEY = 16

# A key is hot when more than one in HOT_KEYS of all left rows carry it, so there
# are fewer than HOT_KEYS hot keys whatever the size of the data.
HOT_KEYS = 1000


def hot_keys(key_counts: DataFrame, on: list[str], weight: str = "count") -> DataFrame:
    """The keys with more than one in ``HOT_KEYS`` of all rows."""
    total = key_counts.agg(F.sum(weight)).scalar()
    return key_counts.filter(F.col(weight) * HOT_KEYS > total).select(*on)


def left_join_split_hot(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    key_counts: DataFrame,
    weight: str = "count",
    hot_right: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Left outer join of ``left`` to a ``right`` that has one row per key.

    ``key_counts`` holds, for every key of ``left``, the number of its left rows
    in ``weight``. Rows of hot keys meet their right rows, fewer than
    ``HOT_KEYS``, by broadcast; in the shuffle that joins all other rows they
    carry no key but a hash of the whole row, so that they spread over the tasks.
    Left keys must not be null. ``hot_right`` may give the rows of ``right`` with hot
    keys, and perhaps others, where they come cheaper than by computing ``right`` twice.
    ``tasks`` may give the number of tasks that join, else the session does.
    """
    added = [c for c in right.columns if c not in on]
    packed = right.select(*on, F.struct(*added).alias("_right"))
    few = packed if hot_right is None else hot_right.select(*on, F.struct(*added).alias("_right"))

    hot = hot_keys(key_counts, on, weight)
    hot_rows = hot.join(few, on, "left").select(
        *on, F.lit(True).alias("_hot"), F.col("_right").alias("_hot_right")
    )
    marked = left.join(F.broadcast(hot_rows), on, "left")

    # Both sides' spread comes from columns: a constant one would be taken out of
    # the join keys, and the hot rows' null keys would all go to one task. It is the
    # first key, as rows are sorted faster by a number that hardly ever ties.
    key_hash, row_hash = F.xxhash64(*on), F.xxhash64(*left.columns)
    shuffle_keys = [f"_key_{name}" for name in on]
    keyed = marked.select(
        "*",
        F.when(F.col("_hot"), row_hash).otherwise(key_hash).alias("_key_spread"),
        *[
            F.when(F.col("_hot").isNull(), F.col(name)).alias(key)
            for name, key in zip(on, shuffle_keys)
        ],
    )
    cold = packed.select(
        *[F.col(name).alias(key) for name, key in zip(on, shuffle_keys)],
        key_hash.alias("_key_spread"),
        F.col("_right").alias("_cold_right"),
    )
    if tasks is not None:
        keyed, cold = (x.repartition(tasks, "_key_spread", *shuffle_keys) for x in (keyed, cold))
    found = F.coalesce("_hot_right", "_cold_right")
    return (
        keyed.join(cold, ["_key_spread", *shuffle_keys], "left")
        .select(*left.columns, found.alias("_right"))
        .select(*left.columns, *[F.col(f"_right.{name}").alias(name) for name in added])
    )


def member(keys: DataFrame, number: int, key: Column) -> Column:
    """Whether the 64-bit hash ``key`` may be among the ``key`` column of ``keys``.

    A bitmap of ``number`` keys at 16 bits each, and no more than 4 MB, which every
    task gets as a literal. It lets every listed key pass and about one in 16 of the
    others, more once the bound is reached; an exact join has to follow. Rows can
    thus be dropped before they are shuffled, whatever the size of the other side.
    """
    bits = min(MOST_BITS, max(64, 1 << (BITS_PER_KEY * number - 1).bit_length()))
    place = F.col("key").bitwiseAND(bits - 1)
    slots = keys.select(place.alias("_place")).distinct().select(
        F.shiftright("_place", 6).alias("id"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_place") % 64).cast("int")).alias("_bit"),
    )
    words = slots.groupBy("id").agg(F.bit_or("_bit").alias("_bits"))
    every = keys.sparkSession.range(bits // 64).join(words, "id", "left")
    filled = F.struct("id", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))
    bitmap = every.agg(F.sort_array(F.collect_list(filled))["_bits"].alias("bitmap")).scalar()
    own = key.bitwiseAND(bits - 1)
    slot = F.get(bitmap, F.call_function("shiftright", own, F.lit(6)).cast("int"))
    return F.getbit(slot, own % 64) == 1
