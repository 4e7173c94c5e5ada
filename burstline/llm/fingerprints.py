"""Document fingerprints as invertible Bloom lookup sketches, in native expressions.

A text is the set of the digests of its paragraphs. A sketch has three tables of
``WIDTH`` cells; each digest falls in one cell of each table, and a cell holds the
number of its digests, their exclusive or, and that of their checks. Sketches of
two versions subtract cell by cell, so that common digests vanish. A cell with one
digest left shows it; taking it out of its other cells may free more: peeling
recovers the digests that differ, unless there are too many. Then the pair is
tried again with a larger sketch, cut into blocks so that peeling stays linear,
and blocks that fail again are tried with larger ones of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstline.llm.repeats import stored

TABLES = 3
#: Cells of each table of a fingerprint, and of each block of a larger sketch.
WIDTH = 4
#: Digests of both sides that a block of the first larger sketch holds on average.
LOAD = 4
#: Attempts with larger sketches.
RETRIES = 6

_ZERO = "named_struct('c', 0, 'k', 0L, 'h', 0L)"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use).getItem(0)


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs; null counts as empty.

    A paragraph ends at a line end, or at a mark that ends a sentence and is
    followed by white space, so that short texts have several.
    """
    parts = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+|\n")
    parts = F.filter(parts, lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(key: Column, level: Column) -> Column:
    return F.xxhash64(key, level, F.lit(7)).bitwiseAND(0xFFFFFFFF)


def _item(key: Column, sign: Column, level: Column) -> Column:
    """A digest with its cells, as the bits of a number, and check at a level of attempts."""
    spots = [
        (F.lit(t * WIDTH) + F.pmod(F.xxhash64(key, level, F.lit(100 + t)), F.lit(WIDTH))).cast("int")
        for t in range(TABLES)
    ]
    bits = [F.call_function("shiftleft", F.lit(1), spot) for spot in spots]
    return F.struct(
        key.alias("k"), sign.alias("s"), _check(key, level).alias("h"),
        reduce(Column.bitwiseOR, bits).alias("bits"),
    )


def _empty() -> Column:
    return F.expr(f"array_repeat({_ZERO}, {TABLES * WIDTH})")


def _put(cells: Column, item: Column) -> Column:
    """Cells with one more digest; taking one out is putting it with its sign reversed."""

    def cell(x: Column, i: Column) -> Column:
        hit = F.getbit(item["bits"], i) == F.lit(1).cast("tinyint")
        more = F.struct(
            (x["c"] + item["s"]).alias("c"), x["k"].bitwiseXOR(item["k"]).alias("k"),
            x["h"].bitwiseXOR(item["h"]).alias("h"),
        )
        return F.when(hit, more).otherwise(x)

    return F.transform(cells, cell)


def sketch(keys: Column) -> Column:
    """The cells of a set of digests."""
    items = F.transform(keys, lambda k: _item(k, F.lit(1), F.lit(0)))
    return F.aggregate(items, _empty(), _put)


def subtract(a: Column, b: Column) -> Column:
    """Cells of the difference of two sketches."""
    return F.zip_with(
        a, b,
        lambda x, y: F.struct(
            (x["c"] - y["c"]).alias("c"), x["k"].bitwiseXOR(y["k"]).alias("k"),
            x["h"].bitwiseXOR(y["h"]).alias("h"),
        ),
    )


def peel(cells: Column, most: Column, level: Column) -> Column:
    """Take single digests out of the cells: ``cells, found`` (digests with their sides).

    ``most`` bounds the digests. Peeling is complete if all cells end empty.
    """
    start = F.struct(
        cells.alias("cells"),
        F.expr("cast(array() as array<struct<k: bigint, s: int>>)").alias("found"),
        F.lit(False).alias("stuck"),
    )

    def step(state: Column, _: Column) -> Column:
        single = F.filter(
            state["cells"],
            lambda x: (F.abs(x["c"]) == 1) & (_check(x["k"], level) == x["h"]),
        )

        def take(own: Column) -> Column:
            first = own.getItem(0)
            out = _let(
                _item(first["k"], -first["c"], level), lambda item: _put(state["cells"], item)
            )
            one = F.array(F.struct(first["k"].alias("k"), first["c"].alias("s")))
            more = F.struct(
                out.alias("cells"), F.concat(state["found"], one).alias("found"),
                F.lit(False).alias("stuck"),
            )
            stuck = F.struct(
                state["cells"].alias("cells"), state["found"].alias("found"),
                F.lit(True).alias("stuck"),
            )
            return F.when(F.size(own) > 0, more).otherwise(stuck)

        return F.when(state["stuck"], state).otherwise(_let(single, take))

    bounded = F.sequence(F.lit(1), F.least(F.greatest(most, F.lit(1)), F.lit(3 * TABLES * WIDTH)))
    return F.aggregate(bounded, start, step)


def _blank(cells: Column) -> Column:
    return F.forall(cells, lambda x: (x["c"] == 0) & (x["k"] == 0) & (x["h"] == 0))


def _attempt(items: Column, level: Column) -> Column:
    """One larger sketch: ``found`` digests, and the items of the blocks that failed.

    ``items`` are digests with a side of 1 or -1. They are dealt to blocks by a
    hash and put in order of their blocks; a block is peeled when the next begins.
    """
    blocks = F.when(level == 1, F.ceil(F.size(items) / LOAD)).otherwise(F.size(items))
    dealt = _let(
        F.greatest(blocks, F.lit(1)).cast("long"),
        lambda n: F.array_sort(
            F.transform(
                items,
                lambda x: F.struct(
                    F.pmod(F.xxhash64(x["k"], level), n).alias("b"),
                    x["k"].alias("k"), x["s"].alias("s"),
                ),
            )
        ),
    )

    def scan(ordered: Column) -> Column:
        end = F.array(
            F.struct(F.lit(2**62).alias("b"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("s"))
        )
        start = F.struct(
            F.lit(-1).cast("long").alias("b"), _empty().alias("cells"), F.lit(0).alias("n"),
            F.expr("cast(array() as array<struct<k: bigint, s: int>>)").alias("found"),
            F.expr("cast(array() as array<bigint>)").alias("failed"),
        )

        def step(state: Column, x: Column) -> Column:
            put = _let(_item(x["k"], x["s"], level), lambda i: _put(state["cells"], i))
            grown = F.struct(
                state["b"].alias("b"), put.alias("cells"), (state["n"] + 1).alias("n"),
                state["found"].alias("found"), state["failed"].alias("failed"),
            )
            fresh = _let(_item(x["k"], x["s"], level), lambda i: _put(_empty(), i))

            def close(done: Column) -> Column:
                whole = _blank(done["cells"])
                return F.struct(
                    x["b"].alias("b"), fresh.alias("cells"), F.lit(1).alias("n"),
                    F.when(whole, F.concat(state["found"], done["found"]))
                    .otherwise(state["found"]).alias("found"),
                    F.when(whole, state["failed"])
                    .otherwise(F.concat(state["failed"], F.array(state["b"]))).alias("failed"),
                )

            closed = _let(peel(state["cells"], state["n"], level), close)
            return F.when(x["b"] == state["b"], grown).otherwise(closed)

        final = F.aggregate(F.concat(ordered, end), start, step)
        return _let(
            final,
            lambda s: F.struct(
                s["found"].alias("found"),
                F.transform(
                    F.when(F.size(s["failed"]) == 0, F.slice(ordered, 1, 0)).otherwise(
                        F.filter(ordered, lambda x: F.array_contains(s["failed"], x["b"]))
                    ),
                    lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s")),
                ).alias("left"),
            ),
        )

    return _let(dealt, scan)


def differing(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """Digests in one of two sets, as structs of ``k`` and ``s`` (1: in a, -1: in b).

    Tries the two fingerprints first, then larger sketches of what failed. What
    no attempt resolves, of which ``RETRIES`` leave practically nothing, is
    settled from the digests.
    """
    none = F.expr("cast(array() as array<struct<k: bigint, s: int>>)")

    def larger(first: Column) -> Column:
        signed = F.concat(
            F.transform(a, lambda k: F.struct(k.alias("k"), F.lit(1).alias("s"))),
            F.transform(b, lambda k: F.struct(k.alias("k"), F.lit(-1).alias("s"))),
        )
        start = F.struct(none.alias("found"), signed.alias("left"))

        def retry(state: Column, level: Column) -> Column:
            return F.when(F.size(state["left"]) == 0, state).otherwise(
                _let(
                    _attempt(state["left"], level),
                    lambda r: F.struct(
                        F.concat(state["found"], r["found"]).alias("found"), r["left"].alias("left")
                    ),
                )
            )

        tried = F.aggregate(F.sequence(F.lit(1), F.lit(RETRIES)), start, retry)

        def settle(state: Column) -> Column:
            both = F.array_intersect(
                F.transform(F.filter(state["left"], lambda x: x["s"] == 1), lambda x: x["k"]),
                F.transform(F.filter(state["left"], lambda x: x["s"] == -1), lambda x: x["k"]),
            )
            rest = F.filter(state["left"], lambda x: ~F.array_contains(both, x["k"]))
            return F.when(F.size(state["left"]) == 0, state["found"]).otherwise(
                F.concat(state["found"], rest)
            )

        return F.when(_blank(first["cells"]), first["found"]).otherwise(_let(tried, settle))

    # sizes too far apart leave more digests than the cells can hold
    hopeless = F.abs(F.size(a) - F.size(b)) > TABLES * WIDTH
    most = F.when(hopeless, F.lit(1)).otherwise(F.size(a) + F.size(b))
    return _let(peel(subtract(cells_a, cells_b), most, F.lit(0)), larger)


def likeness(a: Column, b: Column, difference: Column) -> Column:
    """Shared part of the union of two sets, from the number of differing digests."""
    total = F.size(a) + F.size(b)
    apart = F.size(difference)
    return F.when(total == 0, F.lit(1.0)).otherwise((total - apart) / (total + apart))


def render(keys: Column, cells: Column) -> Column:
    """A fingerprint as text: number of paragraphs, then the cells in hexadecimal."""
    cell = F.transform(
        cells,
        lambda x: F.concat(
            F.lpad(F.hex(x["c"]), 8, "0"), F.lpad(F.hex(x["k"]), 16, "0"),
            F.lpad(F.hex(x["h"]), 8, "0"),
        ),
    )
    return F.lower(F.concat(F.size(keys).cast("string"), F.lit(":"), F.array_join(cell, "")))


def parse(fingerprint: Column) -> Column:
    """The cells of a fingerprint in text form."""
    body = F.substring_index(fingerprint, ":", -1)

    def cell(i: Column) -> Column:
        def number(start: int, size: int) -> Column:
            return F.conv(F.substr(body, i * 32 + F.lit(start), F.lit(size)), 16, -10).cast("long")

        return F.struct(
            number(1, 8).cast("int").alias("c"), number(9, 16).alias("k"), number(25, 8).alias("h")
        )

    return F.transform(F.sequence(F.lit(0), F.lit(TABLES * WIDTH - 1)), cell)


def next_rows(rows: DataFrame, order: list[str], key: str) -> DataFrame:
    """``key, next_key``: each row's successor by ``order``, the first after the last.

    Rows are sorted by ranges; within a range the window function finds the next
    row, and the last of a range takes the first of the following one. The only
    step in one task has a row per range. ``key`` is unique.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(
        rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()),
        "ordered",
    )
    firsts = dealt.groupBy("range").agg(F.min(F.struct(*dict.fromkeys([*order, key]))).alias("x"))
    firsts = firsts.select("range", F.col(f"x.{key}").alias("first"))
    by_range = Window.orderBy("range")
    everything = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(
        "range",
        F.coalesce(F.lead("first").over(by_range), F.first("first").over(everything)).alias("after"),
    )
    own = Window.partitionBy("range").orderBy(*order)
    return dealt.withColumn("n", F.lead(key).over(own)).join(after, "range").select(
        key, F.coalesce("n", "after").alias("next_key")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, paragraphs, fingerprint`` of every row; equal texts have equal ones."""
    keys = docs.select("doc_id", digests(F.col("text")).alias("paragraphs"))
    return keys.select("doc_id", "paragraphs", render(F.col("paragraphs"), sketch(F.col("paragraphs"))).alias("fingerprint"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Compare every text with an edited version of it and with the next document.

    The edited version has the last ``floor(n_chars / 2)`` code points replaced
    by the first as many (or all) of the next document, by ascending ``doc_id``;
    after the last comes the first. A null id comes last; rows with one id follow
    each other by a hash of their text, and equal rows count once in this order
    and have equal results. A null text is empty. Two empty texts are alike (1), an
    empty and another are not (0). Returns a row per row of ``docs``: ``doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_differing, n_differing_next``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.xxhash64(F.col("doc_id").cast("string"), text).alias("uid"), "doc_id", text.alias("text")
    )
    slim = rows.select(
        "uid", F.col("doc_id").isNull().alias("nameless"), "doc_id",
        F.char_length("text").alias("n_chars"),
    ).dropDuplicates(["uid"])
    chain = next_rows(slim.drop("n_chars"), ["nameless", "doc_id", "uid"], "uid")
    asked = stored(
        slim.join(chain, "uid").select(
            "next_key", F.col("uid").alias("asker"), F.floor(F.col("n_chars") / 2).alias("half")
        ),
        "asked",
    )
    # a text's digests and sketch go with it, as both it and the one before it need them
    made = rows.withColumn("keys", digests(F.col("text"))).withColumn("cells", sketch(F.col("keys")))
    texts = made.groupBy("uid").agg(
        F.first(F.struct("text", "doc_id", "keys", "cells")).alias("row"), F.count("*").alias("times")
    )
    # a condition on all columns, so that both uses of the texts share one shuffle
    texts = texts.filter("times > 0").select(
        "uid", "row.text", "row.doc_id", "row.keys", "row.cells", "times"
    )
    given = texts.join(asked, texts["uid"] == asked["next_key"]).select(
        F.col("asker").alias("uid"),
        F.substr("text", F.lit(1), F.col("half").cast("int")).alias("given"),
        F.col("keys").alias("x"), F.col("cells").alias("cx"),
    )
    n = F.char_length("text")
    kept = F.substr("text", F.lit(1), (n - F.floor(n / 2)).cast("int"))
    both = texts.join(given, "uid").withColumn("edited", F.concat(kept, F.col("given")))
    keys = both.select(
        "doc_id", "times", n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("keys").alias("a"), digests(F.col("edited")).alias("e"), "x",
        F.col("cells").alias("ca"), "cx",
    )
    cells = keys.select("*", sketch(F.col("e")).alias("ce"))
    a, e, x = F.col("a"), F.col("e"), F.col("x")
    apart = cells.select(
        "*",
        differing(a, e, F.col("ca"), F.col("ce")).alias("de"),
        differing(a, x, F.col("ca"), F.col("cx")).alias("dx"),
    )
    out = apart.select(
        "doc_id", "n_chars", "edited_sha256", render(a, F.col("ca")).alias("fingerprint"),
        render(e, F.col("ce")).alias("edited_fingerprint"),
        likeness(a, e, F.col("de")).alias("near_edited"),
        likeness(a, x, F.col("dx")).alias("near_next"),
        F.size("de").cast("long").alias("n_differing"),
        F.size("dx").cast("long").alias("n_differing_next"),
        "times",
    )
    return out.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("times")))
    ).drop("copy", "times")
