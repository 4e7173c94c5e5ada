"""How the sources of each language differ in their use of words.

Every group of documents, a (language, source), gives each kept term a smoothed
share ``p`` in exact integers. Two results are ranked: for each group the distance
to every other source of the language, and the terms it uses most above the
language.

A share depends on counts only. So the terms of a group are taken together by
(group count, language count): the value is worked out once per such cell, cells
with equal values are merged, the values are ranked by how many terms they stand
for, and only those among the first ranks are expanded into terms again.

Distances need the counts of two groups for the same term. Blocks of a language's
terms become matrices of terms by sources, whose columns are compared in place; no
pair of sources is emitted per term. A block's distances are sums over its terms,
and add up over blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstline.llm.repeats import stored
from burstline.llm.textbytes import LOWER, flat, mix, steps
from burstline.llm.wordkeys import number_words, runs, strings, text_key, word_keys

#: A term byte is an ASCII letter or a byte of another character.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SCALE, SMOOTH = 1_000_000_000, 5
#: Bytes of text that are counted before anything is sent on.
STEP = 8 << 20
#: Bits of the filter of kept terms: 4 MB, whatever the number of terms.
FILTER_BITS = 1 << 25
#: Counts in a block of terms, and sources that one task compares with all others.
BLOCK_COUNTS, TILE = 200_000, 512


def _count_step(batch: pa.RecordBatch, filtered: np.ndarray | None) -> pa.RecordBatch:
    """``lang, source, term, key, count, docs``: a row per group and term of one step.

    With ``filtered`` only terms that the filter lets through are counted; without
    it sources are not told apart.
    """
    data, offsets = flat(batch.column("text"))
    data = LOWER[data]
    starts, ends, first = runs(LETTER[data], offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    lang, langs = pd.factorize(batch.column("lang").to_pandas())
    source, sources = pd.factorize(batch.column("source").to_pandas())
    own = np.array([text_key(x) for x in langs], np.uint64)
    keys = mix(word_keys(data, starts, ends) ^ own[lang[doc]])
    if filtered is not None:
        place = _filter_place(keys)
        bit = filtered[place >> 3] >> (place & 7).astype(np.uint8)
        kept = np.flatnonzero(bit & 1)
        starts, ends, doc, keys = starts[kept], ends[kept], doc[kept], keys[kept]
    else:
        source = np.zeros_like(source)
    term, sample = number_words(data, starts, ends, lang[doc])
    terms = max(1, len(sample))
    per_doc, uses = np.unique(doc * terms + term, return_counts=True)
    at, term = np.divmod(per_doc, terms)
    groups, which = np.unique(source[at] * terms + term, return_inverse=True)
    group, term = np.divmod(groups, terms)
    words = strings(data, starts[sample], ends[sample])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()).take(pa.array(lang[doc[sample]][term])),
            pa.array(sources, pa.string()).take(pa.array(group)),
            words.take(pa.array(term)),
            pa.array(keys[sample][term].view(np.int64)),
            pa.array(np.bincount(which, uses, len(groups)).astype(np.int64)),
            pa.array(np.bincount(which, minlength=len(groups)).astype(np.int64)),
        ],
        ["lang", "source", "term", "key", "count", "docs"],
    )


def _filter_place(keys: np.ndarray) -> np.ndarray:
    """The bit of the filter that belongs to a key."""
    return (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def term_counts(docs: DataFrame, filtered: np.ndarray | None = None) -> DataFrame:
    """Counted terms of ``docs`` (``text, lang, source``, no nulls), not yet added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, most=STEP):
            yield _count_step(batch, filtered)

    columns = "lang string, source string, term string, key long, count long, docs long"
    return docs.mapInArrow(count, columns)


def term_filter(terms: DataFrame) -> np.ndarray:
    """A bitmap of the terms' ``key``; its size is fixed, so it can go to every task."""
    # the functions number places from 1
    place = F.col("key").bitwiseAND(FILTER_BITS - 1) + 1
    parts = terms.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in parts.collect():
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        begin = (row["bucket"] - 1) * len(bits)
        out[begin : begin + len(bits)] = bits
    return out


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms))``, exactly."""
    up = (count + SMOOTH).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    down = (total + terms * SMOOTH).cast("decimal(19,0)")
    return F.call_function("div", up, down) + 1


def divergence(docs: DataFrame, least_docs: int = 30, most_terms: int = 50) -> DataFrame:
    """Distances of sources and their own terms: ``lang, source, part, item, value, rank``.

    ``docs`` has ``text, lang, source``; null counts as empty in each, other columns
    are not read, and repeated rows count as often as they occur. Terms are runs of
    ASCII letters, lower-cased, and of other characters; a language keeps those in at
    least ``least_docs`` of its documents. Part ``pair`` ranks the other sources of the
    language by the summed difference of their shares, all of them, with value 0 where the
    language keeps no term; part ``term`` the first ``most_terms`` terms by how much
    their share in the group is above that in the language. Ties go to the smaller
    item in UTF-8 order. An empty table gives no rows.

    The number of rows of part ``pair`` is quadratic in a language's sources, and so
    is the work for a block of terms, of which a task does a tile of sources.
    """
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = stored(
        term_counts(texts).groupBy("lang", "term", "key")
        .agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs),
        "terms",
    )
    counts = stored(
        term_counts(texts, term_filter(kept))
        .join(kept.select("lang", "term", "lang_count"), ["lang", "term"])
        .groupBy("lang", "source", "term", "lang_count").agg(F.sum("count").alias("count")),
        "counts",
    )
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = stored(
        texts.select("lang", "source").distinct()
        .join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .na.fill(0, ["terms", "lang_total", "total"]),
        "groups",
    )
    return source_distances(counts, groups).unionByName(own_terms(counts, groups, most_terms))


def own_terms(counts: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """Part ``term``: cells of equal counts are valued, ranked, and the first expanded."""
    cells = counts.groupBy("lang", "source", "count", "lang_count").agg(F.count("*").alias("terms_here"))
    value = share(F.col("count"), F.col("total"), F.col("terms")) - share(
        F.col("lang_count"), F.col("lang_total"), F.col("terms")
    )
    valued = (
        cells.join(groups, ["lang", "source"])
        .select("lang", "source", "count", "lang_count", "terms_here", value.alias("value"))
        .filter("value > 0")
    )
    group = Window.partitionBy("lang", "source")
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("terms_here").alias("terms_here"))
    # a value stands for one term at least, so ``most`` values are enough
    first = merged.withColumn("place", F.row_number().over(group.orderBy(F.desc("value")))).filter(
        F.col("place") <= most
    )
    before = F.sum("terms_here").over(group.orderBy(F.desc("value"))) - F.col("terms_here")
    chosen = first.withColumn("before", before).filter(F.col("before") < most)
    wanted = valued.join(chosen.select("lang", "source", "value"), ["lang", "source", "value"]).select(
        "lang", "source", "count", "lang_count", "value"
    )
    expanded = counts.join(wanted, ["lang", "source", "count", "lang_count"])
    rank = F.row_number().over(group.orderBy(F.desc("value"), F.asc("term")))
    return (
        expanded.withColumn("rank", rank).filter(F.col("rank") <= most)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def source_distances(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Part ``pair``: the distance of every two sources of a language."""
    # as many blocks as a language's counts fill, and as many tiles as its sources
    blocks = counts.groupBy("lang").agg((F.expr(f"count(*) div {BLOCK_COUNTS}") + 1).alias("blocks"))
    tiles = groups.groupBy("lang").agg((F.expr(f"(count(*) - 1) div {TILE}") + 1).alias("tiles"))
    sizes = stored(
        tiles.join(blocks, "lang", "left").na.fill(1, ["blocks"]), "sizes"
    )
    none = share(F.lit(0), F.col("total"), F.col("terms"))
    shares = counts.join(groups, ["lang", "source"]).join(sizes, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
        "source", "term",
        share(F.col("count"), F.col("total"), F.col("terms")).alias("p"),
    )
    # a term that a source never uses has this share there; every block gets it
    absent = groups.join(sizes, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "tiles",
        "source", F.when(F.col("terms") > 0, none).otherwise(0).alias("p"),
    ).select(
        "lang", "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "source",
        F.lit(None).cast("string").alias("term"), "p",
    )

    def compare(key, rows: pd.DataFrame) -> pd.DataFrame:
        lang, _, tile = key
        base = rows[rows["term"].isna()].sort_values("source", ignore_index=True)
        used = rows[rows["term"].notna()]
        names = base["source"].to_numpy()
        begin, end = int(tile) * TILE, min((int(tile) + 1) * TILE, len(names))
        column = pd.Index(names).get_indexer(used["source"])
        line, terms = pd.factorize(used["term"])
        order = np.argsort(line, kind="stable")
        line, column, p = line[order], column[order], used["p"].to_numpy()[order]
        total = np.zeros((end - begin, len(names)), np.int64)
        rows_at_once = max(1, (1 << 20) // max(1, len(names)))
        bounds = np.searchsorted(line, np.arange(0, len(terms) + rows_at_once, rows_at_once))
        for k, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
            size = min(rows_at_once, len(terms) - k * rows_at_once)
            matrix = np.repeat(base["p"].to_numpy()[None, :], size, 0)
            matrix[line[low:high] - k * rows_at_once, column[low:high]] = p[low:high]
            for i in range(begin, end):
                total[i - begin] += np.abs(matrix - matrix[:, i : i + 1]).sum(0)
        one, other = np.divmod(np.arange(total.size), max(1, len(names)))
        different = one + begin != other
        return pd.DataFrame(
            {"lang": lang, "source": names[one + begin][different], "item": names[other][different],
             "value": total.ravel()[different]}
        )

    parts = shares.unionByName(absent).groupBy("lang", "block", "tile").applyInPandas(
        compare, "lang string, source string, item string, value long"
    )
    summed = parts.groupBy("lang", "source", "item").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return summed.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )
