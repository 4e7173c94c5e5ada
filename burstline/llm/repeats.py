"""Shared steps of finding windows that repeat across documents.

A window is a fixed number of consecutive symbols of one text. Each window has an
anchor, a place inside it that its content alone decides; consecutive windows
with one anchor form a run. Equal windows therefore lie in runs whose anchors
have equal keys, at equal distances from the anchor. A run's variant is a hash of
all its symbols and its place about the anchor.

Runs are rows ``key, variant, uid, doc, lo, n``: the first window and how many,
of the text with hash ``uid``. A key in one run alone has no repeated window. A
key whose runs all have one variant repeats whole, and needs no text at all. Only
keys with several variants need their symbols.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.sources.layout import remove, work_path

RUNS = "key long, variant long, uid long, doc long, lo long, n int"


def row_hash(*columns: Column, seed: int = 0) -> Column:
    """64-bit hash of values that also tells which of them are null."""
    missing = [c.isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *columns, *missing)


def row_names() -> tuple[Column, Column]:
    """``doc``, a row's id with null as the largest, and ``uid``, a hash of id and text."""
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    return rank, row_hash(F.col("doc_id").cast("string"), F.col("text"))


def with_uid(docs: DataFrame) -> DataFrame:
    """``uid, doc, doc_id, text``: a row's hash, and its id with null as the largest."""
    rank, uid = row_names()
    return docs.select(uid.alias("uid"), rank.alias("doc"), "doc_id", "text")


def one_each(docs: DataFrame, keys: dict[str, Column], *order: Column) -> DataFrame:
    """One row of ``docs`` per value of ``keys``: the keys, and the row as ``row``.

    The row that is first by ``order`` is taken, and of several such the one with the
    least hash of its columns, those with maps aside; fully equal rows are
    exchangeable. Rows are reduced within each task before they are shuffled, so a
    row that is repeated very often is no hot key.
    """
    hashed = [docs[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    own = docs.select(
        *[value.alias(name) for name, value in keys.items()],
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.struct(*order, F.xxhash64(*hashed)).alias("place"),
    )
    return own.groupBy(*keys).agg(F.min_by("row", "place").alias("row"))


def write(df: DataFrame, name: str) -> str:
    """Write a table to a new folder in the shared one; its path."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it, which cuts the lineage."""
    return df.sparkSession.read.parquet(write(df, name))


def shared_runs(runs: DataFrame, keys) -> DataFrame:
    """Runs whose key others have too: ``runs`` joined with ``keys(runs)``, stored.

    The table of all runs is deleted once this one is written.
    """
    spark = runs.sparkSession
    path = write(runs, "runs")
    every = spark.read.parquet(path)
    # stored, so that the join is one of two plain tables and can split a hot key
    shared = stored(every.join(stored(keys(every), "keys"), "key"), "shared")
    remove(spark, path)
    return shared


def fetch_plan(variants: DataFrame, columns: list[str]) -> DataFrame:
    """Per text, the places of the variants to be read from it: ``uid, places``."""
    return variants.groupBy("uid").agg(F.collect_list(F.struct(*columns)).alias("places"))
