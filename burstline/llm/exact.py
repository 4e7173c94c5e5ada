"""Exact de-duplication by a Golomb-coded exchange of fingerprints.

Equal documents are found without moving their texts:

1. Every document gets a 64-bit fingerprint of its normalised text. Documents
   are dealt to chunks by their id.
2. Each chunk cuts its fingerprints by owner, sorts each part and sends it as
   one Golomb-Rice coded list of gaps.
3. An owner merges the lists of its range and answers each with a bitmap that
   marks the fingerprints that occur more than once.
4. Chunks turn the marks into suspects. Only the suspects' texts are shuffled,
   and grouped by their bytes, which settles equality.

An owner holds its range of fingerprints and never a text. A text that is
common in many chunks costs an owner one entry per chunk: a chunk sends equal
fingerprints once, with a mark when it has several itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.repeats import one_each
from burstline.sources.layout import work_path

#: Characters that do not count for equality.
WHITE = "\t\n\x0b\x0c\r "


def normalised(text) -> F.Column:
    """The text without ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def rice_encode(values: np.ndarray) -> bytes:
    """Golomb-Rice code of ascending ``uint64`` values.

    Layout: number of values (8 bytes), parameter k (1 byte), the unary parts
    as a bit string (8 bytes of length in bits, then bytes), the k low bits of
    every gap. The first gap counts from zero.
    """
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return bytes(17)
    gaps = np.diff(values, prepend=np.uint64(0))
    k = max(0, min(63, int(values[-1] // np.uint64(n)).bit_length() - 1))
    high = (gaps >> np.uint64(k)).astype(np.int64)
    stops = np.cumsum(high + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return b"".join(
        (
            n.to_bytes(8, "little"), bytes([k]), len(unary).to_bytes(8, "little"),
            np.packbits(unary).tobytes(), np.packbits(low).tobytes(),
        )
    )


def rice_decode(code: bytes) -> np.ndarray:
    """The values that ``rice_encode`` was given."""
    n, k = int.from_bytes(code[:8], "little"), code[8]
    if not n:
        return np.empty(0, np.uint64)
    bits = int.from_bytes(code[9:17], "little")
    cut = 17 + (bits + 7) // 8
    unary = np.unpackbits(np.frombuffer(code[17:cut], np.uint8), count=bits)
    high = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(code[cut:], np.uint8), count=n * k).reshape(n, k)
    gaps = high.astype(np.uint64) << np.uint64(k)
    gaps += (low.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _ranges(prints: np.ndarray, owners: int) -> tuple[np.ndarray, np.uint64]:
    """The owner of each fingerprint, and the width of an owner's range."""
    width = np.uint64(min(2**64 // owners + 1, 2**64 - 1))
    return np.minimum(prints // width, np.uint64(owners - 1)).astype(np.int64), width


def _send(owners: int):
    def send(key, rows: pd.DataFrame) -> pd.DataFrame:
        prints, counts = np.unique(
            rows["print"].to_numpy(np.int64).view(np.uint64), return_counts=True
        )
        owner, width = _ranges(prints, owners)
        out = []
        for o in np.unique(owner):
            mine = owner == o
            out.append(
                (int(o), int(key[0]), rice_encode(prints[mine] - np.uint64(o) * width),
                 np.packbits(counts[mine] > 1).tobytes())
            )
        return pd.DataFrame(out, columns=["owner", "chunk", "code", "several"])

    return send


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    lists = [rice_decode(code) for code in rows["code"]]
    several = [
        np.unpackbits(np.frombuffer(s, np.uint8), count=len(x)).astype(bool)
        for s, x in zip(rows["several"], lists, strict=True)
    ]
    values, where, counts = np.unique(
        np.concatenate(lists), return_inverse=True, return_counts=True
    )
    marked = counts > 1
    marked[where[np.concatenate(several)]] = True
    marks, begin = [], 0
    for x in lists:
        marks.append(np.packbits(marked[where[begin : begin + len(x)]]).tobytes())
        begin += len(x)
    return pd.DataFrame({"chunk": rows["chunk"], "owner": rows["owner"], "marks": marks})


def _suspects(owners: int):
    def suspects(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = rows["print"].to_numpy(np.int64).view(np.uint64)
        prints = np.unique(own)
        owner, _ = _ranges(prints, owners)
        marked = np.zeros(len(prints), bool)
        for o, marks in zip(answers["owner"], answers["marks"], strict=True):
            mine = np.flatnonzero(owner == o)
            bits = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(mine))
            marked[mine] = bits.astype(bool)
        keep = marked[np.searchsorted(prints, own)]
        return pd.DataFrame({"print": rows["print"][keep].unique()})

    return suspects


def suspect_prints(prints: DataFrame, owners: int, chunks: int) -> DataFrame:
    """The distinct values of ``print`` that occur in more than one row.

    ``prints`` has ``print`` (bigint) and ``chunk`` (int below ``chunks``).
    """
    sent = prints.groupBy("chunk").applyInPandas(
        _send(owners), "owner int, chunk int, code binary, several binary"
    )
    answers = sent.groupBy("owner").applyInPandas(
        _answer, "chunk int, owner int, marks binary"
    )
    marked = prints.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return marked.applyInPandas(_suspects(owners), "print long").distinct()


def duplicate_groups(docs: DataFrame, chunks: int | None = None) -> DataFrame:
    """For every row of ``docs``, the row of its equal-text group that stays.

    Texts are equal when they are identical without white space; null counts as
    empty. The row with the most code points in its original text stays, ties go
    to the smallest ``doc_id`` (a null id comes last); of fully equal rows, with
    the same id and length, all are kept as one. Returns ``doc_id, keep_id,
    group_size, kept, text_sha256``; an empty table gives no rows. Other columns
    of ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    chunks = chunks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    sha = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    path = work_path(spark, "prints")
    docs.select("doc_id", F.char_length(text).alias("n"), sha.alias("sha")).select(
        "*",
        F.conv(F.substring("sha", 1, 16), 16, -10).cast("long").alias("print"),
        F.pmod(F.xxhash64("doc_id", "sha"), F.lit(chunks)).cast("int").alias("chunk"),
    ).write.parquet(path)
    prints = spark.read.parquet(path)
    marked = work_path(spark, "suspects")
    suspect_prints(prints.select("print", "chunk"), chunks, chunks).write.parquet(marked)
    suspects = spark.read.parquet(marked)

    whole = docs.select("doc_id", F.char_length(text).alias("n"), normalised(F.col("text")).alias("body"))
    whole = whole.withColumn("sha", F.sha2(F.col("body").cast("binary"), 256)).withColumn(
        "print", F.conv(F.substring("sha", 1, 16), 16, -10).cast("long")
    )
    best = F.min_by("doc_id", F.struct(-F.col("n"), F.col("doc_id").isNull(), "doc_id"))
    groups = (
        whole.join(suspects, "print", "left_semi")
        .groupBy("sha", "body")
        .agg(best.alias("keep_id"), F.max("n").alias("most"), F.count("*").alias("group_size"))
        .drop("body")
    )
    return (
        prints.join(groups, "sha", "left")
        .select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id"))
            .otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (
                F.col("group_size").isNull()
                | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("most")))
            ).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each equal-text group, with all their columns.

    Rows that agree in id and normalised text are reduced to the longest of them, and
    of several such to the one whose columns have the least hash.
    """
    name, missing = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull()
    kept = duplicate_groups(docs).filter("kept").select(
        name.alias("name"), missing.alias("missing"), F.col("text_sha256").alias("sha")
    ).distinct()
    sha = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    rows = one_each(
        docs, {"name": name, "missing": missing, "sha": sha},
        -F.char_length(F.coalesce(F.col("text"), F.lit(""))),
    )
    return rows.join(kept, ["name", "missing", "sha"], "left_semi").select("row.*")
