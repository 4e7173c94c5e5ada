"""Data-quality reports, quarantine and stage counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.functions import text as tx
from burstline.functions import tokens as tk
from burstline.operators.terms import topical_tokens, with_cleaned_text
from burstline.sources.posts import parse_created_at


def _failures(languages: Sequence[str]) -> dict[str, Column]:
    """The row checks of projected posts: name to "this row fails"."""
    blank = F.length(tx.lower_strip(F.col("text"))) == 0
    return {
        "text_present": F.col("text").isNull(),
        "text_not_blank": F.coalesce(blank, F.lit(False)),
        "lang_present": F.col("lang").isNull(),
        "lang_accepted": F.coalesce(~F.col("lang").isin(*languages), F.lit(False)),
        "created_at_present": F.col("created_at").isNull(),
        "created_at_parses": F.col("created_at").isNotNull()
        & parse_created_at(F.col("created_at")).isNull(),
    }


def dq_report(posts: DataFrame, languages: Sequence[str]) -> DataFrame:
    """``check_name, total, failed, ratio`` for projected posts, in one aggregation.

    ``post_id_unique`` counts the copies beyond the first of each id.
    """
    failures = _failures(languages)
    measured = posts.agg(
        F.count("*").alias("total"),
        *[F.count_if(failed).alias(name) for name, failed in failures.items()],
        (F.count("post_id") - F.count_distinct("post_id")).alias("post_id_unique"),
    )
    checks = [*failures, "post_id_unique"]
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("check_name"),
                    F.col("total"),
                    F.col(name).alias("failed"),
                    F.try_divide(F.col(name), F.col("total")).alias("ratio"),
                )
                for name in checks
            ]
        )
    )
    return measured.select(rows.alias("row")).select("row.*")


def passes(languages: Sequence[str]) -> Column:
    """True for a projected post that fails no row check."""
    failed = F.lit(False)
    for check in _failures(languages).values():
        failed = failed | check
    return ~failed


def with_verdict(posts: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Add ``verdict``: ``accepted`` for posts that pass all checks, else ``rejected``."""
    return posts.withColumn(
        "verdict", F.when(passes(languages), "accepted").otherwise("rejected")
    )


def normalise_columns(posts: DataFrame) -> DataFrame:
    """Tidy projected posts: trimmed text, lower-case language, parsed time.

    A missing text becomes empty and a missing language ``unknown``.
    """
    text = F.btrim(F.col("text"), F.lit(tx.SPACE_CHARS))
    return posts.select(
        "post_id",
        F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(tx.lower_strip(F.col("lang")), F.lit("unknown")).alias("lang"),
        parse_created_at(F.col("created_at")).alias("created_at"),
    )


def stage_counts(projected: DataFrame, trends: DataFrame) -> DataFrame:
    """``stage, rows``: what each stage of a run lets through.

    ``projected`` is undated input; one pass over it counts what is read, dated,
    and left with tokens, and the terms.
    """
    parsed = projected.withColumn("created_at", parse_created_at(F.col("created_at")))
    dated = F.col("created_at").isNotNull()
    # undated posts are counted as read; their text is not looked at
    text = F.when(dated, F.col("text"))
    cleaned = with_cleaned_text(parsed.withColumn("text", text))
    tokens = topical_tokens(cleaned, keep=("created_at", "lang"))
    n_terms = F.size("tokens") + F.size(tk.ngrams(F.col("tokens"), 2))
    counted = tokens.agg(
        F.count("*").alias("read"),
        F.count("created_at").alias("dated"),
        F.count_if(F.size("tokens") > 0).alias("with_tokens"),
        F.sum(n_terms.cast("long")).alias("terms"),
    )
    ranked = trends.agg(F.count("*").alias("trends"))
    rows = counted.unpivot([], counted.columns, "stage", "rows").unionByName(
        ranked.unpivot([], ranked.columns, "stage", "rows")
    )
    return rows.na.fill(0, ["rows"])
