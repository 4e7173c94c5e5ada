"""TF-IDF weights of the terms of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from burstline.operators.joins import left_join_split_hot
from burstline.sources.layout import stored

#: Words that a task counts or joins, about 150 bytes each while it holds them.
WORDS_PER_TASK = 1 << 21


def term_frequencies(tokens: DataFrame, id_col: str = "post_id") -> DataFrame:
    """Occurrences of each term in each document: ``id, term, tf``."""
    return (
        tokens.select(id_col, F.explode_outer("tokens").alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy(id_col, "term")
        .agg(F.count("*").alias("tf"))
    )


def document_frequencies(tf: DataFrame) -> DataFrame:
    """Number of documents per term: ``term, df``."""
    # Reading ``tf`` keeps its columns as they are, so their shuffle is reused.
    return tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def tfidf(
    tokens: DataFrame, id_col: str = "post_id", words_per_task: int = WORDS_PER_TASK
) -> DataFrame:
    """``id, term, tf, df, weight`` with weight ``tf * ln((N + 1) / (df + 1))``.

    ``N`` counts all rows of ``tokens``. A term of nearly every document would
    put its rows into one task if joined by shuffle alone, so the join splits
    the frequent terms off. The tokens are stored and counted first, and dealt to as
    many tasks as leave each ``words_per_task`` of them, so that a task's memory
    doesn't grow with the table.
    """
    seen = Observation()
    size = F.coalesce(F.array_size("tokens"), F.lit(0))
    kept = tokens.select(id_col, "tokens").observe(
        seen, F.count("*").alias("documents"), F.sum(size).alias("words")
    )
    tokens = stored(kept, "tokens")
    tasks = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, (seen.get["words"] or 0) // words_per_task + 1)

    tf = term_frequencies(tokens.repartition(tasks, id_col), id_col)
    df = document_frequencies(tf)
    joined = left_join_split_hot(tf, df, ["term"], df, weight="df", tasks=tasks)
    idf = F.ln((F.lit(seen.get["documents"]) + 1) / (F.col("df") + 1))
    return joined.select(id_col, "term", "tf", "df", (F.col("tf") * idf).alias("weight"))
