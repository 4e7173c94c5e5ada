"""From documents to packed sequences, in stages.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return documents
with the columns they came with; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm import exact, jaccard, langid, mixing, packing
from burstline.llm.queries import remainder, tokenizer_path
from burstline.llm.repeats import stored

#: Code length, in bits a byte, beyond which a text is in no language that was learnt.
MOST_BITS = 6.5

#: Packing and the seeded mix have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter, and those in no language of the corpus."""
    model = langid.train(docs.filter(remainder(4) != 2))
    own = {c: c if c == "text" else f"own_{i}" for i, c in enumerate(docs.columns)}
    found = langid.predict(docs.withColumnsRenamed(own), model, tuple(own.values()))
    kept = found.filter(
        (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("bits_per_byte") <= MOST_BITS)
    )
    return kept.select(*[F.col(new).alias(old) for old, new in own.items()])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal without white space, one stays."""
    return exact.keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shared shingles, the smallest id stays."""
    return jaccard.keep_one_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
