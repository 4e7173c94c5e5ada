"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm import (
    collocations,
    divergence,
    exact,
    fingerprints,
    jaccard,
    langid,
    mixing,
    packing,
    quality,
    recompression,
    suffixes,
    transducer,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(divisor: int) -> F.Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edits, with likenesses."""
    return fingerprints.edited_likeness(_table(spark, sf_dir, "documents"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, then read the archives back."""
    archives = warc.store(warc.write_archives(_table(spark, sf_dir, "pages")))
    return warc.read_records(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(remainder(4) != 2))
    held_out = docs.select("doc_id", "text", (remainder(4) == 2).alias("held_out"))
    return langid.predict(held_out, model, ("doc_id", "held_out"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix the documents' sources to 5, 2, 1 and 150 % of all words."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 4096 tokens."""
    return packing.packed(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove repeated strings of 400 bytes from all documents."""
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), 400, texts=False)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the quality of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    machine = quality.train(docs, labels.filter(remainder(3) != 1))
    held_out = docs.select("doc_id", "text", (remainder(3) == 1).alias("held_out"))
    return quality.score(held_out, machine, ("doc_id", "held_out"))


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays of every document's group of equal texts."""
    return exact.duplicate_groups(_table(spark, sf_dir, "documents"))


def op10_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove windows of 50 words that a smaller document has."""
    return recompression.remove_repeats(_table(spark, sf_dir, "documents"), 50, texts=False)


def op11_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count the tokens of every document with a compiled transducer."""
    model = tokenizer_path("piece_bpe_32k.model")
    return transducer.token_counts(_table(spark, sf_dir, "documents"), model)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language by how much their words belong together."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their terms."""
    return divergence.divergence(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_jaccard, op3_warc, op4_language, op5_mixture, op6_packing, op7_suffixes, op8_quality,
        op9_exact, op10_recompression, op11_transducer,
        op12_collocations, op13_divergence,
    )
}

ORACLE: dict[str, str] = {
    "op3_warc": """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body FROM pages
), g AS (
  SELECT body, max(page_id) AS first FROM p WHERE strlen(body) >= 1000
  GROUP BY body HAVING count(*) > 1
)
SELECT page_id, CAST(strlen(p.body) AS BIGINT) AS payload_bytes, sha1(p.body) AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, url
FROM p LEFT JOIN g ON p.body = g.body
""",
    "op12_collocations": r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), p AS (
  SELECT lang, unnest(list_transform(pieces, lambda x: regexp_extract_all(x, '[^\x20\x09]+'))) AS w FROM d
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang
), f AS (
  SELECT lang, phrase, len(string_split(phrase, ' ')) AS size, count(*) AS a FROM (
    SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k:
      list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase FROM p
  ) GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1)
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, a, array_to_string(string_split(phrase, ' ')[i:j], ' ') AS phrase
  FROM (SELECT *, unnest(range(i + 1, size + 1)) AS j FROM (SELECT *, unnest(range(1, size)) AS i FROM f WHERE size > 2))
  WHERE j - i + 1 < size
), covered AS (
  SELECT b.lang, b.phrase FROM best b JOIN inside USING (lang, phrase)
  GROUP BY b.lang, b.phrase, b.a HAVING 100 * max(inside.a) >= 80 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best ANTI JOIN covered USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op13_divergence": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS doc
  FROM documents
), uses AS (
  SELECT lang, source, doc, unnest(words) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_count FROM uses GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_count) AS lang_total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM uses SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) USING (lang, source)
), shares AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, lang_count,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (n + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_count + 5)) // (lang_total + 5 * v) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
""",
    "op9_exact": """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(body) AS text_sha256 FROM r
""",
}
