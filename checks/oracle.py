"""The queries of ``queries.py`` as DuckDB SQL over the same tables.

Shared common table expressions are named once and put in front of the queries
that use them.
"""

from __future__ import annotations

from burstline.functions.wordlists import (
    DEFAULT_STOP_WORDS,
    DUTCH_STOP_WORDS,
    ENGLISH_STOP_WORDS,
    NOISE_WORDS,
)

ORACLE: dict[str, str] = {}

SP = r"\t-\r\x1c-\x20\x{85}\p{Z}"
WD = r"\p{L}\p{N}_"
SPACES = "||".join(
    f"chr({point})"
    for point in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680,
                  *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def words_in(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP, NOISE = words_in(DEFAULT_STOP_WORDS), words_in(NOISE_WORDS)


def s_entities(x: str) -> str:
    return f"regexp_replace({x}, '&[{WD}]+;', ' ', 'g')"


def s_urls(x: str) -> str:
    return f"regexp_replace({x}, 'http[^{SP}]+|@[{WD}]+', '', 'g')"


def s_punct(x: str) -> str:
    return rf"regexp_replace({x}, '[!?:;()<>\[\]{{}}|/\\]', '', 'g')"


def s_alnum(x: str) -> str:
    return f"regexp_replace({x}, '[^A-Za-z0-9#{SP}]', '', 'g')"


def s_strip(x: str) -> str:
    return f"trim(lower({x}), {SPACES})"


def s_clean(x: str) -> str:
    return s_strip(s_alnum(s_punct(s_urls(s_entities(x)))))


def s_noise(w: str) -> str:
    return f"({w} IN ({NOISE}) OR regexp_full_match({w}, '(ha){{2,}}h?|(hi){{2,}}'))"


def s_round(numerator: str, denominator: str) -> str:
    ratio = f"CAST(({numerator}) AS DOUBLE) / ({denominator})"
    return (
        f"CAST(round(CAST(CAST({ratio} AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"
    )


def s_route(lang: str) -> str:
    return f"CASE WHEN {lang} = 'en' THEN 'en' ELSE 'nl' END"


def s_start(ts: str, interval: str) -> str:
    return f"time_bucket(INTERVAL '1 {interval}', {ts}, TIMESTAMP '1970-01-01')"


def s_grams(tokens: str, n: int) -> str:
    parts = " || ' ' || ".join(f"{tokens}[i + {k}]" for k in range(n))
    return f"[{parts} for i in range(1, len({tokens}) - {n - 2})]"


CTES = {
    "documented": """
        SELECT event_id, ts, user_id, event_type, coalesce(text, '') AS text,
               coalesce(lang, 'en') AS lang, coalesce(source, 'none') AS source
        FROM events LEFT JOIN documents ON event_id = doc_id""",
    "posts": """
        SELECT event_id AS post_id, ts AS created_at, lang,
               'RT @u' || user_id || ': ' || text || ' &amp; #' || event_type
               || ' #' || source || ' http://t.co/' || event_id AS text
        FROM documented""",
    "cleaned": f"SELECT *, {s_clean('text')} AS cleaned_text FROM posts",
    "worded": """
        SELECT *, regexp_extract_all(cleaned_text, '[a-z0-9]+') AS words,
               regexp_extract_all(cleaned_text, '#[a-z0-9]+') AS tags
        FROM cleaned""",
    "unique_tags": """
        SELECT *, list_filter(tags, lambda t, i: list_position(tags, t) = i) AS own_tags
        FROM worded""",
    "tokened": f"""
        SELECT post_id, created_at, lang, list_concat(
            list_filter(words, lambda w: length(w) > 1 AND w NOT IN ({STOP})
                        AND NOT {s_noise('w')}), own_tags) AS tokens
        FROM unique_tags""",
    "terms": f"""
        SELECT post_id, created_at, unnest(tokens) AS topic FROM tokened
        UNION ALL
        SELECT post_id, created_at, unnest({s_grams('tokens', 2)}) FROM tokened""",
    "route_words": f"""
        SELECT {s_route('lang')} AS lang, unnest(words) AS word FROM worded""",
    "freq_ranks": """
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY uses DESC, word) - 1 AS rank
        FROM (SELECT lang, word, count(*) AS uses FROM route_words GROUP BY ALL)""",
    "lexicon": """
        SELECT DISTINCT lang, word FROM route_words
        WHERE word LIKE '%ly' OR word LIKE '%ing' OR word LIKE '%ed'
           OR word LIKE '%able' OR word LIKE '%eux'""",
    "event_terms": """
        SELECT ts AS created_at, event_type || ':u' || user_id AS topic FROM events""",
    "day_counts": f"""
        SELECT {s_start('created_at', 'day')} AS start_time, topic,
               count(*) AS count
        FROM event_terms GROUP BY ALL""",
    "day_averaged": """
        SELECT *, avg(count) OVER (PARTITION BY topic) AS avg_count FROM day_counts""",
    "day_scored": f"""
        SELECT *, {s_round('count', 'avg_count')} AS burst_score FROM day_averaged""",
    "raw": """
        SELECT CAST(event_id AS VARCHAR) AS post_id, ts, event_type,
               CASE source WHEN 'src1' THEN NULL
                           WHEN 'src2' THEN ' ' || chr(9) || chr(10) || ' '
                           ELSE text || ' #' || source END AS text,
               CASE source WHEN 'src3' THEN NULL WHEN 'src4' THEN 'unknown'
                           WHEN 'src5' THEN ' ' || upper(lang) ELSE lang END AS lang,
               CASE event_type
                    WHEN 'error' THEN NULL WHEN 'view' THEN 'n/a'
                    WHEN 'purchase' THEN strftime(ts + INTERVAL 2 HOURS,
                                                  '%a, %d %b %Y %H:%M:%S +0200')
                    ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S +0000')
               END AS created_text,
               CASE WHEN event_type NOT IN ('error', 'view')
                    THEN date_trunc('second', ts) END AS created_at
        FROM documented""",
    "prepared": f"""
        SELECT post_id, text, lang, created_at,
               coalesce({s_clean('text')}, '') AS cleaned_text
        FROM raw WHERE created_at IS NOT NULL""",
    "prepared_tokens": f"""
        SELECT post_id, created_at, lang,
            CASE WHEN lang IS NOT DISTINCT FROM 'unknown' THEN CAST([] AS VARCHAR[])
            ELSE list_concat(
                list_filter(regexp_extract_all(cleaned_text, '[a-z0-9]+'),
                    lambda w: length(w) > 1 AND w NOT IN ({STOP}) AND NOT {s_noise('w')}),
                list_distinct(regexp_extract_all(cleaned_text, '#[a-z0-9]+'))) END AS tokens
        FROM prepared""",
}

NEEDS = {
    "documented": [], "posts": ["documented"], "cleaned": ["posts"], "worded": ["cleaned"], "unique_tags": ["worded"],
    "tokened": ["unique_tags"], "terms": ["tokened"], "route_words": ["worded"],
    "freq_ranks": ["route_words"], "lexicon": ["route_words"], "event_terms": [],
    "day_counts": ["event_terms"], "day_averaged": ["day_counts"],
    "day_scored": ["day_averaged"], "raw": ["documented"], "prepared": ["raw"],
    "prepared_tokens": ["prepared"],
}


def sql(body: str, *uses: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the common table expressions it uses, in order of need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in uses:
        add(name)
    tables = {name: CTES[name] for name in order} | (extra or {})
    heads = ", ".join(f"{name} AS ({text})" for name, text in tables.items())
    return f"WITH {heads} {body}" if heads else body


def oracle(name: str, body: str, *uses: str, extra: dict[str, str] | None = None) -> None:
    ORACLE[name] = sql(body, *uses, extra=extra)


# ---------------------------------------------------------------- sources, sinks

oracle("scan_json", "SELECT post_id, text, lang, created_text AS created_at FROM raw", "raw")
oracle("project_posts", "SELECT * FROM prepared", "prepared")
oracle("parse_created_at", "SELECT post_id, created_at FROM raw", "raw")
oracle("date_from", "SELECT event_id AS post_id, ts AS created_at FROM events "
       "WHERE ts >= TIMESTAMP '2024-01-02'")
oracle("date_to", "SELECT event_id AS post_id, ts AS created_at FROM events "
       "WHERE ts <= TIMESTAMP '2024-01-02'")
oracle("drop_undated",
       "SELECT post_id, created_at FROM raw WHERE created_at IS NOT NULL", "raw")
oracle("null_text_to_empty",
       f"SELECT post_id, coalesce({s_clean('text')}, '') AS cleaned_text FROM raw", "raw")
oracle("etl_parquet", """
    SELECT unnest(['orc', 'parquet']) AS fmt, post_id, lang, created_at, cleaned_text
    FROM prepared""", "prepared")
oracle("partitioned_posts", """
    SELECT post_id, CAST(created_at AS DATE) AS dt, lang, cleaned_text FROM cleaned
    WHERE created_at >= TIMESTAMP '2024-01-02' AND lang = 'en'""", "cleaned")
oracle("archive_split", """
    SELECT CASE WHEN dt < (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 7 DAYS
                THEN 'archive' ELSE 'current' END AS tier,
           dt, event_id, user_id
    FROM (SELECT *, CAST(ts AS DATE) AS dt FROM events)""")

ORACLE["archive_advance"] = ORACLE["archive_split"]

# ------------------------------------------------------------------- text, per row

for name, step in {
    "strip_entities": s_entities, "strip_urls_mentions": s_urls, "strip_punct": s_punct,
    "keep_alnum_hash": s_alnum, "lower_strip": s_strip, "clean_text": s_clean,
}.items():
    oracle(name, f"SELECT post_id, {step('text')} AS result FROM posts", "posts")
oracle("hashtags", f"SELECT post_id, array_to_string(regexp_extract_all(text, '#[{WD}]+'), "
       "'|') AS result FROM posts", "posts")
oracle("clean_pages", f"SELECT page_id, {s_clean('html')} AS cleaned_text FROM pages")
oracle("clean_conversations",
       f"SELECT conv_id, turn, {s_clean('text')} AS cleaned_text FROM conversations")
oracle("noise_tokens", f"SELECT word, count(*) AS uses, {s_noise('word')} AS is_noise "
       "FROM route_words GROUP BY word", "route_words")
oracle("burst_score", "SELECT * FROM day_scored", "day_scored")

# ------------------------------------------------------------------ tokens, per post

TOKENS = "array_to_string(tokens, ' ') AS tokens"
oracle("tokenize", "SELECT post_id, array_to_string(words, ' ') AS words FROM worded", "worded")
oracle("stop_words", f"""
    SELECT s.word, count(r.word) AS uses
    FROM (SELECT DISTINCT unnest([{STOP}]) AS word) s
    LEFT JOIN route_words r ON r.word = s.word GROUP BY s.word""", "route_words")
oracle("remove_stopwords", f"""
    SELECT post_id, array_to_string(list_filter(words, lambda w: w NOT IN ({STOP})
           AND length(w) > 1 AND NOT {s_noise('w')}), ' ') AS tokens FROM worded""", "worded")
oracle("drop_stop_and_noise", f"SELECT post_id, {TOKENS} FROM tokened", "tokened")
oracle("min_token_length", """
    SELECT post_id, CAST(len(words) AS INTEGER) AS n_words,
           CAST(len(list_filter(words, lambda w: length(w) > 1)) AS INTEGER) AS n_kept
    FROM worded""", "worded")
oracle("lang_guard", f"""
    SELECT post_id, lang, CASE WHEN text IS NULL THEN 0
        WHEN lang IS NOT DISTINCT FROM 'unknown' THEN 0
        ELSE CAST(len(list_filter(regexp_extract_all({s_clean('text')}, '[a-z0-9]+'),
                  lambda w: length(w) > 1 AND w NOT IN ({STOP}) AND NOT {s_noise('w')}))
             + len(list_distinct(regexp_extract_all({s_clean('text')}, '#[a-z0-9]+')))
             AS INTEGER) END AS n_tokens
    FROM raw""", "raw")
oracle("lang_route", f"SELECT lang, {s_route('lang')} AS route, count(*) AS n_posts "
       "FROM raw GROUP BY ALL", "raw")
oracle("corpus_freq_rank", "SELECT * FROM freq_ranks", "freq_ranks")

# A word dropped by table is looked up by its position, then the list is put back.
UNNESTED = {
    "positions": f"""
        SELECT post_id, {s_route('lang')} AS route, unnest(words) AS word,
               unnest(range(1, len(words) + 1)) AS pos
        FROM unique_tags""",
    "common": "SELECT lang, word FROM freq_ranks WHERE rank BETWEEN 1 AND 699",
}


def rebuilt(condition: str) -> str:
    return f"""
        SELECT u.post_id, array_to_string(list_concat(
            coalesce(k.kept, CAST([] AS VARCHAR[])), u.own_tags), ' ') AS tokens
        FROM unique_tags u LEFT JOIN (
            SELECT post_id, list(word ORDER BY pos) AS kept FROM positions p
            WHERE {condition} GROUP BY post_id) k USING (post_id)"""


KEPT = f"length(word) > 1 AND NOT {s_noise('word')}"
NOT_COMMON = "(route, word) NOT IN (SELECT (lang, word) FROM common)"
NOT_IN_LEXICON = "(route, word) NOT IN (SELECT (lang, word) FROM lexicon)"
oracle("freq_filter", rebuilt(f"{KEPT} AND {NOT_COMMON}"), "unique_tags", "freq_ranks",
       extra=UNNESTED)
oracle("pos_filter", rebuilt(f"{KEPT} AND {NOT_IN_LEXICON}"), "unique_tags", "lexicon",
       extra={"positions": UNNESTED["positions"]})
oracle("topical_tokens",
       rebuilt(f"{KEPT} AND word NOT IN ({STOP}) AND {NOT_COMMON} AND {NOT_IN_LEXICON}"),
       "unique_tags", "freq_ranks", "lexicon", extra=UNNESTED)
oracle("stopword_anti_join", f"""
    SELECT post_id, array_to_string(list_filter(words, lambda w: CASE WHEN lang = 'en'
           THEN w NOT IN ({words_in(ENGLISH_STOP_WORDS)})
           ELSE w NOT IN ({words_in(DUTCH_STOP_WORDS)}) END), ' ') AS tokens
    FROM worded""", "worded")
oracle("combine_hashtags", f"""
    SELECT post_id, array_to_string(list_concat(words,
           list_filter(tags, lambda t, i: list_position(tags, t) = i
                       AND NOT list_contains(words, t))), ' ') AS tokens
    FROM (SELECT post_id, words, list_transform(
            regexp_extract_all(text, '#[{WD}]+'), lambda t: lower(t)) AS tags
          FROM worded)""", "worded")
oracle("token_multiplicity", """
    SELECT post_id, CAST(len(tokens) AS INTEGER) AS n_tokens,
           CAST(len(list_distinct(tokens)) AS INTEGER) AS n_distinct FROM tokened""", "tokened")
oracle("nonempty_posts", f"""
    SELECT post_id, n_tokens FROM ({ORACLE['lang_guard']}) WHERE n_tokens > 0""")
for name, n in {"bigrams": 2, "trigrams": 3}.items():
    oracle(name, f"SELECT post_id, array_to_string({s_grams('tokens', n)}, '|') AS grams "
           "FROM tokened", "tokened")
for name in ("explode_terms", "union_terms"):
    oracle(name, "SELECT topic, count(*) AS uses FROM terms GROUP BY topic", "terms")
oracle("drop_blank_topics", """
    SELECT topic, count(*) AS uses
    FROM (SELECT unnest(string_split(cleaned_text, ' ')) AS topic FROM cleaned)
    WHERE length(trim(topic)) > 0 GROUP BY topic""", "cleaned")

# Names found by position; the longest per start, then a walk from each name to
# the next one that starts at or after its end.
oracle("entities", """
    SELECT p.post_id, coalesce(w.entities, '') AS entities
    FROM posts p LEFT JOIN (
        SELECT post_id, string_agg(surface, ' ' ORDER BY s) AS entities
        FROM walk GROUP BY post_id) w USING (post_id)""", "posts", extra={
    "split": f"""
        SELECT post_id, lang, regexp_extract_all(text, '[{WD}]+') AS w FROM posts""",
    "items": f"SELECT regexp_extract_all(text, '[{WD}]+') AS w FROM benchmark",
    "names": """
        SELECT DISTINCT lang, source AS surface FROM documented
        UNION SELECT DISTINCT lang, event_type FROM documented
        UNION SELECT 'en', lower(array_to_string(w, ' ')) FROM items
        UNION SELECT 'en', lower(array_to_string(w[i:i + 3], ' '))
            FROM (SELECT w, unnest(range(1, len(w) + 1, 4)) AS i FROM items)""",
    "sizes": """
        SELECT DISTINCT lang, string_split(surface, ' ')[1] AS first,
               len(string_split(surface, ' ')) AS n FROM names""",
    "starts": "SELECT post_id, lang, w, unnest(range(1, len(w) + 1)) AS s FROM split",
    "spans": """
        SELECT post_id, lang, s, n, array_to_string(w[s:s + n - 1], ' ') AS surface
        FROM (SELECT starts.*, sizes.n FROM starts JOIN sizes
              ON starts.lang = sizes.lang AND lower(w[s]) = sizes.first)
        WHERE s + n - 1 <= len(w)""",
    "best": """
        SELECT post_id, s, max(s + n) AS free, arg_max(spans.surface, n) AS surface
        FROM spans JOIN names ON spans.lang = names.lang
             AND lower(spans.surface) = names.surface
        GROUP BY post_id, s""",
    "linked": """
        SELECT a.post_id, a.s, a.surface, b.s AS following
        FROM best a ASOF LEFT JOIN best b ON a.post_id = b.post_id AND a.free <= b.s""",
    "first_names": """
        SELECT l.* FROM linked l
        JOIN (SELECT post_id, min(s) AS s FROM best GROUP BY post_id) f USING (post_id, s)""",
    "walk": """
        SELECT post_id, s, surface, following FROM first_names
        UNION ALL
        SELECT l.post_id, l.s, l.surface, l.following
        FROM walk JOIN linked l ON l.post_id = walk.post_id AND l.s = walk.following""",
})
ORACLE["entities"] = ORACLE["entities"].replace("WITH ", "WITH RECURSIVE ", 1)

# ---------------------------------------------------------------------- counts, trends

oracle("window_term_counts", f"""
    SELECT start_time, start_time + INTERVAL 1 HOUR AS end_time, topic, count(*) AS count
    FROM (SELECT {s_start('created_at', 'hour')} AS start_time, topic FROM event_terms)
    GROUP BY ALL""", "event_terms")
oracle("topic_avg", "SELECT topic, avg(count) AS avg_count FROM day_counts GROUP BY topic",
       "day_counts")
oracle("topic_avg_all_windows", """
    SELECT topic, CAST(sum(count) AS DOUBLE)
           / (SELECT count(DISTINCT start_time) FROM day_counts) AS avg_count
    FROM day_counts GROUP BY topic""", "day_counts")
oracle("burst_join", f"""
    SELECT topic, start_time, count, avg_count, {s_round('count', 'avg_count')} AS burst_score
    FROM day_counts JOIN (
        SELECT topic, avg(count) AS avg_count FROM day_counts GROUP BY topic) USING (topic)""",
       "day_counts")
ORACLE["bucketed_join"] = ORACLE["burst_join"]
oracle("min_count_floor", "SELECT * FROM day_scored WHERE count >= 4", "day_scored")

ORDER = "PARTITION BY start_time ORDER BY burst_score DESC, count DESC, topic"
oracle("rank_in_window", f"""
    SELECT *, CAST(row_number() OVER ({ORDER}) AS INTEGER) AS rank FROM day_scored""",
       "day_scored")
oracle("topn_filter", f"""
    SELECT *, CAST(row_number() OVER ({ORDER}) AS INTEGER) AS rank FROM day_scored
    WHERE count >= 2 QUALIFY rank <= 1""", "day_scored")
oracle("topn_per_window", f"""
    SELECT *, CAST(row_number() OVER ({ORDER}) AS INTEGER) AS rank
    FROM (SELECT start_time, topic, count, avg_count,
                 {s_round('count', 'avg_count')} AS burst_score
          FROM (SELECT *, CAST(sum(count) OVER (PARTITION BY topic) AS DOUBLE)
                       / (SELECT count(DISTINCT start_time) FROM day_counts) AS avg_count
                FROM day_counts))
    WHERE count >= 2 QUALIFY rank <= 3""", "day_counts")


def trends(
    counts: str, interval: str = "hour", n: int = 5, min_count: int = 2,
    baseline: str = "present",
) -> str:
    mean = "avg(count) OVER (PARTITION BY topic)"
    if baseline == "all":
        mean = ("CAST(sum(count) OVER (PARTITION BY topic) AS DOUBLE) / "
                f"(SELECT count(DISTINCT start_time) FROM {counts})")
    return f"""
        SELECT start_time, start_time + INTERVAL 1 {interval} AS end_time, topic, count,
               burst_score, CAST(row_number() OVER ({ORDER}) AS INTEGER) AS rank
        FROM (SELECT *, {s_round('count', 'avg_count')} AS burst_score
              FROM (SELECT *, {mean} AS avg_count FROM {counts}))
        WHERE count >= {min_count} QUALIFY rank <= {n}"""


def counted(source: str, interval: str = "hour") -> dict[str, str]:
    return {"counts": f"""
        SELECT {s_start('created_at', interval)} AS start_time, topic, count(*) AS count
        FROM {source} GROUP BY ALL"""}


oracle("flatten_window", trends("day_counts", "day"), "day_counts")
HOURLY = counted("terms")
oracle("trending_topics", trends("counts"), "terms", extra=HOURLY)
oracle("trends_hour", trends("counts", n=10, baseline="all"), "terms", extra=HOURLY)
oracle("trends_day", trends("counts", "day"), "terms", extra=counted("terms", "day"))
oracle("trends_week", trends("counts", "week", min_count=1), "terms",
       extra=counted("terms", "week"))
TRENDS = HOURLY | {"trends": trends("counts")}
oracle("trends_preview", "SELECT * FROM trends ORDER BY start_time, rank LIMIT 100", "terms",
       extra=TRENDS)
oracle("trends_limit", "SELECT * FROM trends ORDER BY start_time, rank LIMIT 100",
       "day_counts", extra={"trends": trends("day_counts", "day", n=50)})
oracle("read_trends_csv", """
    SELECT start_time AS timestamp_start, end_time AS timestamp_end, topic, count,
           burst_score, rank FROM trends""", "terms", extra=TRENDS)
oracle("write_trends_csv", """
    SELECT start_time AS timestamp_start, end_time AS timestamp_end, topic, count,
           burst_score, rank FROM trends""", "terms", extra=TRENDS)
oracle("sql_over_trends", """
    SELECT topic, count(*) AS n_windows, CAST(sum(count) AS BIGINT) AS total_count,
           max(burst_score) AS best_score
    FROM trends GROUP BY topic""", "terms", extra=TRENDS)
oracle("topic_weights", """
    SELECT word, count(*) AS count, count(*) / CAST(max(count(*)) OVER () AS DOUBLE) AS weight
    FROM (SELECT unnest(string_split(topic, ' ')) AS word FROM trends) GROUP BY word""",
       "terms", extra=TRENDS)
oracle("tfidf", """
    SELECT post_id, term, tf, df,
           round(tf * ln(((SELECT count(*) FROM tokened) + 1) / CAST(df + 1 AS DOUBLE)), 6)
           AS weight
    FROM tf JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) USING (term)""", "tokened",
       extra={"tf": """
           SELECT post_id, term, count(*) AS tf
           FROM (SELECT post_id, unnest(tokens) AS term FROM tokened) GROUP BY ALL"""})

# ------------------------------------------------------------ quality, features, metrics

BLANK = f"length({s_strip('text')}) = 0"
ACCEPTED = "lang IN ('en', 'de', 'fr', 'es')"
FAILURES = {
    "text_present": "text IS NULL",
    "text_not_blank": BLANK,
    "lang_present": "lang IS NULL",
    "lang_accepted": f"NOT {ACCEPTED}",
    "created_at_present": "created_text IS NULL",
    "created_at_parses": "created_text IS NOT NULL AND created_at IS NULL",
}
oracle("dq_report", " UNION ALL ".join(
    f"SELECT '{check}' AS check_name, count(*) AS total, {failed} AS failed, "
    f"{failed} / CAST(count(*) AS DOUBLE) AS ratio FROM raw"
    for check, failed in {
        **{c: f"count(*) FILTER (WHERE {f})" for c, f in FAILURES.items()},
        "post_id_unique": "(count(post_id) - count(DISTINCT post_id))",
    }.items()
), "raw")
oracle("dq_quarantine", f"""
    SELECT post_id, CASE WHEN text IS NOT NULL AND NOT {BLANK} AND lang IS NOT NULL
        AND {ACCEPTED} AND created_at IS NOT NULL THEN 'accepted' ELSE 'rejected' END AS verdict
    FROM raw""", "raw")
oracle("normalise_columns", f"""
    SELECT post_id, coalesce(trim(text, {SPACES}), '') AS text,
           coalesce({s_strip('lang')}, 'unknown') AS lang, created_at FROM raw""", "raw")
PREPARED_TERMS = {
    "own_terms": f"""
        SELECT created_at, unnest(tokens) AS topic FROM prepared_tokens
        UNION ALL
        SELECT created_at, unnest({s_grams('tokens', 2)}) FROM prepared_tokens""",
    **counted("own_terms"),
}
oracle("stage_counts", f"""
    SELECT 'read' AS stage, count(*) AS rows FROM raw
    UNION ALL SELECT 'dated', count(created_at) FROM raw
    UNION ALL SELECT 'with_tokens', count(*) FROM prepared_tokens WHERE len(tokens) > 0
    UNION ALL SELECT 'terms', count(*) FROM own_terms
    UNION ALL SELECT 'trends', count(*) FROM ({trends('counts')})""",
       "prepared_tokens", extra=PREPARED_TERMS)
oracle("trend_features", """
    SELECT start_time, topic, count, previous_count, count - previous_count AS delta,
           count / avg_count AS burst_ratio,
           count / CAST(sum(count) OVER (PARTITION BY start_time) AS DOUBLE) AS window_share
    FROM (SELECT *, lag(count, 1, 0) OVER (PARTITION BY topic ORDER BY start_time)
                 AS previous_count FROM day_averaged)""", "day_averaged")
oracle("trend_labels", f"""
    SELECT f.*, CASE WHEN t.topic IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS label
    FROM ({ORACLE['trend_features']}) f LEFT JOIN ({trends('day_counts', 'day')}) t
    ON t.topic = f.topic AND t.start_time = f.start_time + INTERVAL 1 DAY""", "day_counts")
oracle("trend_given_weights", f"""
    SELECT start_time, topic, round(p, 9) AS probability,
           CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction
    FROM (SELECT *, 1 / (1 + exp(-(-2.0 + delta * 0.5 + burst_ratio * 1.25))) AS p
          FROM ({ORACLE['trend_features']}))""")
MIDDLE = """
    SELECT list_sort(list(DISTINCT start_time))[count(DISTINCT start_time) // 2 + 1] AS cut FROM labelled"""
oracle("trend_least_squares", """
    SELECT start_time, topic,
           round((mz - w1 * mx - w2 * my) + w1 * burst_ratio + w2 * previous_count, 6) AS score
    FROM labelled, (
        SELECT *, (sxz * syy - syz * sxy) / (sxx * syy - sxy * sxy) AS w1,
               (syz * sxx - sxz * sxy) / (sxx * syy - sxy * sxy) AS w2
        FROM (SELECT avg(x) AS mx, avg(y) AS my, avg(z) AS mz,
                     sum(x * x) - sum(x) * sum(x) / count(*) AS sxx,
                     sum(x * y) - sum(x) * sum(y) / count(*) AS sxy,
                     sum(y * y) - sum(y) * sum(y) / count(*) AS syy,
                     sum(x * z) - sum(x) * sum(z) / count(*) AS sxz,
                     sum(y * z) - sum(y) * sum(z) / count(*) AS syz
              FROM (SELECT burst_ratio AS x, CAST(previous_count AS DOUBLE) AS y, label AS z
                    FROM labelled WHERE start_time < (SELECT cut FROM middle))))""",
       extra={"labelled": ORACLE["trend_labels"], "middle": MIDDLE})
CAUSAL = ORACLE["trend_features"].replace("count / avg_count", "count / so_far").replace(
    "AS previous_count FROM", "AS previous_count, avg(count) OVER (PARTITION BY topic ORDER BY "
    "start_time) AS so_far FROM")
oracle("trend_features_causal", CAUSAL)
# the same fit, on the causal features
FITTED = ORACLE["trend_least_squares"].replace(ORACLE["trend_features"], CAUSAL)
oracle("trend_evaluation", f"""
    SELECT start_time, count(*) FILTER (WHERE label = 1) AS trends,
           count(*) FILTER (WHERE label = 1 AND place <= 100) AS hits
    FROM (SELECT *, row_number() OVER (PARTITION BY start_time ORDER BY score DESC, topic) AS place
          FROM ({FITTED}) JOIN labelled USING (start_time, topic))
    WHERE start_time >= (SELECT cut FROM middle) GROUP BY start_time""",
       extra={"labelled": ORACLE["trend_labels"].replace(ORACLE["trend_features"], CAUSAL), "middle": MIDDLE})
oracle("job_trending", """
    SELECT start_time AS timestamp_start, end_time AS timestamp_end, topic, count,
           burst_score, rank FROM trends""", "prepared_tokens",
       extra=PREPARED_TERMS | {"trends": trends("counts")})
oracle("post_scores", f"""
    SELECT post_id, count(burst_score) AS n_trending,
           coalesce(max(burst_score), 0) AS max_score,
           coalesce(CAST(sum(CAST(burst_score AS DECIMAL(18, 2))) AS DOUBLE)
                    / count(burst_score), 0) AS avg_score
    FROM (SELECT *, {s_start('created_at', 'hour')} AS start_time FROM terms)
    LEFT JOIN scored USING (start_time, topic) GROUP BY post_id""",
       "terms", extra=HOURLY | {"scored": f"""
           SELECT *, {s_round('count', 'avg_count')} AS burst_score
           FROM (SELECT *, avg(count) OVER (PARTITION BY topic) AS avg_count FROM counts)"""})

# ------------------------------------------------------------------------- streaming

oracle("stream_scan", "SELECT * FROM prepared", "prepared")
oracle("stream_dedup", "SELECT * FROM prepared", "prepared")
WATERMARK = "(SELECT max(ts) - INTERVAL 2 HOURS FROM events)"
oracle("stream_term_counts",
       f"SELECT * FROM ({ORACLE['window_term_counts']}) WHERE end_time <= {WATERMARK}")
CLOSED_DAYS = {
    "closed": f"""
        SELECT * FROM day_counts WHERE start_time + INTERVAL 1 DAY <= {WATERMARK}"""
}
oracle("stream_trending", trends("closed", "day"), "day_counts", extra=CLOSED_DAYS)
oracle("stream_running_burst", f"""
    SELECT start_time, topic, count, {s_round('count', 'so_far')} AS burst_score
    FROM (SELECT *, avg(count) OVER (PARTITION BY topic ORDER BY start_time) AS so_far
          FROM closed)""", "day_counts", extra=CLOSED_DAYS)
oracle("stream_burst_expiring", f"""
    SELECT start_time, topic, count, {s_round('count', 'so_far')} AS burst_score
    FROM (SELECT *, avg(count) OVER (PARTITION BY topic, life ORDER BY start_time) AS so_far
          FROM (SELECT *, sum(anew) OVER (PARTITION BY topic ORDER BY start_time) AS life
                FROM (SELECT *, CASE WHEN start_time - lag(start_time) OVER (
                          PARTITION BY topic ORDER BY start_time) > INTERVAL 3 DAYS
                          THEN 1 ELSE 0 END AS anew FROM closed)))""", "day_counts",
       extra=CLOSED_DAYS)
oracle("stream_daily_avg", f"""
    SELECT day_start, topic, avg(count) AS avg_count, count(*) AS n_hours
    FROM (SELECT *, date_trunc('day', start_time) AS day_start
          FROM ({ORACLE['window_term_counts']}))
    WHERE day_start + INTERVAL 1 DAY <= {WATERMARK}
    GROUP BY day_start, topic""")
oracle("stream_archive", """
    SELECT post_id, CAST(created_at AS DATE) AS dt, lang, created_at, cleaned_text
    FROM prepared""", "prepared")
oracle("stream_metrics", """
    SELECT 'read' AS metric, count(*) AS value FROM raw
    UNION ALL SELECT 'dated', count(created_at) FROM raw
    UNION ALL SELECT 'terms', count(*) FROM own_terms
    UNION ALL SELECT 'closed', count(*) FROM counts WHERE start_time + INTERVAL 1 HOUR
        <= (SELECT max(created_at) - INTERVAL 2 HOURS FROM own_terms)
    UNION ALL SELECT 'late', 0""", "prepared_tokens", extra=PREPARED_TERMS)
ORACLE["stream_archive_merged"] = ORACLE["stream_archive"]
