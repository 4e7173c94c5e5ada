"""Schemas of the tables along the way, as DDL."""

# Raw posts: only the leaves that are read. Sparse records give nulls, and the
# JSON reader skips every other field while parsing.
RAW_POSTS = (
    "interaction struct<content: string>, "
    "language struct<tag: string>, "
    "twitter struct<id: string, created_at: string>, "
    "_corrupt_record string"
)

POSTS = (
    "post_id string, text string, lang string, created_at timestamp"
)

TERM_COUNTS = (
    "start_time timestamp, topic string, count bigint"
)

TRENDS = (
    "start_time timestamp, end_time timestamp, topic string, "
    "count bigint, burst_score double, rank int"
)

# Stored results carry no header: the reader supplies the names.
STORED_TRENDS = (
    "timestamp_start timestamp, timestamp_end timestamp, topic string, "
    "count bigint, burst_score double, rank int"
)

LEXICON = ("lang string, word string, pos string, rank int")

GAZETTEER = ("lang string, surface string, label string")
