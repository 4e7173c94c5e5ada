r"""Text cleaning as native Column expressions.

A word character is a Unicode letter, number or underscore and a space is any
Unicode white space; ``\s`` and ``\w`` alone are ASCII in Java's regexes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f\x{85}\p{Z}"

ENTITY = rf"&[{WORD}]+;"
URL_OR_MENTION = rf"http[^{SPACE}]+|@[{WORD}]+"
PUNCTUATION = r"[!?:;()<>\[\]{}|/\\]"
NOT_ALNUM_HASH_SPACE = rf"[^\p{{Alnum}}#{SPACE}]"
HASHTAG = rf"#[{WORD}]+"

# The code points in SPACE, for trim().
SPACE_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
         *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def strip_entities(text: Column) -> Column:
    """Replace each named HTML entity by one space."""
    return F.regexp_replace(text, ENTITY, " ")


def strip_urls_mentions(text: Column) -> Column:
    """Remove links and @mentions."""
    return F.regexp_replace(text, URL_OR_MENTION, "")


def strip_punct(text: Column) -> Column:
    """Remove the punctuation marks ``! ? : ; ( ) < > [ ] { } | / \\``."""
    return F.regexp_replace(text, PUNCTUATION, "")


def keep_alnum_hash(text: Column) -> Column:
    """Remove everything but ASCII letters, digits, white space and ``#``."""
    return F.regexp_replace(text, NOT_ALNUM_HASH_SPACE, "")


def lower_strip(text: Column) -> Column:
    """Lower-case and strip Unicode white space at both ends; inner runs stay."""
    return F.btrim(F.lower(text), F.lit(SPACE_CHARS))


def clean(text: Column) -> Column:
    """The whole clean; null stays null.

    Links, mentions and unwanted characters go in one scan of the text: the
    unwanted characters are matched one at a time, so none of them can swallow
    the start of a link or mention, and the punctuation marks are a subset of
    the unwanted characters.
    """
    unwanted = f"{URL_OR_MENTION}|{NOT_ALNUM_HASH_SPACE}"
    return lower_strip(F.regexp_replace(strip_entities(text), unwanted, ""))


def clean_or_empty(text: Column) -> Column:
    """``clean`` with null turned into the empty string."""
    return F.coalesce(clean(text), F.lit(""))


def hashtags(text: Column) -> Column:
    """All hashtags in order, case and duplicates kept."""
    return F.regexp_extract_all(text, F.lit(HASHTAG), F.lit(0))
