"""Named entities by gazetteer lookup.

The caller's gazetteer ``(lang, surface, label)`` stands in for a statistical
recogniser: it finds the names it lists and no others.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.functions.text import WORD
from burstline.operators.joins import left_join_split_hot, member
from burstline.sources.layout import stored

#: Words of all names that every task may get as automata, some 200 bytes each.
MOST_WORDS = 500_000
LABELS = ("PERSON", "ORG", "GPE")
LANGUAGES = ("en", "nl")


def _leftmost_longest(found: Column) -> Column:
    """Walk matches by start, longest first, skipping those that overlap.

    Keeps ``(start, words)`` of the names; their text is cut out afterwards.
    """
    nothing = F.struct(
        F.lit(0).alias("free_from"),
        F.array().cast("array<struct<start: int, words: int>>").alias("names"),
    )

    def take(state: Column, match: Column) -> Column:
        size = -match["shorter"]
        name = F.struct(match["start"].alias("start"), size.alias("words"))
        taken = F.struct(
            (match["start"] + size).alias("free_from"),
            F.array_append(state["names"], name).alias("names"),
        )
        return F.when(match["start"] >= state["free_from"], taken).otherwise(state)

    return F.aggregate(F.sort_array(found), nothing, take, lambda state: state["names"])


def listed_names(gazetteer: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """``lang, name, first, words``: each name split like a text, in lower case.

    Punctuation in a name separates words or is dropped, as in a text.
    """
    words = F.transform(F.regexp_extract_all("surface", F.lit(f"[{WORD}]+"), F.lit(0)), F.lower)
    return (
        gazetteer.filter(F.col("label").isin(*labels))
        .select("lang", words.alias("w"))
        .filter(F.size("w") > 0)
        .select(
            "lang", F.array_join("w", " ").alias("name"), F.col("w")[0].alias("first"),
            F.size("w").alias("words"),
        )
        .distinct()
    )


class Automaton:
    """Finds all names of one language in word sequences, in one pass over each.

    A trie of the names' words, in which every node links to the node of its longest
    proper ending (where matching goes on when no word leads further) and to the
    nearest ending that is a whole name.
    """

    def __init__(self, names: Iterable[Sequence[str]]):
        self.number: dict[str, int] = {}
        self.after: list[dict[int, int]] = [{}]
        self.size = [0]
        for words in names:
            node = 0
            for word in words:
                code = self.number.setdefault(word, len(self.number))
                following = self.after[node].get(code)
                if following is None:
                    following = self.after[node][code] = len(self.after)
                    self.after.append({})
                    self.size.append(0)
                node = following
            self.size[node] = len(words)
        self.ending = [0] * len(self.after)
        self.named = [0] * len(self.after)
        queue = deque(self.after[0].values())
        while queue:
            node = queue.popleft()
            for code, following in self.after[node].items():
                ending = self.ending[following] = self._step(self.ending[node], code)
                self.named[following] = ending if self.size[ending] else self.named[ending]
                queue.append(following)

    def _step(self, node: int, code: int) -> int:
        while node and code not in self.after[node]:
            node = self.ending[node]
        return self.after[node].get(code, 0)

    def leftmost_longest(self, codes: Sequence[int]) -> list[tuple[int, int]]:
        """``(start, end)`` of the names that a walk from the left takes.

        ``codes`` are the words' numbers, negative for words of no name.
        """
        found, node = [], 0
        for i, code in enumerate(codes, 1):
            node = self._step(node, code) if code >= 0 else 0
            at = node if self.size[node] else self.named[node]
            while at:
                found.append((i - self.size[at], -self.size[at]))
                at = self.named[at]
        found.sort()
        taken, free = [], 0
        for start, shorter in found:
            if start >= free:
                free = start - shorter
                taken.append((start, free))
        return taken


def _in_one_pass(words: DataFrame, names: list, id_col: str) -> DataFrame:
    """``entities`` by automata, of which each language has one; nothing is shuffled."""
    listed: dict[str, list[list[str]]] = {}
    for row in names:
        listed.setdefault(row["lang"], []).append(row["name"].split(" "))
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(listed)
    rows = words.select(
        id_col, "lang", "words", F.transform("words", F.lower).alias("lowered")
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata: dict[str, Automaton] = {}
        for batch in batches:
            lowered, words = batch.column("lowered"), batch.column("words")
            bounds = lowered.offsets.to_numpy()
            coded = lowered.values.dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            which = coded.indices.to_numpy(zero_copy_only=False)
            langs = batch.column("lang").to_pylist()
            out: list[str | None] = [""] * batch.num_rows
            for lang in {x for x in langs if x in shared.value}:
                if lang not in automata:
                    automata[lang] = Automaton(shared.value[lang])
                own = automata[lang]
                codes = np.array([own.number.get(w, -1) for w in distinct] or [-1])[which]
                for i in np.flatnonzero(np.array([x == lang for x in langs])).tolist():
                    low, high = int(bounds[i]), int(bounds[i + 1])
                    part = codes[low:high]
                    if (part < 0).all():
                        continue
                    text = words[i].values
                    spans = own.leftmost_longest(part.tolist())
                    out[i] = " ".join(
                        " ".join(text.slice(s, e - s).to_pylist()) for s, e in spans
                    )
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(out, pa.string())], [id_col, "entities"]
            )

    kind = words.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(find, f"`{id_col}` {kind}, entities string")


def entities(
    posts: DataFrame,
    gazetteer: DataFrame,
    id_col: str = "post_id",
    languages: Sequence[str] = LANGUAGES,
    labels: Sequence[str] = LABELS,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """``id, entities``: the names in each post in text order, joined by spaces.

    Names may have any number of words. Matching ignores case and punctuation;
    of overlapping names the leftmost and then longest wins. A post in language
    ``unknown`` has none; any other language, or a null text or language, fails
    the job.

    A gazetteer of up to ``most_words`` words in all, which is checked, goes to every
    task as automata that read each text once, without a shuffle. A larger one is
    joined with the texts, and then ``id`` has to be unique.
    """
    lang = F.col("lang")
    known = lang.isin(*languages, "unknown") & F.col("text").isNotNull()
    message = F.lit(f"text is required and lang must be one of {(*languages, 'unknown')}")
    checked = F.when(F.coalesce(known, F.lit(False)), lang).otherwise(
        F.raise_error(message)
    )
    words = posts.select(
        id_col,
        checked.alias("lang"),
        F.regexp_extract_all(F.col("text"), F.lit(f"[{WORD}]+"), F.lit(0)).alias("words"),
    )
    names = listed_names(gazetteer, labels).filter(F.col("lang") != "unknown")
    if (names.agg(F.sum("words")).first()[0] or 0) <= most_words:
        return _in_one_pass(words, names.select("lang", "name").collect(), id_col)
    return _by_join(words, names, id_col)


def _by_join(words: DataFrame, names: DataFrame, id_col: str) -> DataFrame:
    """``entities`` by joins, for a gazetteer of any size.

    Words that may be a name's first one, by a bitmap of bounded size, are matched
    with the first words, hot ones apart; where one begins, spans are built, of the
    lengths that names with this beginning have, and those that may be a name, by
    another bitmap, are matched with the names.
    """
    names = stored(names, "names")
    firsts = stored(names.groupBy("lang", "first").agg(F.collect_set("words").alias("sizes")), "first-words")
    key = F.xxhash64("lang", "first")
    uses = (
        words.filter(F.col("lang") != "unknown")
        .select(id_col, "lang", F.posexplode("words").alias("start", "word"))
        .select(id_col, "lang", "start", F.lower("word").alias("first"))
        .filter(member(firsts.select(key.alias("key")), firsts.count(), key))
    )
    counts = uses.groupBy("lang", "first").count()
    begun = (
        left_join_split_hot(uses, firsts, ["lang", "first"], counts)
        .filter(F.col("sizes").isNotNull())
        .groupBy(id_col)
        .agg(F.collect_list(F.struct("start", "sizes")).alias("begun"))
    )
    # built as one array, so that unnesting does not repeat a post's words
    candidates = F.flatten(
        F.transform(
            "begun",
            lambda b: F.transform(
                F.filter(b["sizes"], lambda n: b["start"] + n <= F.size("words")),
                lambda n: F.struct(
                    b["start"].alias("start"), n.alias("n"),
                    F.lower(
                        F.array_join(F.slice("words", b["start"] + 1, n), " ")
                    ).alias("name"),
                ),
            ),
        )
    )
    spans = words.join(begun, id_col).select(
        id_col, "lang", F.explode(candidates).alias("span")
    ).select(id_col, "lang", "span.*")
    whole = F.xxhash64("lang", "name")
    passed = spans.filter(member(names.select(whole.alias("key")), names.count(), whole))
    marked = names.select("lang", "name", F.lit(True).alias("listed"))
    found = (
        left_join_split_hot(passed, marked, ["lang", "name"], passed.groupBy("lang", "name").count())
        .filter("listed")
        .groupBy(id_col)
        .agg(
            F.collect_list(
                F.struct("start", (-F.col("n")).alias("shorter"))
            ).alias("found")
        )
    )
    texts = F.transform(
        _leftmost_longest(F.col("found")),
        lambda m: F.array_join(F.slice("words", m["start"] + 1, m["words"]), " "),
    )
    return (
        words.filter(F.col("lang").isNotNull())
        .join(found, id_col, "left")
        .select(id_col, F.coalesce(F.array_join(texts, " "), F.lit("")).alias("entities"))
    )
