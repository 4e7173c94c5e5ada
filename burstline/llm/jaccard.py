"""N-gram Jaccard join, size-aware with light and heavy sets.

A document is the set of its shingles, hashed. Documents with equal sets are one
node. Two nodes link when ``100 * common >= 75 * union``.

1. Shingles that only one document has can be in no intersection. Each task sends
   its shingles, packed, to owners by hash range; an owner gives each document
   those that others have too, with their frequency. A node of which fewer than
   three quarters are shared can't link and is done.
2. Light nodes, up to a size chosen by cost, list their subsets of the size that
   a link needs. Nodes with a common subset are linked if their sizes allow it;
   the smallest of a subset's nodes stands for all pairs.
3. Heavy nodes scan inverted lists of the rarest shared shingles of each node, as
   many as make a common one certain. Each node is compared with the first node of the
   lists it shares most; links are merged to components, and only lists with
   several components go on: everyone in them is compared with the list's first
   node if that is in another component, then with a centre, the node with the fewest
   shingles of its own among the lists of one first node. What is left in several
   components is paired: nodes close to a centre by the differences from it that
   they share, as many as a link needs, others by their lists. Jaccard distance is a
   metric, so of the latter those whose distances to the centre differ by more than
   the limit are passed over.

No step lists the pairs of a group of copies, and none drops a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.components import components
from burstline.llm.exact import normalised
from burstline.llm.repeats import one_each, row_names, stored, with_uid, write
from burstline.llm.textbytes import LOWER, flat, mix, signed, steps, words
from burstline.llm.wordkeys import word_keys
from burstline.sources.layout import remove

#: Bytes of a packed shingle besides its owner; with up to 2**19 owners and five
#: bits for the frequency they make a code of 64 bits.
PACKED = 5
#: Shingles that an owner holds on average, about 40 bytes each while it counts them.
OWNED = 1 << 21
#: Largest size that is considered for light nodes.
LIGHT = 12
#: Jaccard distance from a centre up to which nodes are paired by their differences from it.
CLOSE = 0.5
#: Cost of a list's entry against a subset's row: it is scanned, paired and compared.
SCAN_COST = 6.0


def shingles(texts: pa.Array, size: int):
    """Sorted distinct shingles: values, their rows, and the number per row.

    Words are lower-cased in ASCII. A text with fewer words than ``size`` has all
    of them as one shingle; one without words has none.
    """
    data, offsets = flat(texts)
    begin, end, bounds = words(data, offsets)
    names = word_keys(LOWER[data], begin, end)
    count = np.diff(bounds)
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(count)), made)
    start = np.arange(len(row)) + np.repeat(bounds[:-1] - (np.cumsum(made) - made), made)
    length = np.minimum(count, size)[row]
    value = mix(length.astype(np.uint64))
    for back in range(size):
        inside = back < length
        nxt = names[np.minimum(start + back, max(len(names) - 1, 0))] if len(names) else value
        value = np.where(inside, mix(value * np.uint64(0x9E3779B97F4A7C15) ^ nxt), value)
    order = np.argsort(value, kind="stable")  # rows stay ascending among equal values
    value, row = value[order], row[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return value, row, np.bincount(row, minlength=len(count))


def _sets(size: int):
    """``uid, doc, nameless, n, node``: the size of each set and a hash of all of it."""

    def make(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            value, row, n = shingles(batch.column("text"), size)
            halves = []
            for salt in (1, 2):
                h = np.zeros(len(n), np.uint64)
                np.add.at(h, row, mix(value * np.uint64(2 * salt + 1) + np.uint64(salt)))
                halves.append(mix(h + n.astype(np.uint64)))
            node = np.stack(halves, 1).astype(">u8").tobytes()
            nodes = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(16), len(n), [None, pa.py_buffer(node)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("uid", "doc", "nameless")), pa.array(n), nodes],
                ["uid", "doc", "nameless", "n", "node"],
            )

    return make


def _owner(value: np.ndarray, owners: int) -> np.ndarray:
    """Owners of ascending hash ranges."""
    return ((value >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _pack(value: np.ndarray) -> bytes:
    """The low bytes of the values, after the owner's range has been divided out."""
    return value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PACKED].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, PACKED)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :PACKED] = part
    return out.view("<u8").ravel()


def _send(size: int, owners: int):
    """Packed shingles per owner, by document: ``owner, chunk, uids, counts, codes``.

    A chunk is the documents of one step, named by a hash of their ids.
    """

    def send(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            value, row, _ = shingles(batch.column("text"), size)
            if not len(value):
                continue
            uid = batch.column("uid").to_numpy().astype("<i8")
            cuts = np.searchsorted(_owner(value, owners), np.arange(owners + 1))
            chunk = int(np.bitwise_xor.reduce(mix(uid.view(np.uint64)) + np.uint64(len(uid))).view(np.int64))
            short = mix(value)  # within an owner, some bits of it stand for the value
            out = []
            for o in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[o], cuts[o + 1])
                order = np.argsort(row[own], kind="stable")
                here, n = np.unique(row[own], return_counts=True)
                out.append(
                    (int(o), chunk, uid[here].tobytes(), n.astype("<u4").tobytes(), _pack(short[own][order]))
                )
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                ["owner", "chunk", "uids", "counts", "codes"],
            )

    return send


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one owner's lists, the shingles that several documents have.

    A shingle's code begins with the magnitude of the number of its documents, so
    that codes in order go from rare to common. Each list goes back to its chunk.
    """
    owner = np.uint64(rows["owner"].iloc[0])
    lists = [_unpack(c) for c in rows["codes"]]
    every = np.concatenate(lists)
    order = np.argsort(every)
    ordered = every[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(np.append(first, len(ordered)))
    magnitude = np.floor(np.log2(times)).astype(np.uint64)
    code = np.empty(len(every), np.uint64)
    code[order] = np.repeat((magnitude << np.uint64(59)) | (owner << np.uint64(8 * PACKED)), times)
    code |= every
    keep = np.empty(len(every), bool)
    keep[order] = np.repeat(times > 1, times)
    ends = np.cumsum([len(c) for c in lists])
    out_uids, out_codes = [], []
    for end, c, uids, counts in zip(ends, lists, rows["uids"], rows["counts"], strict=True):
        own = slice(end - len(c), end)
        who = np.repeat(np.frombuffer(uids, "<i8"), np.frombuffer(counts, "<u4"))
        out_uids.append(who[keep[own]].tobytes())
        out_codes.append(code[own][keep[own]].astype("<u8").tobytes())
    return pd.DataFrame({"chunk": rows["chunk"], "uids": out_uids, "codes": out_codes})


def _gather(rows: pd.DataFrame) -> pd.DataFrame:
    """The shared shingles of each document of a chunk, in order."""
    who = np.frombuffer(b"".join(rows["uids"]), "<i8")
    code = np.frombuffer(b"".join(rows["codes"]), "<u8")
    order = np.lexsort((code, who))
    who, code = who[order], code[order]
    fresh = np.ones(len(who), bool)  # equal rows of a table count once
    fresh[1:] = (who[1:] != who[:-1]) | (code[1:] != code[:-1])
    who, code = who[fresh], code[fresh]
    cuts = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else []
    raw, ends = code.astype("<u8").tobytes(), np.append(cuts[1:], len(who))
    codes = [raw[8 * int(x) : 8 * int(y)] for x, y in zip(cuts, ends)]
    uid = who[cuts] if len(who) else np.empty(0, np.int64)
    return pd.DataFrame({"uid": uid, "codes": codes})


def needed(n: int, m: int) -> int:
    """Common shingles that sets of n and m need to link at 75 of 100."""
    return -(-3 * (n + m) // 7)


def subset_sizes(n: int) -> list[int]:
    """Sizes of common subsets that a set of n may need, over all partners."""
    partners = range(-(-3 * n // 4), 4 * n // 3 + 1)
    return sorted({needed(n, m) for m in partners if m})


def light_bound(sizes: dict[int, int]) -> int:
    """The size up to which listing subsets costs less than scanning lists.

    ``sizes`` counts the nodes by size. Nodes above three quarters of the bound
    are in the lists as well, for partners above it.
    """

    def cost(bound: int) -> float:
        subsets = sum(
            k * sum(comb(n, c) for c in subset_sizes(n)) for n, k in sizes.items() if n <= bound
        )
        lists = sum(k * (n // 4 + 1) for n, k in sizes.items() if 4 * n > 3 * bound)
        return subsets + SCAN_COST * lists

    return min(range(LIGHT + 1), key=cost)


def _postings(light: int):
    """Rows ``token, c, node, n, rest``: subsets of light nodes (c > 0), list entries (c = 0).

    ``rest`` is how many of the node's shared shingles an entry's own and those after
    it are: what can be common with a node whose first common shingle this is.
    """

    def post(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                token, size, owner, rest = [], [], [], []
                for i, (n, raw) in enumerate(
                    zip(part.column("n").to_pylist(), part.column("codes").to_pylist())
                ):
                    own = np.frombuffer(raw, "<u8")
                    if 4 * n > 3 * light:  # codes go from rare to common
                        prefix = mix(own[: max(0, len(own) - -(-3 * n // 4) + 1)])
                        token.append(prefix)
                        size.append(np.zeros(len(prefix), np.int32))
                        rest.append(len(own) - np.arange(len(prefix)))
                    if n <= light:
                        for c in subset_sizes(n):
                            if c > len(own):
                                continue
                            subsets = np.array(list(combinations(own.tolist(), c)), np.uint64)
                            value = np.full(len(subsets), c, np.uint64)
                            for column in subsets.T:
                                value = mix(value * np.uint64(0x9E3779B97F4A7C15) ^ mix(column))
                            token.append(value)
                            size.append(np.full(len(value), c, np.int32))
                            rest.append(np.zeros(len(value), np.int64))
                    owner.append(sum(map(len, token)))
                if not token:
                    continue
                entry = np.repeat(np.arange(len(owner)), np.diff(owner, prepend=0))
                entry = pa.array(entry)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.concatenate(token))), pa.array(np.concatenate(size)),
                        part.column("node").take(entry), part.column("n").take(entry),
                        pa.array(np.concatenate(rest).astype(np.int32)),
                    ],
                    ["token", "c", "node", "n", "rest"],
                )

    return post


def _prefixes(light: int):
    """Rows ``node, tokens, l``: the tokens of a node's list entries in order, and its shared shingles."""

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sets = [np.frombuffer(raw, "<u8") for raw in batch.column("codes").to_pylist()]
            n = batch.column("n").to_pylist()
            tokens = [
                signed(mix(own[: max(0, len(own) - -(-3 * k // 4) + 1)])) if 4 * k > 3 * light else own[:0].view("<i8")
                for own, k in zip(sets, n)
            ]
            ends = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
            values = np.concatenate([np.empty(0, np.int64), *tokens])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    pa.array([len(own) for own in sets], pa.int32()),
                ],
                ["node", "tokens", "l"],
            )

    return cut


def _overlap(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        common = [
            len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), True))
            for x, y in zip(batch.column("ca").to_pylist(), batch.column("cb").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(common, pa.int64())],
            ["a", "b", "na", "nb", "common"],
        )


def _differences(batches: Iterator[pa.RecordBatch]):
    """``q`` and the differences of sets from their centres, from rare to common.

    The order is one for all nodes of a centre. How many add a shingle is known by its
    magnitude; how many lack one is guessed: few, if it is as common as the commonest
    of the centre, else most. The centre's own shingles, lacked by all others, come last.
    """
    kept = ["centre", "node", "root", "n", "n_centre"]
    for batch in batches:
        q, tokens = [], []
        for n, n_centre, raw, raw_centre in zip(
            *(batch.column(c).to_pylist() for c in ("n", "n_centre", "codes", "of_centre"))
        ):
            own, centre = np.frombuffer(raw, "<u8"), np.frombuffer(raw_centre, "<u8")
            adds = np.setdiff1d(own, centre, True)
            lacks = np.setdiff1d(centre, own, True)
            common = len(own) - len(adds)
            q.append(4 * (n_centre - common) + 3 * (n - common))
            top = int(centre[-1] >> np.uint64(59))
            of_lacks = lacks >> np.uint64(59)
            place = np.concatenate(
                [adds >> np.uint64(59), np.where(of_lacks == top, max(top - 3, 0), top).astype(np.uint64)]
            )
            values = np.concatenate([mix(adds), mix(lacks ^ np.uint64(0x9E3779B97F4A7C15))])
            alone = mix(np.arange(n_centre - len(centre), dtype=np.uint64) + np.uint64(1))
            tokens.append(signed(np.concatenate([values[np.lexsort((values, place))], alone])))
        ends = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
        values = np.concatenate([np.empty(0, np.int64), *tokens])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in kept), pa.array(q, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
            ],
            [*kept, "q", "tokens"],
        )


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` with ``distance`` (Jaccard) and ``linked``, from their sets."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("codes").alias("ca"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("codes").alias("cb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    counted = both.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(
        _overlap, "a long, b long, na long, nb long, common long"
    )
    union = F.col("na") + F.col("nb") - F.col("common")
    return counted.select(
        "a", "b", (1 - F.col("common") / union).alias("distance"),
        (100 * F.col("common") >= 75 * union).alias("linked"),
    )


def shared_sets(docs: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """Nodes that may link: ``node, n, codes`` with their shared shingles in order.

    There are as many owners as shuffle partitions, or more, so that the hash range
    of each has ``OWNED`` shingles on average.
    """
    made = sets.agg(F.sum("n")).first()[0] or 0
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = min(1 << 19, max(owners, made // OWNED + 1))
    sent = docs.select("uid", "text").mapInArrow(
        _send(size, owners),
        "owner int, chunk long, uids binary, counts binary, codes binary",
    )
    answers = sent.groupBy("owner").applyInPandas(
        _shared, "chunk long, uids binary, codes binary"
    )
    gathered = answers.groupBy("chunk").applyInPandas(_gather, "uid long, codes binary")
    first = sets.filter("n > 0").groupBy("node").agg(F.min(F.struct("uid", "n")).alias("x"))
    first = first.select("node", "x.uid", "x.n")
    enough = gathered.join(first, "uid").filter(4 * F.length("codes") >= 3 * 8 * F.col("n"))
    return enough.select("node", "n", "codes").dropDuplicates(["node"])


def _merge(links: DataFrame) -> DataFrame:
    return stored(components(links.select("a", "b")), "components")


def link_nodes(sets: DataFrame) -> DataFrame:
    """``node, root`` of the nodes that link with another; ``sets`` has ``node, n, codes``.

    Nodes are numbers. Tables between the steps are deleted when the next ones are
    written.
    """
    spark = sets.sparkSession
    counts = sets.filter(F.col("n") <= 2 * LIGHT).groupBy("n").count().collect()
    light = light_bound({r["n"]: r["count"] for r in counts})
    posted_path = write(
        sets.mapInArrow(_postings(light), "token long, c int, node long, n long, rest int"), "postings"
    )
    posted = spark.read.parquet(posted_path)
    subsets = posted.filter("c > 0")
    least = subsets.groupBy("c", "token").agg(
        F.min(F.struct("n", "node")).alias("m"), F.count("*").alias("k")
    ).filter("k > 1").select("c", "token", F.col("m.n").alias("least"), F.col("m.node").alias("a"))
    of_light = subsets.join(least, ["c", "token"]).filter(
        (3 * (F.col("n") + F.col("least")) <= 7 * F.col("c")) & (F.col("node") != F.col("a"))
    ).select("a", F.col("node").alias("b"))

    lists = posted.filter("c = 0")
    firsts = lists.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    firsts = firsts.filter("a <> z").select("token", "a")
    lists_path = write(lists.join(firsts, "token").select("token", "a", "node", "n", "rest"), "lists")
    lists = spark.read.parquet(lists_path)

    # first, each node against the one first node that it shares most lists with
    stars = lists.filter("a <> node").groupBy("a", "node").agg(F.count("*").alias("k"))
    nearest = stars.groupBy("node").agg(F.max(F.struct("k", "a")).alias("m"))
    nearest = nearest.select(F.col("m.a").alias("a"), F.col("node").alias("b"))
    compared = stored(compare(nearest, sets), "compared")
    linked = of_light.unionAll(compared.filter("linked").select("a", "b"))
    roots = _merge(stored(linked, "linked"))
    remove(spark, posted_path)

    # then against the first nodes of all lists that still hold several components
    open_ = _open(lists, roots)
    heads = roots.select(F.col("node").alias("a"), F.col("root").alias("of_a"))
    others = open_.join(heads, "a", "left").filter(
        (F.coalesce("of_a", "a") != F.col("root")) & (F.col("a") != F.col("node"))
    ).select("a", F.col("node").alias("b")).distinct()
    others = others.join(compared.select("a", "b"), ["a", "b"], "left_anti")
    compared = compared.unionAll(stored(compare(others, sets), "compared"))
    more = compared.filter("linked").select("a", "b")
    roots = _merge(_as_links(roots).unionAll(more))

    # then against the most central node of all lists with one first node
    open_ = stored(_open(lists, roots), "open")
    remove(spark, lists_path)
    if open_.isEmpty():
        return roots
    size = sets.select("node", "n", (F.length("codes") / 8).cast("int").alias("l"))
    members = open_.select("a", "node").distinct()
    centres = members.join(size, "node").groupBy("a").agg(
        F.min(F.struct(F.col("n") - F.col("l"), "node")).alias("m")
    ).select("a", F.col("m.node").alias("centre"))
    members = stored(members.join(centres, "a"), "members")
    around = members.filter("centre <> node").select("centre", "node").distinct()
    around = stored(
        compare(around.select(F.col("centre").alias("a"), F.col("node").alias("b")), sets)
        .withColumnsRenamed({"a": "centre", "b": "node"}),
        "around",
    )
    more = around.filter("linked").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    roots = _merge(_as_links(roots).unionAll(more))

    # last, the pairs across components that may link
    known = members.join(around, ["centre", "node"], "left").select(
        "a", "centre", "node", F.coalesce("distance", F.lit(0.0)).alias("distance")
    )
    open_ = stored(
        _open(open_.drop("root"), roots).join(known, ["a", "node"]).drop("a"), "open"
    )
    pairs = _pairs_by_difference(open_, sets).unionAll(_pairs_by_lists(open_, sets, light))
    pairs = pairs.distinct().join(compared.select("a", "b"), ["a", "b"], "left_anti")
    more = stored(compare(pairs, sets).filter("linked").select("a", "b"), "linked")
    if more.isEmpty():
        return roots
    return _merge(_as_links(roots).unionAll(more))


def _pair() -> list:
    return [
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    ]


def _sizes_fit():
    return (4 * F.col("x.n") >= 3 * F.col("y.n")) & (4 * F.col("y.n") >= 3 * F.col("x.n"))


def _pairs_by_difference(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of nodes close to one centre that may link.

    Each node x is the shingles in which it differs from the centre c, those it lacks
    and those it adds, as most of a group of near copies is common to all. With
    ``q = 4 * lacks + 3 * adds`` two nodes link if ``7 * s >= q_x + q_y - n_c``, ``s``
    being how many differences they share, and a node links with the centre if
    ``q <= n_c``. So a pair that links across components shares a difference, and its
    first common one, from rare to common, leaves ``s`` of them on both sides.
    """
    close = open_.filter((F.col("distance") <= CLOSE) & (F.col("centre") != F.col("node")))
    close = close.select("centre", "node", "root").distinct()
    ends = close.groupBy("centre").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    close = close.join(ends.filter("x <> y").select("centre"), "centre", "left_semi")
    of_centre = sets.select(
        F.col("node").alias("centre"), F.col("n").alias("n_centre"), F.col("codes").alias("of_centre")
    )
    differing = stored(
        close.join(of_centre, "centre").join(sets.select("node", "n", "codes"), "node")
        .select("centre", "node", "root", "n", "n_centre", "codes", "of_centre")
        .mapInArrow(
            _differences,
            "centre long, node long, root long, n long, n_centre long, q long, tokens array<long>",
        ),
        "differing",
    )
    least = differing.groupBy("centre").agg(F.min("q").alias("least"))
    all_ = F.size("tokens")
    shared = F.greatest(F.lit(1), F.ceil((F.col("q") + F.col("least") - F.col("n_centre")) / 7))
    entries = stored(
        differing.join(least, "centre")
        .withColumn("prefix", F.slice("tokens", F.lit(1), F.greatest(F.lit(0), all_ - shared + 1).cast("int")))
        .select("centre", "node", "root", "n", "n_centre", "q", all_.alias("l"), "prefix",
                F.posexplode("prefix").alias("at", "token"))
        .select("centre", "token", "node", "root", "n", "n_centre", "q",
                (F.col("l") - F.col("at")).alias("rest"),
                F.slice("prefix", F.lit(1), F.col("at")).alias("before")),
        "entries",
    )
    x, y = entries.alias("x"), entries.alias("y")
    return x.join(
        y,
        (F.col("x.centre") == F.col("y.centre")) & (F.col("x.token") == F.col("y.token"))
        & (F.col("x.root") < F.col("y.root")) & _sizes_fit()
        & (7 * F.least("x.rest", "y.rest") >= F.col("x.q") + F.col("y.q") - F.col("x.n_centre"))
        & ~F.arrays_overlap("x.before", "y.before"),
    ).select(*_pair())


def _pairs_by_lists(open_: DataFrame, sets: DataFrame, light: int) -> DataFrame:
    """Pairs ``a, b`` of a list that may link, one of them far from the centre.

    Left out are those whose distances to the centre tell that they are too far apart,
    and those that would have too little in common from this shingle on: the first
    common shingle of a pair that links leaves enough on both sides. A pair is made
    at its first common shingle alone, so that long shared passages don't multiply it.
    """
    far = F.col("distance") > CLOSE
    lists = open_.join(open_.filter(far).select("token").distinct(), "token", "left_semi")
    prefixes = sets.join(lists.select("node").distinct(), "node", "left_semi").select(
        "node", "n", "codes"
    ).mapInArrow(_prefixes(light), "node long, tokens array<long>, l int")
    lists = stored(
        lists.join(prefixes, "node").withColumn(
            "before", F.slice("tokens", F.lit(1), F.col("l") - F.col("rest"))
        ).drop("tokens", "l"),
        "open",
    )
    x, y = lists.filter(far).alias("x"), lists.alias("y")
    return x.join(
        y,
        (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root"))
        & ((F.col("y.distance") <= CLOSE) | (F.col("x.root") < F.col("y.root")))
        & (F.abs(F.col("x.distance") - F.col("y.distance")) <= 0.25 + 1e-9)
        & (7 * F.least("x.rest", "y.rest") >= 3 * (F.col("x.n") + F.col("y.n")))
        & ~F.arrays_overlap("x.before", "y.before")
        & _sizes_fit(),
    ).select(*_pair())


def _as_links(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _open(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries of the lists that hold several components, with their roots."""
    labelled = lists.join(roots.select("node", "root"), "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    ends = labelled.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    return labelled.join(ends.filter("x <> y").select("token"), "token", "left_semi")


def _linked(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The stored set of every row, ``uid, doc, nameless, n, node``, and the roots of linked nodes."""
    own = with_uid(docs)
    nameless = F.col("doc_id").isNull().alias("nameless")
    sets = stored(
        own.select("uid", "doc", nameless, "text").mapInArrow(
            _sets(size), "uid long, doc long, nameless boolean, n long, node binary"
        ),
        "sets",
    )
    candidates = stored(
        shared_sets(own, sets, size).withColumn("id", F.monotonically_increasing_id()), "candidates"
    )
    roots = link_nodes(candidates.select(F.col("id").alias("node"), "n", "codes"))
    named = candidates.select("id", "node")
    named_root = named.select(F.col("id").alias("root_id"), F.col("node").alias("root"))
    roots = roots.select(F.col("node").alias("id"), F.col("root").alias("root_id"))
    return sets, roots.join(named, "id").join(named_root, "root_id").select("node", "root")


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """The component of every row of ``docs``: ``doc_id, n_shingles, component_id``.

    Documents link when their sets of ``size``-word shingles share three quarters
    of their union. ``component_id`` is the smallest id reachable by links, itself
    included. A null or blank text has an empty set and links with nothing; a
    null id is larger than every other, and a component of such rows alone has a
    null id. Rows with one id and different texts are linked by their texts alone.
    Columns other than ``doc_id`` and ``text`` are not used.
    """
    sets, roots = _linked(docs, size)
    own = F.struct((F.col("nameless")).alias("nameless"), "doc")
    nodes = sets.filter("n > 0").groupBy("node").agg(F.min(own).alias("least"))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_node = rooted.join(least, "root").select("node", "component")
    component = F.when(F.col("n") == 0, own).otherwise(F.col("component"))
    return sets.join(of_node, "node", "left").select(
        F.when(~F.col("nameless"), F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(~component["nameless"], component["doc"]).alias("component_id"),
    )


def keep_one_each(docs: DataFrame, size: int = 5) -> DataFrame:
    """One row of each component of ``docs``, with all its columns.

    The row with the smallest id stays, null ids last; of rows with that id but
    different texts the one with the smallest ``uid``, and of rows equal in both one
    as in ``one_each``. All rows without words stay.
    """
    sets, roots = _linked(docs, size)
    nodes = sets.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc", "uid")).alias("first"))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    stay = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.*")

    wordless = normalised(F.col("text")) == ""
    rank, uid = row_names()
    rows = one_each(docs.filter(~wordless), {"doc": rank, "uid": uid})
    kept = rows.join(stay, ["doc", "uid"], "left_semi").select("row.*")
    return kept.unionAll(docs.filter(wordless))
