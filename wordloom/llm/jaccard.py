"""Jaccard join of documents on word n-grams: rare-first prefixes and their filters."""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import free_names, membership, schema_of, stored
from wordloom.llm.components import components
from wordloom.llm.packed import pack_counts, pack_sorted, unpack_counts, unpack_sorted
from wordloom.llm.shingles import mix64, shingle_hashes, word_hashes, words_of

_WORDS = 8  # of 64 bits in a parity sketch
_SKETCH = [f"s{k}" for k in range(_WORDS)]
_DRAWN = 64  # nodes of an n-gram that are drawn together, on average


def shingle_set(text: str, size: int) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(word_hashes(words_of(text)), size))


def _set_key(grams: np.ndarray) -> int:
    """A hash of a whole set."""
    with np.errstate(over="ignore"):
        one = np.bitwise_xor.reduce(mix64(grams)) if len(grams) else np.uint64(0)
        two = mix64(grams + np.uint64(0x51ED270B)).sum(dtype=np.uint64)
        return int(mix64(np.array([one ^ mix64(np.array([two + np.uint64(len(grams))]))[0]]))[0])


def _level(counts: np.ndarray) -> np.ndarray:
    """Numbers of documents in a byte that keeps their order: above 128 as logarithms."""
    return np.where(counts <= 128, counts, 121 + np.ceil(np.log2(np.maximum(counts, 1)))).astype(np.int64)


class _Sets:
    """The n-gram sets of some documents, one after the other, and all their n-grams."""

    def __init__(self, texts: list[str], size: int, parts: int):
        self.sets = [shingle_set(text or "", size) for text in texts]
        every = np.concatenate(self.sets or [np.zeros(0, np.uint64)])
        self.grams, self.at, self.counts = np.unique(every, return_inverse=True, return_counts=True)
        edges = np.array([part * 2**64 // parts for part in range(parts)], dtype=np.uint64)
        self.starts = np.append(np.searchsorted(self.grams, edges), len(self.grams))


def signatures(
    documents: DataFrame,
    size: int,
    percent: int,
    block_chars: int = 4_000_000,
    part_grams: int = 1_000_000,
) -> DataFrame:
    """``_id, key, n, prefix, places, wide, s0 ... s7`` of every row of ``documents``
    (``_id, text``).

    ``key`` identifies the set, ``n`` is its size. Its n-grams are ordered by the number of
    documents that hold them; of the rarest, as many as leave too few others for an overlap
    that is enough, ``prefix`` has those that another document holds as well, ``places``
    their ranks among all of the set. ``s0`` to ``s7`` hold for 512 classes of hashes
    whether the number of n-grams in it is odd, ``wide`` for about as many classes as there
    are n-grams if those are more than 512.

    The numbers of documents are those of the whole corpus, at any size. Documents are dealt
    into blocks of about ``block_chars`` characters. A block sends its distinct n-grams,
    sorted and as differences, with their counts to partitions of the table of frequencies
    (ranges of hashes, of ``part_grams`` or so); what comes back is a byte for each.
    """
    rows = documents.select("_id", "text")
    chars = rows.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, ceil(chars / block_chars))
    parts = max(1, ceil(chars / 6 / part_grams))
    # Rows that repeat id and text, or have neither, are dealt by their place in the input.
    place = F.xxhash64("_id", "text", F.monotonically_increasing_id())
    dealt = rows.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int"))

    def ask(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        block = _Sets(group["text"].to_pylist(), size, parts)
        used = np.flatnonzero(np.diff(block.starts)).tolist()
        cut = [slice(block.starts[part], block.starts[part + 1]) for part in used]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(used), pa.int32()),
                "part": pa.array(used, pa.int32()),
                "grams": pa.array([pack_sorted(block.grams[x]) for x in cut], pa.binary()),
                "counts": pa.array([pack_counts(block.counts[x]) for x in cut], pa.binary()),
            }
        )

    def total(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        grams = [unpack_sorted(x) for x in group["grams"].to_pylist()]
        counts = np.concatenate([unpack_counts(x) for x in group["counts"].to_pylist()])
        _, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        levels = _level(np.bincount(inverse, weights=counts))[inverse]
        answers = np.split(levels, np.cumsum([len(x) for x in grams])[:-1])
        return pa.table(
            {
                "block": group["block"],
                "part": group["part"],
                "levels": pa.array([pack_counts(x) for x in answers], pa.binary()),
            }
        )

    asked = dealt.groupBy("block").applyInArrow(ask, "block int, part int, grams binary, counts binary")
    answers = asked.groupBy("part").applyInArrow(total, "block int, part int, levels binary")

    def sign(key: tuple[pa.Scalar, ...], texts: pa.Table, answered: pa.Table) -> pa.Table:
        block = _Sets(texts["text"].to_pylist(), size, parts)
        levels = np.zeros(len(block.grams), dtype=np.uint64)
        for part, data in zip(answered["part"].to_pylist(), answered["levels"].to_pylist()):
            levels[block.starts[part] : block.starts[part + 1]] = unpack_counts(data)
        keys, sizes, prefixes, ranks, sketches, wide = [], [], [], [], [], []
        begin = 0
        for grams in block.sets:
            n = len(grams)
            level = levels[block.at[begin : begin + n]]
            begin += n
            length = n - -(-percent * n // 100) + 1 if n else 0
            rarest = np.lexsort((grams, level))[:length]
            shared = np.flatnonzero(level[rarest] > 1)
            counts = np.bincount(
                (grams % np.uint64(64 * _WORDS)).astype(np.int64), minlength=64 * _WORDS
            )
            keys.append(np.uint64(_set_key(grams)).astype(np.int64))
            sizes.append(n)
            prefixes.append(grams[rarest[shared]].view(np.int64))
            ranks.append(shared.astype(np.int32))
            sketches.append(np.packbits(counts % 2 == 1).view("<i8"))
            wide.append(_parities(grams, 1 << n.bit_length()) if n > 64 * _WORDS else None)
        return pa.table(
            {
                "_id": texts["_id"],
                "key": pa.array(keys, pa.int64()),
                "n": pa.array(sizes, pa.int64()),
                "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                "places": pa.array(ranks, pa.list_(pa.int32())),
                "wide": pa.array(wide, pa.binary()),
                **dict(zip(_SKETCH, (pa.array(x, pa.int64()) for x in np.transpose(sketches)))),
            }
        )

    schema = schema_of(
        documents,
        ["_id"],
        key="long",
        n="long",
        prefix="array<long>",
        places="array<int>",
        wide="binary",
        **dict.fromkeys(_SKETCH, "long"),
    )
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sign, schema)


def _long_enough(n: Column, m: Column, percent: int) -> Column:
    return (n * 100 >= m * percent) & (m * 100 >= n * percent)


def _overlap(n: Column, m: Column, bound: Column, percent: int) -> Column:
    """Whether an overlap of ``bound`` is enough: ``100 o >= percent (n + m - o)``."""
    return bound * (100 + percent) >= (n + m) * percent


def _apart(left, right) -> Column:
    """The suffix filter's lower bound of the n-grams that only one of two sets has: every
    one of them changes whether the count of its class is odd."""
    return reduce(
        Column.__add__, (F.bit_count(left(name).bitwiseXOR(right(name))) for name in _SKETCH)
    )


def _near_enough(n: Column, m: Column, apart: Column, percent: int) -> Column:
    return (n + m - apart) * (100 + percent) >= (n + m) * 2 * percent


def _parities(grams: np.ndarray, classes: int) -> bytes:
    counts = np.bincount((grams % np.uint64(classes)).astype(np.int64), minlength=classes)
    return np.packbits(counts % 2 == 1).tobytes()


def _plausible(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that the suffix filter leaves if it looks at as many classes as
    long sets have n-grams. Of two sketches the larger is folded to the other's size."""

    def keep(batches):
        for batch in batches:
            kept = []
            columns = (batch.column(c).to_pylist() for c in ("n", "m", "left", "right"))
            for n, m, left, right in zip(*columns):
                if left is None or right is None:
                    kept.append(True)
                    continue
                one, two = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
                size = min(len(one), len(two))
                one = np.bitwise_xor.reduce(one.reshape(-1, size))
                two = np.bitwise_xor.reduce(two.reshape(-1, size))
                apart = int(np.bitwise_count(one ^ two).sum())
                kept.append((n + m - apart) * (100 + percent) >= (n + m) * 2 * percent)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = wide.toDF("a", "n", "left")
    right = wide.toDF("b", "m", "right")
    rows = pairs.join(left, "a", "left").join(right, "b", "left")
    return rows.select("a", "b", "n", "m", "left", "right").mapInArrow(keep, "a long, b long")


def _verified(
    pairs: DataFrame, nodes: DataFrame, documents: DataFrame, size: int, percent: int
) -> DataFrame:
    """The pairs ``a, b`` whose sets overlap enough, each looked at once."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    wanted = stored(wanted.join(nodes, "key").select("key", "_first"))
    may_be = membership(wanted, "_first")
    texts = (
        documents.filter(may_be("_id"))
        .join(wanted, F.col("_id").eqNullSafe(F.col("_first")))
        .select("key", "text")
    )
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("right"))

    def verify(batches):
        held: dict[int, np.ndarray] = {}

        def of(key, text):
            if key not in held:
                if len(held) > 64:
                    held.clear()
                grams = shingle_set(text, size)
                # Rows that repeat an id with another text are not the document meant.
                same = int(np.uint64(_set_key(grams)).astype(np.int64)) == key
                if not same:
                    return None
                held[key] = grams
            return held[key]

        for batch in _small(batches):
            kept = []
            for a, b, one, two in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "left", "right"))):
                x, y = of(a, one), of(b, two)
                if x is None or y is None:
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    kept.append((a, b))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*kept)], names=["a", "b"]
                )

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return rows.mapInArrow(verify, "a long, b long")


def _nearest_leaders(postings: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """``key, leader``: for a node the nearest of the three leaders with which it shares most
    prefix n-grams, out of two drawn for each n-gram."""
    rows = postings.select("gram", "key")
    drawn = F.struct(F.xxhash64("key", F.lit(1)).alias("order"), "key")
    leaders = rows.groupBy("gram").agg(F.min(drawn).alias("first"), F.max(drawn).alias("last"))
    leaders = leaders.select("gram", F.array("first.key", "last.key").alias("leaders"))
    offers = (
        rows.join(leaders, "gram")
        .select("key", F.explode("leaders").alias("leader"))
        .filter("key <> leader")
        .groupBy("key", "leader")
        .agg(F.count(F.lit(1)).alias("common"))
        # A node has no more leaders than twice the n-grams of its prefix.
        .groupBy("key")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("common", "leader")), False), 1, 3).alias("best"))
        .select("key", F.explode("best.leader").alias("leader"))
    )
    one, two = facts.alias("one"), facts.alias("two")
    n, m = F.col("one.n"), F.col("two.n")
    apart = _apart(lambda c: F.col(f"one.{c}"), lambda c: F.col(f"two.{c}"))
    return (
        offers.alias("offers")
        .join(one, F.col("offers.key") == F.col("one.key"))
        .join(
            two,
            (F.col("offers.leader") == F.col("two.key"))
            & _long_enough(n, m, percent)
            & _near_enough(n, m, apart, percent),
        )
        .groupBy(F.col("offers.key").alias("key"))
        .agg(F.max_by("offers.leader", F.struct(-apart / (n + m), "offers.leader")).alias("leader"))
    )


def _between(postings: DataFrame, known: DataFrame) -> DataFrame:
    """The postings of n-grams that more than one component has, with their ``component``
    and the number of postings of their n-gram, ``held``."""
    rows = postings.join(known, "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    open_ = (
        rows.groupBy("gram")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("greatest"),
            F.count(F.lit(1)).alias("held"),
        )
        .filter("least <> greatest")
        .select("gram", "held")
    )
    return rows.join(open_, "gram")


def _meetings(rows: DataFrame, facts: DataFrame, percent: int, on: list[str]) -> DataFrame:
    """``a, b, apart`` for rows of different components that are equal in ``on`` and pass the
    length, positional and suffix filters; ``apart`` is a part of the sizes of both."""
    rows = rows.join(facts.drop("n"), "key")
    one, two = rows.alias("one"), rows.alias("two")
    n, m = F.col("one.n"), F.col("two.n")
    i, j = F.col("one.place"), F.col("two.place")
    apart = _apart(lambda c: F.col(f"one.{c}"), lambda c: F.col(f"two.{c}"))
    ahead = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return one.join(
        two,
        reduce(Column.__and__, (F.col(f"one.{c}") == F.col(f"two.{c}") for c in on))
        & (F.col("one.key") < F.col("two.key"))
        & (F.col("one.component") != F.col("two.component"))
        & _long_enough(n, m, percent)
        & _overlap(n, m, ahead, percent)
        & _near_enough(n, m, apart, percent),
    ).select(
        F.col("one.key").alias("a"), F.col("two.key").alias("b"), (apart / (n + m)).alias("apart")
    )


def _nearest(pairs: DataFrame) -> DataFrame:
    """``key, leader``: for every node of ``pairs`` the one it is least apart from."""
    sides = F.array(
        F.struct(F.col("a").alias("key"), F.col("b").alias("leader")),
        F.struct(F.col("b").alias("key"), F.col("a").alias("leader")),
    )
    return (
        pairs.select("apart", F.inline(sides))
        .groupBy("key")
        .agg(F.max_by("leader", F.struct(-F.col("apart"), "leader")).alias("leader"))
    )


def _small(batches, rows: int = 200):
    """Arrow batches cut into ones of few rows, as texts are large once in Python."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def jaccard_components(
    documents: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``documents``.

    Two documents are linked if the Jaccard similarity of their sets of ``size``-word
    n-grams is at least ``percent`` / 100; the component is the smallest id that links
    reach. Words are lower-cased in A-Z; a text with fewer words is one n-gram; texts
    without words, or null, are linked with nothing. Rows that repeat an id are documents
    of their own. Other columns are not read.

    Linked sets share one of their rarest n-grams, so candidates meet on those. Equal sets
    are one node from the start. Then every node is checked against the nearest of three
    nodes with which it shares most prefix n-grams, out of two drawn for each n-gram; that
    joins most of a group of near copies with as many checks as it has members. Next, the
    nodes of an n-gram are dealt into shares of some 64, and every node is checked against
    the nearest one of another component that it meets in a share; that finds those members
    that are near some of a group only. At last all pairs that share a prefix n-gram, pass
    the length, positional and suffix filters and are not in one component yet are checked.
    So no link between components is lost, and a group's pairs are neither listed nor
    checked once the group is known.
    """
    documents = documents.select(
        F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    signed = stored(signatures(documents, size, percent))
    full = signed.filter("n > 0")
    nodes = stored(
        full.groupBy("key").agg(
            F.min("_id").alias("_first"), *(F.first(c).alias(c) for c in ("n", *_SKETCH))
        )
    )
    facts = nodes.drop("_first")
    long_sets = full.filter("wide is not null").select("key", "n", "wide")
    long_sets = stored(long_sets.dropDuplicates(["key"]))
    both = F.arrays_zip(F.col("prefix").alias("gram"), F.col("places").alias("place"))
    postings = full.select("key", "n", F.inline(both))
    meeting = (
        postings.groupBy("gram")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .filter("first <> last")
        .select("gram")
    )
    postings = stored(postings.join(meeting, "gram").dropDuplicates(["gram", "key"]))

    # One check for every node, twice.
    links, checked, known = None, None, None
    for _ in range(2):
        if known is None:
            chosen = _nearest_leaders(postings, facts, percent)
        else:
            share = F.pmod(F.xxhash64("gram", "key"), F.ceil(F.col("held") / _DRAWN))
            rows = _between(postings, known).withColumn("share", share)
            chosen = _nearest(_meetings(rows, facts, percent, ["gram", "share"]))
        stars = chosen.select(
            F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b")
        ).distinct()
        stars = stars if checked is None else stars.join(checked, ["a", "b"], "left_anti")
        stars = stored(_plausible(stars, long_sets, percent))
        found = stored(_verified(stars, nodes, documents, size, percent))
        links = found if links is None else links.unionByName(found)
        checked = stars if checked is None else checked.unionByName(stars)
        known = stored(components(links)).withColumnRenamed("node", "key")

    # All that is left between components.
    pairs = _meetings(_between(postings, known), facts, percent, ["gram"]).select("a", "b")
    pairs = pairs.distinct().join(checked, ["a", "b"], "left_anti")
    pairs = stored(_plausible(pairs, long_sets, percent))
    links = links.unionByName(_verified(pairs, nodes, documents, size, percent))
    found = stored(components(links)).withColumnRenamed("node", "key")

    placed = nodes.join(found, "key", "left").select(
        "key", "_first", F.coalesce("component", "key").alias("component")
    )
    smallest = placed.groupBy("component").agg(F.min("_first").alias("component_id"))
    named = placed.join(smallest, "component").select("key", "component_id")
    return (
        signed.select("_id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key"))
        .join(named, "key", "left")
        .select(
            F.col("_id").alias(id_column),
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "_id").alias("component_id"),
        )
    )


def one_of_each(
    documents: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``documents``, whole, one of each group of linked texts.

    Rows are told apart by a key of id and text, so rows that repeat an id, or have none,
    stay or go each on their own. Of a component the row with the smallest id stays (null
    ids come last, of equal ids the smallest hash of the text); of rows that repeat id and
    text one. Only rows that may have to go are shuffled with their texts.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    # Null and empty texts are linked with nothing and are not the same text.
    key = F.concat_ws(
        "|",
        F.sha2(F.concat_ws("|", text_column, F.col(text_column).isNull().cast("string")), 256),
        F.coalesce(F.col(id_column).cast("string"), F.lit("")),
        F.col(id_column).isNull().cast("string"),
    )
    keyed = documents.select(
        F.struct(
            F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), key.alias("key")
        ).alias("_key"),
        text.alias("_text"),
    )
    found = stored(jaccard_components(keyed, size, percent, "_key", "_text"))
    # Names that the caller's columns do not have.
    row, touched, goes, copies = free_names(documents.columns, "row", "touched", "goes", "copies")
    rows = found.groupBy(F.col("_key.key").alias(row)).agg(
        F.count(F.lit(1)).alias(copies),
        F.max(F.col("component_id") != F.col("_key")).alias(goes),
    )
    rows = stored(rows.filter(F.col(goes) | (F.col(copies) > 1)))
    marked = documents.withColumn(row, key)
    marked = marked.withColumn(touched, membership(rows, row)(row))
    looked_at = marked.filter(F.col(touched)).join(rows, row, "left")
    stays = looked_at.filter(~F.coalesce(goes, F.lit(False)))
    once = stays.filter(F.col(copies) > 1).dropDuplicates([row])
    return reduce(
        DataFrame.unionByName,
        [
            x.select(*(F.col(f"`{c}`") for c in documents.columns))
            for x in (
                marked.filter(~F.col(touched)),
                stays.filter(F.coalesce(copies, F.lit(1)) == 1),
                once,
            )
        ],
    )
