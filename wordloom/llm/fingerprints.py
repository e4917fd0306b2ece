"""SimHash fingerprints and the search for near ones in permuted block tables."""

from __future__ import annotations

from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.llm.common import schema_of, stored
from wordloom.llm.shingles import shingle_hashes, word_hashes, words_of
from wordloom.ordering import range_bounds, range_of

BITS = 64
_CHUNK = 1 << 15
_HEAD = 64  # characters of a text that tell rows of one id apart


def simhash(text: str, shingle: int = 5) -> int:
    """64 signed bits: every term votes with its number of occurrences.

    Terms are runs of ``shingle`` words (all words of a shorter text). A tied bit is 0, so
    a text without words has the fingerprint 0.
    """
    terms = shingle_hashes(word_hashes(words_of(text)), shingle)
    values, weights = np.unique(terms, return_counts=True)
    votes = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, len(values), _CHUNK):
        part = values[begin : begin + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float32)
        weight = weights[begin : begin + _CHUNK]
        votes += 2 * np.rint(weight.astype(np.float32) @ bits).astype(np.int64) - weight.sum()
    return int(np.packbits(votes > 0, bitorder="little").view("<u8")[0])


def likeness(left: int, right: int) -> float:
    """The share of equal bits."""
    return 1.0 - (left ^ right).bit_count() / BITS


def fingerprint_edited(
    documents: DataFrame, shingle: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``, one row per row of ``documents``.

    The edited text has the last half of a text replaced by the beginning of the next
    document's in order of falling id (numeric; null ids last, repeated ids by text); the
    first document follows the last. A null text is an empty one. Fingerprints are 16 hex
    digits.

    Rows are dealt by ranges of ids and, where ids are null or repeat, of the beginnings of
    the texts, found from a summary of those. The first row of each range is sent to the
    range before it as well, so a range has all it needs; the text is shuffled once. Tasks
    read their sorted rows as a stream.
    """
    spark = documents.sparkSession
    key = F.col(id_column).cast("long")
    text = F.coalesce(F.col(text_column), F.lit(""))
    order = ["no_id", "falling", "head"]
    rows = documents.select(
        key.isNull().alias("no_id"),
        F.bitwise_not(key).alias("falling"),  # -1 - id, which every long has
        F.substring(text, 1, _HEAD).alias("head"),
        F.col(id_column).alias("id"),
        text.alias("text"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(rows, order, parts)
    rows = rows.withColumn("range", range_of(order, bounds, rows.schema))

    # At most one row per range, whatever the size of the table.
    found = rows.groupBy("range").agg(F.min(F.struct(*order)).alias("first")).collect()
    firsts = sorted((row["range"], tuple(row["first"])) for row in found)
    told = spark.createDataFrame(
        [(place, firsts[i - 1][0], first) for i, (place, first) in enumerate(firsts)],
        "range int, before int, first struct<no_id:boolean,falling:long,head:string>",
    )
    number = lambda place, extra: F.struct(place.alias("range"), F.lit(extra).alias("extra"))
    own = number(F.col("range"), 0)
    is_first = F.struct(*order).eqNullSafe(F.col("first"))
    places = F.when(is_first, F.array(own, number(F.col("before"), 1))).otherwise(F.array(own))
    dealt = (
        rows.join(F.broadcast(told), "range")
        .select(F.inline(places), "no_id", "falling", "id", "text")
        .repartitionById(len(bounds) + 1, F.col("range"))
        .sortWithinPartitions("range", "extra", "no_id", "falling", "text")
    )

    def facts(row, following):
        identity, text, print_ = row
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        edited_print = print_ if edited == text else simhash(edited, shingle)
        return (
            identity,
            len(text),
            sha256(edited.encode()).hexdigest(),
            f"{print_:016x}",
            f"{edited_print:016x}",
            likeness(print_, edited_print),
            likeness(print_, following[2]),
        )

    def compare(batches):
        waiting, current, done = None, None, []
        for batch in batches:
            for place, extra, identity, text in zip(
                *(batch.column(c).to_pylist() for c in ("range", "extra", "id", "text"))
            ):
                if place != current:
                    waiting, current = None, place
                if extra and waiting is None:
                    continue  # only the first of the rows after a range counts
                row = (identity, text, simhash(text, shingle))
                if waiting is not None:
                    done.append(facts(waiting, row))
                waiting = None if extra else row
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done), arrow_schema)],
                    schema=arrow_schema,
                )
                done = []

    schema = schema_of(
        documents,
        [id_column],
        n_chars="long",
        edited_sha256="string",
        fingerprint="string",
        edited_fingerprint="string",
        near_edited="double",
        near_next="double",
    )
    arrow_schema = to_arrow_schema(schema)
    return dealt.select("range", "extra", "id", "text").mapInArrow(compare, schema)


def count_near(
    fingerprints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5, salts: int = 8
) -> DataFrame:
    """``fingerprint, n_near``: for every distinct fingerprint of ``queries`` the number of
    rows of ``fingerprints`` that differ in at most ``radius`` bits.

    Both have a ``fingerprint`` of 16 hex digits. The bits fall into blocks; ``radius``
    differing bits leave at least ``blocks - radius`` blocks alike, so there is a table
    for every choice of that many blocks, whose key is the bits of those blocks. Rows of
    a table with the same key are compared; a pair that meets in several tables counts in
    the first. Equal fingerprints are counted before, and a key's rows are dealt to
    ``salts`` groups to each of which its queries are sent, so no group of near copies
    meets in one task and no pairs are written.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("radius must be smaller than the number of blocks")
    edges = [BITS * n // blocks for n in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    tables = list(combinations(range(blocks), blocks - radius))
    table_mask = np.array([sum(masks[b] for b in chosen) for chosen in tables], dtype=np.uint64)
    first_table = np.full(1 << blocks, len(tables), dtype=np.int64)
    for alike in range(1 << blocks):
        hits = [n for n, chosen in enumerate(tables) if all(alike >> b & 1 for b in chosen)]
        first_table[alike] = hits[0] if hits else len(tables)
    block_masks = np.array(masks, dtype=np.uint64)

    value = F.conv("fingerprint", 16, -10).cast("long").alias("value")
    counted = fingerprints.select(value).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    asked = queries.select(value).distinct()
    signed = table_mask.view(np.int64).tolist()
    keys = F.posexplode(F.array(*(F.col("value").bitwiseAND(F.lit(m)) for m in signed)))
    index = counted.select("value", "n", keys.alias("table", "key"))
    index = index.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int"))
    probes = asked.select("value", F.lit(0).cast("long").alias("n"), keys.alias("table", "key"))
    probes = probes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = (
        index.unionByName(probes)
        .repartition("table", "key", "salt")
        .sortWithinPartitions("table", "key", "salt", "n")
        .select("table", "key", "salt", "value", "n")
    )

    def matches(table, value, n, begin, middle, end):
        for at in range(begin, middle, 256):
            asked_values = value[at : min(at + 256, middle), None]
            total = np.zeros(len(asked_values), dtype=np.int64)
            for start in range(middle, end, 8192):
                stop = min(start + 8192, end)
                differ = asked_values ^ value[start:stop]
                near = np.bitwise_count(differ) <= radius
                left, right = np.nonzero(near)
                alike = (differ[left, right][:, None] & block_masks) == 0
                first = first_table[alike @ (1 << np.arange(blocks))]
                counts = first == table
                np.add.at(total, left[counts], n[start:stop][right[counts]])
            found = np.flatnonzero(total)
            yield asked_values[found, 0].view(np.int64), total[found]

    def compare(batches):
        held = None
        for batch in _with_end(batches):
            columns = None if batch is None else [
                batch.column(c).to_numpy() for c in ("table", "key", "salt", "value", "n")
            ]
            if held is not None:
                columns = held if columns is None else [
                    np.concatenate(pair) for pair in zip(held, columns)
                ]
            if columns is None or not len(columns[0]):
                continue
            table, key, salt, value, n = columns
            change = (table[1:] != table[:-1]) | (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            begins = np.concatenate([[0], np.flatnonzero(change) + 1])
            ends = np.append(begins[1:], len(table))
            if batch is not None:  # the last group may go on
                held = [column[begins[-1] :] for column in columns]
                begins, ends = begins[:-1], ends[:-1]
            value = value.view(np.uint64)
            zeros = np.concatenate([[0], np.cumsum(n == 0)])
            probes_in = zeros[ends] - zeros[begins]
            both = np.flatnonzero((probes_in > 0) & (probes_in < ends - begins))
            found = [
                part
                for g in both
                for part in matches(
                    table[begins[g]], value, n, begins[g], begins[g] + probes_in[g], ends[g]
                )
            ]
            if found:
                values, totals = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(totals)], names=["value", "n"]
                )

    near = rows.mapInArrow(compare, "value long, n long")
    totals = near.groupBy("value").agg(F.sum("n").alias("n_near"))
    return totals.select(
        F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "n_near"
    )


def _with_end(batches):
    yield from batches
    yield None


def fingerprint_report(documents: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """``fingerprint_edited`` with ``n_near``: for documents whose id is divisible by
    ``every``, the number of other documents with a fingerprint within ``radius``; null
    for the others."""
    facts = stored(fingerprint_edited(documents))
    asked = F.col("doc_id") % every == 0
    near = count_near(facts, facts.filter(asked), radius)
    rows = facts.join(near, "fingerprint", "left")
    return rows.select(
        *facts.columns, F.when(asked, F.col("n_near") - 1).alias("n_near")
    )
