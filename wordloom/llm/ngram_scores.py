"""Stupid-backoff scores of documents from n-gram counts of the whole corpus."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import schema_of
from wordloom.llm.packed import (
    bundled,
    pack_counts,
    pack_sorted,
    unbundled,
    unpack_counts,
    unpack_sorted,
)
from wordloom.llm.shingles import shingle_hashes, word_hashes, words_of


class _Block:
    """The n-grams of some documents: for each order the distinct ones in the order of
    their hashes, and for each position its n-gram (-1: the document is too short)."""

    def __init__(self, texts: list[str], order: int):
        words = [words_of(text or "") for text in texts]
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.document = np.repeat(np.arange(len(words)), self.sizes)
        self.place = np.arange(len(self.document)) - np.repeat(
            np.cumsum(self.sizes) - self.sizes, self.sizes
        )
        hashes = np.concatenate([word_hashes(w) for w in words] or [np.zeros(0, np.uint64)])
        self.grams, self.counts, self.at = [], [], []
        for size in range(1, order + 1):
            at = np.full(len(hashes), -1, dtype=np.int64)
            ends = np.flatnonzero(self.place >= size - 1)
            found = (
                shingle_hashes(hashes, size)[ends - size + 1] if len(ends) else hashes[:0]
            )
            distinct, inverse, counts = np.unique(found, return_inverse=True, return_counts=True)
            at[ends] = inverse
            self.grams.append(distinct)
            self.counts.append(counts)
            self.at.append(at)

    def starts(self, size: int, parts: int) -> np.ndarray:
        """Where each of equal ranges of hashes begins among the n-grams."""
        edges = [part * 2**64 // parts for part in range(parts)]
        places = np.searchsorted(self.grams[size - 1], np.array(edges, dtype=np.uint64))
        return np.append(places, len(self.grams[size - 1]))

    def own(self, size: int) -> np.ndarray:
        """For every position how often its n-gram occurs in its document."""
        at = self.at[size - 1]
        own = np.ones(len(at), dtype=np.int64)
        # What the block has once its document has once.
        often = np.flatnonzero((at >= 0) & (self.counts[size - 1][at] > 1)) if len(self.counts[size - 1]) else at[:0]
        pair = self.document[often] * len(self.grams[size - 1]) + at[often]
        _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
        own[often] = counts[inverse]
        return own


def backoff_scores(
    documents: DataFrame,
    order: int = 2,
    backoff: float = 0.4,
    block_chars: int = 8_000_000,
    part_words: int = 4_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_words, log_score, log_per_word, n_backed_off`` for every row.

    A word scores the count of the n-gram it ends, over the count of the n-gram without
    it; if the n-gram occurs nowhere else, ``backoff`` times the score with one word less
    before it; a single word its count over all words, a word found nowhere else half a
    count. All counts are of the whole corpus without the document itself, so a text does
    not vouch for itself. ``log_score`` sums natural logarithms; ``log_per_word`` is null
    without words. Words are lower-cased in A-Z; null texts have none, repeated rows and
    null ids are kept, other columns are not read.

    Documents are dealt into blocks of about ``block_chars`` characters, in runs of 32 by
    their place in the input; what a batch has for a block goes there as one row, with the
    texts compressed together. A block sends its
    distinct n-grams with their counts, one row for each hash partition of the count tables,
    a range of hashes: sorted, as differences, six bytes or so each. There all counts of an
    n-gram meet (one for each block, however frequent it is), are summed, joined to what
    each block has sent, and go back, without hashes and less what the block itself has,
    mostly zeros. The blocks add up the scores of their documents. Blocks and partitions
    grow in number with the corpus and not in size.
    """
    rows = documents.select(
        F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text")
    )
    chars = rows.agg(F.sum(F.char_length("_text").cast("long"))).first()[0] or 0
    blocks = max(1, ceil(chars / block_chars))
    parts = max(1, ceil(chars / 6 * order / part_words))
    run = F.shiftright(F.monotonically_increasing_id(), 5)
    placed = rows.withColumn("block", F.pmod(F.xxhash64(run), F.lit(blocks)).cast("int"))
    fields = schema_of(placed, ["block"], sizes="array<int>", texts="binary")
    fields.add("ids", T.ArrayType(rows.schema["_id"].dataType))
    dealt = placed.mapInArrow(bundled, fields)

    def ask(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        block = _Block(unbundled(group)[1], order)
        orders, numbers, grams, counts = [], [], [], []
        for size in range(1, order + 1):
            starts = block.starts(size, parts)
            for part in np.flatnonzero(np.diff(starts)).tolist():
                some = slice(starts[part], starts[part + 1])
                orders.append(size)
                numbers.append(part)
                grams.append(pack_sorted(block.grams[size - 1][some]))
                counts.append(pack_counts(block.counts[size - 1][some]))
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(orders), pa.int32()),
                "size": pa.array(orders, pa.int32()),
                "part": pa.array(numbers, pa.int32()),
                "grams": pa.array(grams, pa.binary()),
                "counts": pa.array(counts, pa.binary()),
            }
        )

    def total(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """The count table of a partition, joined to the n-grams asked for."""
        grams = [unpack_sorted(x) for x in group["grams"].to_pylist()]
        counts = [unpack_counts(x) for x in group["counts"].to_pylist()]
        _, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        every = np.concatenate(counts)
        table = np.bincount(inverse, weights=every).astype(np.int64)
        elsewhere = np.split(table[inverse] - every, np.cumsum([len(x) for x in grams])[:-1])
        return pa.table(
            {
                "block": group["block"],
                "size": group["size"],
                "part": group["part"],
                "elsewhere": pa.array([pack_counts(x) for x in elsewhere], pa.binary()),
            }
        )

    asked = dealt.groupBy("block").applyInArrow(
        ask, "block int, size int, part int, grams binary, counts binary"
    )
    answers = asked.groupBy("size", "part").applyInArrow(
        total, "block int, size int, part int, elsewhere binary"
    )
    schema = schema_of(
        documents,
        [id_column],
        n_words="long",
        log_score="double",
        log_per_word="double",
        n_backed_off="long",
    )
    n_words = _count_words(rows)

    def score(key: tuple[pa.Scalar, ...], bundles: pa.Table, answered: pa.Table) -> pa.Table:
        ids, texts = unbundled(bundles)
        block = _Block(texts, order)
        found = [counts.astype(np.int64) for counts in block.counts]
        starts = [block.starts(size, parts) for size in range(1, order + 1)]
        for size, part, data in zip(*(answered[c].to_pylist() for c in ("size", "part", "elsewhere"))):
            found[size - 1][starts[size - 1][part] : starts[size - 1][part + 1]] += unpack_counts(data)
        others = []
        for size in range(1, order + 1):
            at = block.at[size - 1]
            known = found[size - 1][at] if len(found[size - 1]) else np.zeros(len(at), np.int64)
            others.append(np.where(at >= 0, known - block.own(size), 0))
        corpus = np.maximum(n_words - block.sizes[block.document], 1)
        best = np.log(np.maximum(others[0], 0.5) / corpus)
        level = np.ones(len(best), dtype=np.int64)
        for size in range(2, order + 1):
            possible = block.at[size - 1] >= 0
            seen = possible & (others[size - 1] > 0)
            before = np.empty_like(others[size - 2])
            before[:1] = 0
            before[1:] = others[size - 2][:-1]
            # What goes before a seen n-gram is seen at least as often.
            before = np.maximum(before, others[size - 1])
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.log(others[size - 1] / before)
            best = np.where(seen, ratio, best + possible * np.log(backoff))
            level = np.where(seen, size, level)
        reached = np.minimum(block.place + 1, order)
        documents_in = len(block.sizes)
        sums = np.bincount(block.document, weights=best, minlength=documents_in).astype(float)
        backed = np.bincount(block.document, weights=level < reached, minlength=documents_in)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = sums / block.sizes
        return pa.table(
            {
                id_column: ids,
                "n_words": pa.array(block.sizes),
                "log_score": pa.array(sums),
                "log_per_word": pa.array(mean, mask=block.sizes == 0),
                "n_backed_off": pa.array(backed.astype(np.int64)),
            }
        )

    return (
        dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)
    )


def _count_words(rows: DataFrame) -> int:
    """All words of the corpus, counted by Spark."""
    inner = F.btrim(F.col("_text"), F.lit(" \t\n\x0b\f\r"))
    words = F.when(inner == "", 0).otherwise(F.regexp_count(inner, F.lit(r"[\x20\x09-\x0D]+")) + 1)
    return rows.agg(F.sum(words.cast("long"))).first()[0] or 0
