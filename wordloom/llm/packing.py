"""Packing of documents into sequences by vector best-fit."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, isqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.byte_bpe import load
from wordloom.llm.common import free_names, schema_of, stored, text_slices


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, documents, and attention cost.

    The attention cost of a piece is the square of its length, as attention stays within
    a document. Without a limit of their own, documents and cost are bounded only by what
    2048 (or ``tokens``) tokens can hold.
    """

    tokens: int
    documents: int | None = None
    attention: int | None = None

    @property
    def vector(self) -> np.ndarray:
        return np.array(
            [self.tokens, self.documents or self.tokens, self.attention or self.tokens**2],
            dtype=np.int64,
        )

    @property
    def piece(self) -> int:
        """The longest piece that fits an empty sequence."""
        return min(self.tokens, isqrt(int(self.vector[2])))


def cut_documents(
    documents: DataFrame,
    vocabulary: str,
    longest: int,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the token ids of every document, with
    ``end_id`` after them, in pieces of at most ``longest``; only the first may be shorter.

    A null text is an empty one, so every row of ``documents`` gives a piece.
    """

    def cut(batches):
        bpe = load(vocabulary)
        for batch, texts in text_slices(batches, text_column):
            flat, sizes = bpe.ids(texts)
            flat = np.insert(flat.astype("<u4"), np.cumsum(sizes), end_id)
            sizes = sizes + 1
            number = -(-sizes // longest)
            row = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            first = sizes - (number - 1) * longest
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * longest)
            length = np.where(piece == 0, first[row], longest)
            begin = (np.cumsum(sizes) - sizes)[row] + start
            sums = [crc32(flat[b : b + n]) for b, n in zip(begin.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=[id_column, "piece", "start", "length", "ids_crc32"],
            )

    rows = documents.select(id_column, text_column)
    schema = schema_of(
        rows, [id_column], piece="int", start="long", length="long", ids_crc32="long"
    )
    return rows.mapInArrow(cut, schema)


def best_fit(
    lengths: np.ndarray,
    capacity: np.ndarray,
    weights: np.ndarray,
    rule: str,
) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of every piece, longest pieces first.

    Of the bins in which the piece keeps to every capacity, the one is taken whose
    residual has the smallest weighted norm afterwards (``norm``), or whose residual has
    the largest weighted dot product with the piece (``dot``); a new one if none fits.
    """
    scale = weights / capacity.astype(float) ** 2
    bins, offsets = np.empty((2, len(lengths)), dtype=np.int64)
    residual = np.empty((0, 3), dtype=np.int64)  # of the bins that may still take something
    name = np.empty(0, dtype=np.int64)
    total = 0
    order = np.argsort(-lengths, kind="stable")
    ordered = lengths[order]
    ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) + 1 if len(order) else []
    begin = 0
    for end in ends:
        length = int(ordered[begin])
        item = np.array([length, 1, length * length], dtype=np.int64)
        waiting = order[begin:end]
        begin = end
        while len(waiting):
            room = (residual // item).min(axis=1) if len(residual) else np.empty(0, dtype=np.int64)
            fits = np.flatnonzero(room > 0)
            if not len(fits):
                # Equal pieces fill new bins one after the other.
                each = int((capacity // item).min())
                new = -(-len(waiting) // each) if rule == "norm" else 1
                residual = np.concatenate([residual, np.tile(capacity, (new, 1))])
                name = np.concatenate([name, total + np.arange(new)])
                total += new
                continue
            left = residual[fits]
            if rule == "norm":
                # A bin that takes a piece has the smallest norm for the next equal piece,
                # too: bins are filled in the order of their norms.
                score = (scale * (left - item).astype(float) ** 2).sum(axis=1)
                ranked = fits[np.lexsort((name[fits], score))]
                upto = np.cumsum(room[ranked])
                taken = np.minimum(room[ranked], np.maximum(0, len(waiting) - (upto - room[ranked])))
                ranked, taken = ranked[taken > 0], taken[taken > 0]
            else:
                score = (scale * item * left.astype(float)).sum(axis=1)
                ranked, taken = fits[[np.lexsort((name[fits], -score))[0]]], np.array([1])
            chosen = np.repeat(ranked, taken)
            step = np.arange(len(chosen)) - np.repeat(np.cumsum(taken) - taken, taken)
            put, waiting = waiting[: len(chosen)], waiting[len(chosen) :]
            bins[put] = name[chosen]
            offsets[put] = capacity[0] - residual[chosen, 0] + step * length
            residual[ranked] -= taken[:, None] * item
        smallest = int(ordered[-1])
        open_ = (residual >= np.array([smallest, 1, smallest * smallest])).all(axis=1)
        residual, name = residual[open_], name[open_]
    return bins, offsets


def pack(
    pieces: DataFrame,
    capacity: Capacity,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    rule: str = "norm",
    group_size: int = 8192,
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, packed without gaps.

    ``pieces`` has a ``length`` of at most ``capacity.piece`` in every row; its other
    columns are carried along, but for ones of the two names. Rows are dealt in turn into groups of ``group_size``, each
    packed by one task: at most one badly filled sequence a group, and no key, however
    frequent, can fill a group. Equal pieces are told apart by their rows.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    rows = stored(pieces.drop("sequence_id", "offset"))
    (name,) = free_names(rows.columns, "group")
    groups = max(1, ceil(rows.count() / group_size))
    limits, scale = capacity.vector, np.array(weights)
    # The table is stored, so that a repeated task gives its rows the same numbers.
    number = F.monotonically_increasing_id()
    dealt = rows.withColumn(name, F.pmod(number + (number / 2**33).cast("long"), F.lit(groups)))

    def fill(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit(lengths, limits, scale, rule)
        sequence = key[0].as_py() * (1 << 32) + bins
        return (
            group.drop_columns([name])
            .append_column("sequence_id", pa.array(sequence, pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    schema = schema_of(rows, rows.columns, sequence_id="long", offset="long")
    return dealt.groupBy(name).applyInArrow(fill, schema)


def pack_documents(
    documents: DataFrame, vocabulary: str, capacity: Capacity, end_id: int = 0, **options
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for all documents.

    Null texts are empty documents, repeated rows are packed each, a null id stays null,
    an empty table gives no rows; columns other than the id and the text are not read.
    """
    pieces = cut_documents(documents, vocabulary, capacity.piece, end_id)
    return pack(pieces, capacity, **options)
