"""Sorted hashes, small counts and texts as bytes, for what goes through a shuffle."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising 64-bit numbers as their differences.

    So many low bytes of a difference that the rest is about 16 on average are written as
    they are; the rest is a byte, or 255 and a number of 8 bytes at the end. These bytes
    are far from even and are compressed.
    """
    n = len(values)
    if n == 0:
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    mean = int(values[-1] - values[0]) // n + 1
    low = max(0, min(7, -(-(mean.bit_length() - 4) // 8)))
    rest = steps >> np.uint64(8 * low)
    high, more = _escaped(rest)
    raw = steps.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low]
    high = zlib.compress(high, 1)
    head = np.array([n, low, len(high)], dtype="<u4").tobytes()
    return head + high + np.ascontiguousarray(raw.T).tobytes() + more


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    n, low, size = (int(x) for x in np.frombuffer(data, "<u4", 3))
    begin = 12 + size
    rest = _plain(zlib.decompress(data[12:begin]), data[begin + n * low :])
    raw = np.zeros((n, 8), dtype=np.uint8)
    raw[:, :low] = np.frombuffer(data, np.uint8, n * low, begin).reshape(low, n).T
    steps = raw.view("<u8").reshape(-1) | (rest << np.uint64(8 * low))
    return np.cumsum(steps, dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Numbers that are small mostly: a byte each, or 255 and 8 bytes at the end. Most are
    the same, so the bytes are compressed."""
    high, more = _escaped(values.astype(np.uint64))
    high = zlib.compress(high, 1)
    return np.array([len(high)], dtype="<u4").tobytes() + high + more


def unpack_counts(data: bytes) -> np.ndarray:
    end = 4 + int(np.frombuffer(data, "<u4", 1)[0])
    return _plain(zlib.decompress(data[4:end]), data[end:]).astype(np.int64)


def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, sizes, texts, ids`` of rows ``_id, _text, block``: those rows of a batch that
    go to the same block as one, with their texts in one compressed piece and the numbers of
    bytes that each has of it."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        firsts = np.flatnonzero(np.diff(blocks[order], prepend=-1))
        ends = pa.array(np.append(firsts, len(order)), pa.int32())
        texts = batch.column("_text").cast(pa.binary()).take(pa.array(order))
        sizes = pc.binary_length(texts)
        pieces = [
            pa.compress(b"".join(texts.slice(first, end - first).to_pylist()), "zstd", asbytes=True)
            for first, end in zip(firsts.tolist(), ends.to_pylist()[1:])
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(blocks[order][firsts], pa.int32()),
                pa.ListArray.from_arrays(ends, sizes),
                pa.array(pieces, pa.binary()),
                pa.ListArray.from_arrays(ends, batch.column("_id").take(pa.array(order))),
            ],
            names=["block", "sizes", "texts", "ids"],
        )


def unbundled(rows: pa.Table) -> tuple[pa.ChunkedArray, list[str]]:
    """The ids and the texts of some rows of :func:`bundled`."""
    texts = []
    for sizes, piece in zip(rows["sizes"].to_pylist(), rows["texts"].to_pylist()):
        whole = pa.decompress(piece, sum(sizes), "zstd", asbytes=True) if sum(sizes) else b""
        ends = np.cumsum(sizes).tolist()
        texts += [whole[begin:end].decode() for begin, end in zip([0, *ends], ends)]
    return pc.list_flatten(rows["ids"]), texts


def _escaped(values: np.ndarray) -> tuple[bytes, bytes]:
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes(), values[large].astype("<u8").tobytes()


def _plain(small: bytes, large: bytes) -> np.ndarray:
    values = np.frombuffer(small, np.uint8).astype(np.uint64)
    values[values == 255] = np.frombuffer(large, "<u8")
    return values
