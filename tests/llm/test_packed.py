"""Packed numbers come back as they were."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from wordloom.llm.packed import (
    bundled,
    pack_counts,
    pack_sorted,
    unbundled,
    unpack_counts,
    unpack_sorted,
)


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_sorted_numbers(values):
    array = np.array(sorted(values), dtype=np.uint64)
    assert (unpack_sorted(pack_sorted(array)) == array).all()


@given(st.lists(st.integers(0, 2**62) | st.integers(0, 300), max_size=50))
def test_counts(values):
    array = np.array(values, dtype=np.int64)
    assert (unpack_counts(pack_counts(array)) == array).all()


@pytest.mark.parametrize("n", [1, 1000, 200_000])
def test_hashes_take_few_bytes(n):
    array = np.sort(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    packed = pack_sorted(array)
    assert (unpack_sorted(packed) == array).all()
    assert len(packed) <= 24 + n * (9 if n < 10 else 8 if n < 100_000 else 7)  # 24: the head
    narrow = array >> np.uint64(34)  # one of 2**30 places
    assert (unpack_sorted(pack_sorted(narrow)) == narrow).all()


def test_counts_that_are_mostly_the_same_take_few_bytes():
    counts = np.where(np.arange(100_000) % 100 == 0, 300, 1)
    packed = pack_counts(counts)
    assert (unpack_counts(packed) == counts).all() and len(packed) < 100_000 // 5


def test_texts_of_a_block_are_one_piece():
    texts = ["a b " * 50, "", "ü\n", "x", "", "a b " * 50]
    ids = [3, None, 3, 9, 10, 11]
    blocks = [2, 0, 2, 1, 7, 2]
    batch = pa.record_batch({"_id": pa.array(ids), "_text": pa.array(texts), "block": pa.array(blocks, pa.int32())})
    rows = pa.Table.from_batches(list(bundled(iter([batch, batch.slice(0, 0), batch.slice(4)]))))
    assert sorted(rows["block"].to_pylist()) == [0, 1, 2, 2, 7, 7]
    assert sum(map(len, rows["texts"].to_pylist())) < 300
    found = []
    for block in set(blocks):
        some = rows.filter(pa.compute.equal(rows["block"], block))
        got, parts = unbundled(some)
        found += zip([block] * len(parts), got.to_pylist(), parts)
    wanted = list(zip(blocks, ids, texts)) + list(zip(blocks, ids, texts))[4:]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
