"""Token counts and packing against the tokenizers library and brute force."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ODD
from wordloom.llm.byte_bpe import load
from wordloom.llm.packing import Capacity, best_fit, pack, pack_documents
from wordloom.llm.token_counts import count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(8))
def test_ids_equal_the_library(library, seed):
    pick = random.Random(seed)
    parts = ["'s", "'", "s", "re", "'re", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "!", "...",
             "<|endoftext|>", "<|endo", "中", "🎉", " ", "　", "\x1c", "'LL", "aaaa", "\r\n", "\0"]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 30))) for _ in range(150)]
    texts += ["", "ab" * 500, "".join(pick.choices("abcdefgh", k=3000)), " " * 500]
    flat, sizes = load(PATH).ids(texts)
    wanted = [ids_of(library, text) for text in texts]
    assert sizes.tolist() == [len(w) for w in wanted]
    assert flat.tolist() == [i for w in wanted for i in w]
    assert load(PATH).counts(texts).tolist() == sizes.tolist()


def test_every_character(library):
    points = [chr(c) for c in range(1, 0x3000)]
    texts = ["".join(f"a{c}b {c}1" for c in points[i : i + 300]) for i in range(0, len(points), 300)]
    assert load(PATH).counts(texts).tolist() == [len(ids_of(library, t)) for t in texts]


def test_counts_of_odd_rows(docs, library):
    found = count_tokens(docs(*ODD), PATH, limit=1024).collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    wanted = []
    for i, text in ODD:
        n = len(ids_of(library, text))
        wanted.append((i, len((text or "").encode()), n, n > 1024))
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    assert count_tokens(docs(*ODD).limit(0), PATH, limit=1).count() == 0


def check_packed(rows, capacity):
    bins = {}
    for row in rows:
        bins.setdefault(row["sequence_id"], []).append(row)
    for held in bins.values():
        held.sort(key=lambda row: row["offset"])
        at = 0
        for row in held:
            assert row["offset"] == at
            at += row["length"]
        assert at <= capacity.tokens
        assert len(held) <= capacity.vector[1]
        assert sum(row["length"] ** 2 for row in held) <= capacity.vector[2]
    return bins


@pytest.mark.parametrize(
    "capacity",
    [Capacity(2048), Capacity(2048, documents=2), Capacity(2048, attention=1000**2)],
)
@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_of_odd_rows(docs, library, capacity, rule):
    rows = pack_documents(docs(*ODD), PATH, capacity, rule=rule).collect()
    check_packed(rows, capacity)
    pieces = {}
    for row in rows:
        pieces.setdefault(row["doc_id"], []).append((row["piece"], row["start"], row["length"], row["ids_crc32"]))
    for i, text in {(i, t) for i, t in ODD}:
        ids = np.array([*ids_of(library, text), 0], dtype="<u4")
        times = sum(1 for other in ODD if other[0] == i)
        wanted, stop, number = [], len(ids), -(-len(ids) // capacity.piece)
        for piece in reversed(range(number)):
            start = max(0, stop - capacity.piece)
            wanted.append((piece, start, stop - start, crc32(ids[start:stop].tobytes())))
            stop = start
        assert sorted(pieces[i]) == sorted(wanted * times)


def test_packing_of_nothing(docs):
    assert pack_documents(docs(*ODD).limit(0), PATH, Capacity(2048)).count() == 0
    with pytest.raises(ValueError):
        pack(docs(*ODD), Capacity(8), rule="first")


@pytest.mark.parametrize("seed", range(6))
def test_norm_rule_is_greedy_best_fit(seed):
    """Against one piece at a time, every bin looked at."""
    pick = np.random.default_rng(seed)
    capacity = np.array([100, 6, 4000])
    weights = np.array([1.0, 0.3, 0.2])
    lengths = pick.integers(1, 60, 120)
    bins, offsets = best_fit(lengths, capacity, weights, "norm")
    scale = weights / capacity.astype(float) ** 2
    residual, wanted = [], {}
    for place in np.argsort(-lengths, kind="stable"):
        item = np.array([lengths[place], 1, lengths[place] ** 2])
        fits = [b for b, r in enumerate(residual) if (r >= item).all()]
        if fits:
            chosen = min(fits, key=lambda b: ((scale * (residual[b] - item).astype(float) ** 2).sum(), b))
        else:
            residual.append(capacity.copy())
            chosen = len(residual) - 1
        wanted[place] = chosen
        residual[chosen] = residual[chosen] - item
    assert bins.tolist() == [wanted[p] for p in range(len(lengths))]
    assert bins.max() + 1 == len(residual)


def test_small_documents_fill_sequences(spark):
    rows = spark.range(5000).selectExpr("id", "pmod(hash(id), 700) + 1 as length")
    found = pack(rows, Capacity(2048)).collect()
    bins = check_packed(found, Capacity(2048))
    total = sum(row["length"] for row in found)
    assert len(bins) <= -(-total // 2048) + 1
