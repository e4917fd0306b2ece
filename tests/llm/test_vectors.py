"""Centroid clustering and whitening, against brute force and numpy."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordloom.llm.centroids import Search, cluster_vectors
from wordloom.llm.singular import bidiagonalise, right_singular
from wordloom.llm.whitening import whiten_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, _x string, _id string, n int"


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 1, 2, "x", "y", 3) for i, v in rows], SCHEMA)

    return make


def usable(rows):
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and abs(64 * x) < 2**27 for x in v):
            yield i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(int)


def some_rows(count=300, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.float32(rng.normal(i % 5, 0.5, 64))]) for i in range(count)]
    bad = rows[0][1][:-1]
    rows += [(1000, None), (1001, []), (1002, bad), (1003, [*bad, None]), (1004, [*bad, float("nan")])]
    rows += [(1005, [*bad, float("inf")]), (1006, [*bad, 1e30]), (None, rows[3][1]), (7, rows[7][1])]
    return rows + [(2000 + i, rows[9][1]) for i in range(50)]


def brute_clusters(rows, k=16, rounds=3):
    kept = list(usable(rows))
    name = lambda i: "null" if i is None else i
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{name(r[0])}".encode()).hexdigest(),))[:k]
    c = [v for _, v in first]
    for turn in range(rounds + 1):
        near = [min((int(((v - x) ** 2).sum()), j) for j, x in enumerate(c)) for _, v in kept]
        if turn < rounds:
            for j in range(len(c)):
                own = [v for (_, v), (_, of) in zip(kept, near) if of == j]
                if own:
                    c[j] = sum(own) // len(own)
    inertia = sum(d for d, _ in near)
    return sorted(
        (
            (name(i), j, d, sum(e for e, of in near if of == j), inertia,
             hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
            for (i, _), (d, j) in zip(kept, near)
        ),
        key=repr,
    )


@pytest.mark.parametrize("count", [300, 5])
def test_clusters_equal_brute_force(vectors, count):
    rows = some_rows(max(count, 10))[: None if count > 5 else 5]
    found = cluster_vectors(vectors(rows)).collect()
    assert sorted((("null" if r[0] is None else r[0], *r[1:]) for r in found), key=repr) == brute_clusters(rows)


def test_clusters_of_nothing(vectors):
    assert cluster_vectors(vectors([(1, None)])).collect() == []
    assert cluster_vectors(vectors([])).columns[:2] == ["vec_id", "cluster"]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 40), st.sampled_from([1, 3, 100, 2**26]))
def test_search_finds_the_nearest_and_the_smaller_number_of_ties(seed, k, size):
    rng = np.random.default_rng(seed)
    c, x = rng.integers(-size, size, (k, 8)), rng.integers(-size, size, (50, 8))
    x[:5] = c[rng.integers(0, k, 5)]
    number, distance, _ = Search(c).nearest(x)
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()


def test_search_passes_over_what_the_bounds_exclude():
    rng = np.random.default_rng(1)
    c = rng.integers(-9, 9, (100, 64)) * rng.integers(1, 9, (100, 1)) + rng.integers(-99, 99, (100, 1))
    _, _, computed = Search(c).nearest(c[rng.integers(0, 100, 1000)] + rng.integers(-2, 2, (1000, 64)))
    assert computed < 20_000  # of 100,000


def check_whitening(rows, found, components=16):
    kept = list(usable(rows))
    fit = np.unique(np.array([v for _, v in kept]), axis=0) + 1_000_000
    n, s = len(fit), fit.sum(axis=0)
    off = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(off.T @ off / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(found) == k * len(kept)
    by_row = {}
    for r in found:
        by_row.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    signs = {}
    for i, v in kept:
        x = v + 1_000_000
        exact = int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s)))
        wanted = (x - s / n) @ axes[:, :k] / np.sqrt(values[:k])
        for c in range(k):
            r = by_row[i][c + 1][0]
            assert (r["n"], r["deviation"]) == (n, exact)
            assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9
            if abs(wanted[c]) > 1e-3:
                signs.setdefault(c, np.sign(wanted[c] * r["whitened"]))
                assert r["whitened"] == pytest.approx(signs[c] * wanted[c], abs=1e-7)


def test_whitening_equals_numpy(vectors):
    rows = [r for r in some_rows() if r[0] is not None]
    check_whitening(rows, whiten_vectors(vectors(rows).repartition(40)).collect())


def test_whitening_with_fewer_directions_than_components(vectors):
    rows = some_rows(12)[:7]  # six directions at most
    check_whitening(rows, whiten_vectors(vectors(rows)).collect())


def test_whitening_of_nothing_and_of_one_vector(vectors):
    assert whiten_vectors(vectors([])).collect() == []
    assert whiten_vectors(vectors([(1, None)])).collect() == []
    assert whiten_vectors(vectors([(1, [0.5] * 64), (2, [0.5] * 64), (None, [0.5] * 64)])).collect() == []


def matrices():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    p, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    yield rng.normal(size=(24, 24))
    yield np.zeros((24, 24))
    yield np.eye(24)
    yield q
    yield np.diag(np.arange(24.0))
    yield p @ np.diag([1.0] * 8 + [2.0] * 8 + [3.0] * 8) @ q
    yield p @ np.diag([1.0] * 23 + [1 + 1e-13]) @ q
    yield np.diag(10.0 ** -np.arange(24.0)) @ q
    yield np.linalg.qr(rng.normal(size=(30, 4)) @ rng.normal(size=(4, 24)), mode="r")
    # Close pairs without a small entry beside the diagonal.
    w = np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield np.linalg.cholesky(w + 3 * np.eye(21)).T


@pytest.mark.parametrize("matrix", list(matrices()))
def test_singular_values_and_vectors(matrix):
    squares, v = right_singular(matrix)
    wanted = np.linalg.svd(matrix, compute_uv=False) ** 2
    largest = max(wanted[0], 1e-300)
    assert np.abs(squares - wanted).max() <= 1e-13 * largest
    assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-10
    assert np.abs(matrix.T @ (matrix @ v) - v * squares).max() <= 1e-12 * largest


def test_small_singular_values_are_accurate():
    """Relative to themselves, which an eigenvalue solver on the covariance would not give."""
    scales = 10.0 ** -np.arange(0, 12, 0.5)
    q, _ = np.linalg.qr(np.random.default_rng(5).normal(size=(24, 24)))
    squares, _ = right_singular(np.diag(scales) @ q)
    assert squares == pytest.approx(scales**2, rel=1e-12)


def test_bidiagonal_form():
    matrix = np.random.default_rng(7).normal(size=(9, 9))
    a, b, v = bidiagonalise(matrix)
    form = np.diag(a) + np.diag(b, 1)
    assert np.allclose(form.T @ form, v.T @ matrix.T @ matrix @ v)
