"""Whitening against whole-number arithmetic and numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sunledger.llm import whitening

SCHEMA = "vec_id LONG, embedding ARRAY<{0}>, label INT, n STRING, x STRING, d INT"


def frame(spark, vectors, kind="FLOAT"):
    return spark.createDataFrame([(i, v, i if i is None else i % 3, "clash", "x", 0) for i, v in vectors], SCHEMA.format(kind))


def whole(v):
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


@given(st.integers(1, 200), st.integers(1, 5), st.integers(0, 40), st.integers(0, 2**32))
@settings(max_examples=60, deadline=None)
def test_popcounts_give_exact_products(rows, dims, bits, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-(1 << bits), (1 << bits) + 1, (rows, dims)) * rng.integers(0, 2, dims)
    least, most = x.min(axis=0), x.max(axis=0)
    width = np.array([int(b - a).bit_length() for a, b in zip(least, most)])
    limbs = np.zeros((2 * int(width.max()) // whitening.LIMB + 1, dims, dims), np.int64)
    for at in range(0, rows, 70):
        whitening.scatter_limbs(whitening.bit_planes(x[at : at + 70], least, width), width, limbs)
    y = (x - least).astype(object)
    for d in range(dims):
        for e in range(d, dims):
            assert sum(int(limbs[k, d, e]) << (whitening.LIMB * k) for k in range(len(limbs))) == int((y[:, d] * y[:, e]).sum())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + [0, 3, -2, 0, 7]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (None, rows[9][1])]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf")] + [0.0] * 4), (904, []), (905, [1.0] * 4)]
    return rows, bad


def test_whitening(spark, vectors):
    rows, bad = vectors
    got = whitening.whiten(frame(spark, rows + bad).repartition(6)).collect()
    x = [whole(v) for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    v = np.cov(np.array(x, float).T, bias=True)
    values, components = np.linalg.eigh(v)
    assert len(got) == 5 * n and {r.n for r in got} == {n} and not {r.vec_id for r in got} & {i for i, _ in bad}
    want = sorted((repr(i), sum((n * c - s) ** 2 for c, s in zip(row, sums))) for (i, _), row in zip(rows, x))
    assert sorted((repr(r.vec_id), r.deviation) for r in got if r.component == 1) == want
    table = {}
    for r in got:
        if r.vec_id is not None and r.vec_id != 7:
            table.setdefault(r.vec_id, {})[r.component] = r.whitened
    for k in range(1, 6):
        mine = np.array([table[i][k] for i in sorted(table)])
        axis = components[:, -k]
        other = np.array([(np.array(row) - np.array(sums) / n) @ axis for (i, _), row in zip(rows, x) if i is not None and i != 7]) / np.sqrt(values[-k])
        assert min(np.abs(mine - other).max(), np.abs(mine + other).max()) < 1e-7
        shares = {r.explained for r in got if r.component == k}
        assert len(shares) == 1 and shares.pop() == pytest.approx(values[-k] / np.trace(v), rel=1e-9)
    w = np.array([[r.whitened for r in got if r.component == k] for k in range(1, 6)])
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9 and np.abs(w @ w.T / n - np.eye(5)).max() < 1e-6


def test_result_does_not_depend_on_the_partitions(spark, vectors):
    rows, _ = vectors
    one, other = (sorted(map(repr, whitening.whiten(frame(spark, rows).repartition(k), 3).collect())) for k in (1, 9))
    assert one == other and len(one) == 3 * len(rows)


def test_wide_values_stay_exact(spark):
    rows = [(i, [1e9 * i, -1e8 * i * i, float(i)]) for i in range(12)]
    x = [whole(v) for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, rows, "DOUBLE")).collect()}
    want = {i: sum((12 * c - s) ** 2 for c, s in zip(row, sums)) for (i, _), row in zip(rows, x)}
    assert got == {i: d if d < 1 << 63 else None for i, d in want.items()}
    huge = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "DOUBLE")).collect()
    assert len(huge) == 3 and all(math.isfinite(r.whitened) and (r.deviation is None) == (r.vec_id != 3) for r in huge)


def test_no_spread_and_no_rows(spark, vectors):
    assert whitening.whiten(frame(spark, vectors[1][:-1])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = whitening.whiten(frame(spark, [(i, [float(i), 5.0, 2.0 * i]) for i in range(9)])).collect()
    assert len(flat) == 9 and flat[0].explained == pytest.approx(1) and flat[0].identity_error < 1e-9
    assert whitening.whiten(frame(spark, []), 32).columns == whitening.whiten(frame(spark, vectors[0][:4])).columns
