"""Sorted projection passes against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sunledger.llm import embedding_dedup as ed

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, n STRING, class LONG, vector INT"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, g, "clash", 5, 6) for i, v, g in rows], schema)


def brute(rows, cosine=ed.COSINE):
    """(vec_id, n_links, component_id, kept) of every row, by all pairs."""
    sound = [bool(v) and g is not None and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v, g in rows]
    units = [np.array(v) / np.abs(v).max() if s else None for (_, v, _), s in zip(rows, sound)]
    links = [set() for _ in rows]
    for x in range(len(rows)):
        for y in range(x):
            if sound[x] and sound[y] and rows[x][2] == rows[y][2] and len(units[x]) == len(units[y]):
                if units[x] @ units[y] / np.linalg.norm(units[x]) / np.linalg.norm(units[y]) >= cosine:
                    links[x].add(y)
                    links[y].add(x)
    result, done = {}, set()
    for x in range(len(rows)):
        if x not in done:
            reach, todo = {x}, [x]
            while todo:
                new = links[todo.pop()] - reach
                reach |= new
                todo += new
            done |= reach
            first = min((rows[y][0] for y in reach if rows[y][0] is not None), default=None)
            for y in reach:
                result[y] = (rows[y][0], len(links[y]), first, rows[y][0] == first)
    return sorted(map(repr, result.values()))


def shown(df):
    return sorted(repr((r.vec_id, r.n_links, r.component_id, r.kept)) for r in df.collect())


def near(rng, v, cosine):
    """A vector at the cosine of v."""
    w = rng.normal(size=len(v))
    w -= v * (w @ v) / (v @ v)
    w *= np.linalg.norm(v) / np.linalg.norm(w)
    return v * cosine + w * math.sqrt(1 - cosine * cosine)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    f = lambda v: [float(np.float32(c)) for c in v]
    made = []
    for k in range(60):
        v = rng.normal(size=16)
        made += [(10 * k + j, f(near(rng, v, c) * 3**j), k % 4) for j, c in enumerate((1, 0.999, 0.95, 0.931, 0.929, 0.9))]
    one = f(rng.normal(size=16))
    made += [(i, one, 1) for i in range(2000, 2040)] + [(2100, one, 2), (2101, one, None), (2101, one, 1), (None, one, 1), (2102, [2 * c for c in one], 1)]
    made += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 16, 1), (3003, [float("nan")] + one[1:], 1), (3004, [None, *one[1:]], 1), (3005, [float("inf")] * 16, 1)]
    made += [(3006, [1.0, 0.0], 1), (3007, [1.0, -0.0], 1), (3008, [1e38, 0.0], 1), (3009, [1e-44, 0.0], 1), (None, None, None), (None, [3.0], 9), (None, [4.0], 9)]
    return made


@pytest.fixture(scope="module")
def frame_(spark, rows):
    return frame(spark, rows).repartition(5).cache()


def test_one_window_is_exact(frame_, rows):
    want = brute(rows)
    assert shown(ed.near_vectors(frame_)) == want and sum("False" in w for w in want) > 100


def test_small_windows_find_nearly_all_links_and_none_below(frame_, rows):
    """Windows of ten rows in blocks of sixteen: many passes, seams, and crowds whose windows double."""
    got = {}
    for r in ed.near_vectors(frame_, window=10, block=16).collect():
        got.setdefault(r.vec_id, []).append(r.n_links)
    want = {}
    for i, n, _, _ in map(eval, brute(rows)):
        want.setdefault(i, []).append(n)
    total = sum(map(sum, want.values()))
    assert sum(map(sum, got.values())) >= 0.95 * total
    assert all(a <= b for i in want for a, b in zip(sorted(got[i]), sorted(want[i])))


def test_crowds_lose_no_link(spark):
    """Three hundred different vectors, all near each other, in windows of sixteen."""
    rng = np.random.default_rng(7)
    v = rng.normal(size=8)
    rows = [(i, [float(np.float32(c)) for c in near(rng, v, 0.995)], 1) for i in range(300)]
    rows += [(300 + i, [float(np.float32(c)) for c in rng.normal(size=8)], 1) for i in range(200)]
    found = {r.vec_id: r for r in ed.near_vectors(frame(spark, rows), window=16, block=32).collect()}
    want = {eval(w)[0]: eval(w) for w in brute(rows)}
    assert {found[i].component_id for i in range(300)} == {0} and all(found[i].n_links >= 299 for i in range(300))
    assert sum(r.n_links for r in found.values()) >= 0.99 * sum(w[1] for w in want.values())


def test_threshold_and_nothing(spark, frame_, rows):
    assert shown(ed.near_vectors(frame_, cosine=0.9995)) == brute(rows, 0.9995)
    assert ed.near_vectors(frame_.where("1 = 0")).count() == 0
    assert shown(ed.near_vectors(frame_.where("label IS NULL"))) == brute([r for r in rows if r[2] is None])


def test_shared_bits():
    a = np.array([0, 0, -1, 5, 1 << 40], np.int64)
    b = np.array([0, -1, -2, 4, 0], np.int64)
    assert ed.shared_bits(a, b).tolist() == [64, 0, 63, 63, 23]
