"""Whitening of embeddings from exact integer cross-products, by a bit-sliced scatter.

Entries become whole numbers on a fixed grid. Their scatter matrix is summed without rounding: the bits of each
dimension, shifted by its minimum, are packed across rows into words, and products of bits are AND-popcounts of words. So
the matrix does not depend on how the rows are dealt out, and it is centred as whole numbers before `eigh` sees a float.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import stored

GRID, OFFSET = 64, 1_000_000
# Grid entries beyond this are set to it.
LARGEST = 1 << 61
COMPONENTS = 32
# Rows whose bits are packed at once, bits of a partial sum that stay in one limb.
ROWS_PER_STEP = 1 << 14
LIMB = 16
# An eigenvalue not above this share of the largest, times the number of dimensions, counts as zero.
NOISE = 2.0**-49
EXACT = 1 << 62


def on_grid(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry."""
    place = lambda c: F.floor(F.greatest(F.least(GRID * c.cast("double"), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))) + OFFSET
    return F.transform(vector, place)


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor empty and holds only finite entries, and of those the rows of the most
    frequent length (of several the greatest)."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    sound = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, lambda c: F.coalesce(finite(c.cast("double")), F.lit(False))))
    usual = sound.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).select("d").first()
    return sound.where(F.size(column) == F.lit(usual[0] if usual else 0))


def column_block(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def bit_planes(rows: np.ndarray, least: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Words of the bit planes of all dimensions, one plane below another: plane b of dimension d holds bit b of
    rows[:, d] - least[d], 64 rows to a word."""
    shifted = (rows - least).view(np.uint64)
    words = -(-len(rows) // 64)
    planes = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, n in enumerate(bits.tolist()):
        for b in range(n):
            packed = np.packbits(((shifted[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8))
            planes[at, : len(packed)] = packed
            at += 1
    return planes.view(np.uint64)


def scatter_limbs(planes: np.ndarray, bits: np.ndarray, limbs: np.ndarray) -> None:
    """Adds to limbs[k, d, e], d <= e, the sum over rows of the products of dimensions d and e: of bits b and c the popcount of
    both planes' AND, with weight 2^(b + c), kept as 2^(b + c - 16 k) in limb k."""
    owner = np.repeat(np.arange(len(bits)), bits)
    place = np.concatenate([np.arange(n) for n in bits.tolist()] or [np.zeros(0, np.int64)]).astype(np.int64)
    for i in range(len(planes)):
        first = int(np.searchsorted(owner, owner[i]))
        together = np.bitwise_count(planes[first:] & planes[i]).sum(axis=1, dtype=np.int64)
        weight = place[first:] + place[i]
        np.add.at(limbs, (weight // LIMB, owner[i], owner[first:]), together << (weight % LIMB))


@dataclass(frozen=True)
class Whitening:
    """n rows, their sums and exact scatter about the mean (times n^2: n sum(xy) - sum(x) sum(y), Python integers), and
    the kept components as columns, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    scatter: tuple[tuple[int, ...], ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def identity_error(self) -> float:
        """Largest entry of the whitened rows' covariance minus the identity, from the exact covariance."""
        if not len(self.values):
            return 0.0
        scaled = self.vectors / np.sqrt(self.values)
        return float(np.abs(scaled.T @ covariance(self.scatter, self.n) @ scaled - np.eye(len(self.values))).max())


def covariance(scatter, n: int) -> np.ndarray:
    """n^2 V as whole numbers to V as doubles, each entry rounded once."""
    return np.array([[v / (n * n) for v in row] for row in scatter], np.float64).reshape(len(scatter), -1)


def scatter_sums(grid: DataFrame, least: np.ndarray, most: np.ndarray) -> list[list[int]]:
    """Sums over all rows of the products of the shifted dimensions, as Python integers. Every task sums its rows, Spark
    adds the tasks' sums; dims^2 / 2 sums of a few limbs come back."""
    dims = len(least)
    bits = np.array([int(b - a).bit_length() for a, b in zip(least.tolist(), most.tolist())])
    depth = 2 * int(bits.max(initial=0)) // LIMB + 1

    def run(batches):
        limbs, any_rows = np.zeros((depth, dims, dims), np.int64), False
        for batch in batches:
            rows = column_block(batch.column(0), dims)
            for at in range(0, len(rows), ROWS_PER_STEP):
                scatter_limbs(bit_planes(rows[at : at + ROWS_PER_STEP], least, bits), bits, limbs)
                any_rows = True
        if any_rows:
            k, d, e = np.nonzero(limbs)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in (k, d, e)] + [pa.array(limbs[k, d, e])], ["k", "d", "e", "v"])

    total = [[0] * dims for _ in range(dims)]
    parts = grid.select("x").mapInArrow(run, "k int, d int, e int, v long")
    for r in parts.groupBy("k", "d", "e").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        total[r.d][r.e] += int(r.v) << (LIMB * r.k)
    return [[total[min(d, e)][max(d, e)] for e in range(dims)] for d in range(dims)]


def fit(grid: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of `grid` (column x, arrays of longs of one length); None if there are none."""
    ends = grid.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.min("v").alias("a"), F.max("v").alias("b")
    )
    ends = ends.orderBy("d").collect()
    if not ends:
        return None
    n, sums = ends[0].n, [int(r.s) for r in ends]
    least, most = (np.array([r[c] for r in ends], np.int64) for c in ("a", "b"))
    products = scatter_sums(grid, least, most)
    # Covariances do not feel the shift, so the shifted sums centre the shifted products.
    moved = [s - n * int(a) for s, a in zip(sums, least.tolist())]
    scatter = tuple(tuple(n * p - a * b for p, b in zip(row, moved)) for row, a in zip(products, moved))
    v = covariance(scatter, n)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > max(values.max(), 0.0) * len(v) * NOISE]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return Whitening(n, tuple(sums), scatter, vectors * signs, values[order], sum(scatter[d][d] for d in range(len(v))) / (n * n))


def centred(rows: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - S, exactly: int64 where it fits, otherwise Python integers."""
    sums = np.array(model.sums, dtype=object)
    wide = max(int(np.abs(rows).max(initial=0)) * model.n, max(abs(s) for s in model.sums)) * 2
    if wide < EXACT:
        return rows * model.n - sums.astype(np.int64)
    return rows.astype(object) * model.n - sums


def deviations(centre: np.ndarray) -> list[int]:
    """Sum over dimensions of the squares, exactly."""
    largest = int(np.abs(centre).max(initial=0))
    if centre.dtype != object and largest * largest * centre.shape[1] < EXACT:
        return (centre * centre).sum(axis=1).tolist()
    return [sum(int(c) * int(c) for c in row) for row in centre]


def whitened_rows(grid: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, whitened (an array of doubles, one for each component) of every row of `grid`."""
    dims, scaled = len(model.sums), model.vectors / np.sqrt(model.values) / model.n

    def run(batches):
        for batch in batches:
            rows = column_block(batch.column(1), dims)
            for at in range(0, len(rows), ROWS_PER_STEP):
                part = rows[at : at + ROWS_PER_STEP]
                centre = centred(part, model)
                flat = pa.array((centre.astype(np.float64) @ scaled).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * scaled.shape[1]), flat)
                sums = [x if x < 1 << 63 else None for x in deviations(centre)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + ROWS_PER_STEP], pa.array(sums, pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    kind = grid.schema["vec_id"].dataType.simpleString()
    return grid.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """Per usable row and component (from 1): vec_id, component, n, deviation, whitened, explained, identity_error.

    The fit covers all usable rows; repeated rows and ids count each, labels and other columns play no part. Rows that
    are null, empty or hold null or non-finite entries are dropped, and so are those of another length than the usual
    one. Grid entries are cut off at 2^61. Components whose eigenvalue is zero but for rounding have no scale and are left
    out: equal rows alone give no rows. `deviation` is exact; beyond a long it is null. No usable rows, no rows.

    Only the sums of products, dims^2 numbers, pass through the driver; components are signed so that their largest
    entry is positive.
    """
    grid = stored(usable(vectors, column).select("vec_id", on_grid(F.col(column)).alias("x")), "grid-vectors")
    model = fit(grid, components)
    if model is None or not len(model.values):
        kind = vectors.schema["vec_id"].dataType.simpleString()
        empty = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return whitened_rows(grid, model).select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
