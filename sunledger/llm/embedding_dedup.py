"""Near-duplicate embeddings by sorted projection passes.

Each pass hashes every vector with random hyperplanes, sorts all vectors by the concatenated bits and compares each with
its next neighbours; pairs that pass the cosine are links, and the links of all passes are united. Close vectors agree on
most bits, so some pass sorts them next to each other.

No pair leaves a task. A row remembers its places in earlier passes and how far it was compared there, which tells whether a
pair was met before; so each pass counts its new links row by row, and passes on a spanning forest of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import discard, stored
from sunledger.llm.simhash import components

COSINE = 0.93
SEED = 20_011
# Bits of a pass's key, neighbours that a vector is compared with on either side, positions in a block of the sorted order.
KEY_BITS = 64
WINDOW = 512
BLOCK = 4096
# Passes go on until a pair at the threshold is missed with at most this chance, judged by the keys as they were sorted.
MISS = 0.01
MOST_PASSES = 96
# What the tasks of a pass return: 'count' (a: class, b: rows newly linked to it), 'edge' (a, b: classes of one component),
# 'open' (a: class, place), 'seen' (team, a: rows, chance).
RESULT = "kind string, team string, a long, b long, place long, chance double"
CARRIED = ["class", "team", "vector", "n", "places", "reaches"]


def unit_rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows; scaled by the largest entry first, so no square overflows."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def plain_vector(vectors: DataFrame, column: str):
    """The vector with zeros of either sign as one value; null if it may not link."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    sound = F.forall(column, lambda c: F.coalesce(finite(c), F.lit(False))) & F.exists(column, lambda c: c != 0)
    entry = vectors.schema[column].dataType.elementType
    plain = F.transform(column, lambda c: F.when(c == 0, F.lit(0).cast(entry)).otherwise(c))
    return F.when(F.col("label").isNotNull() & sound, plain)


def distinct_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(class, team, label, vector, n, least) per distinct vector of a label that may link: how many rows hold it and
    their smallest vec_id. Only vectors of a team, one label and length, are compared."""
    rows = vectors.select("label", "vec_id", plain_vector(vectors, column).alias("vector")).where(F.col("vector").isNotNull())
    grouped = rows.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    team = F.concat_ws("/", F.size("vector").cast("string"), F.col("label").cast("string"))
    return grouped.select(F.monotonically_increasing_id().alias("class"), team.alias("team"), "label", "vector", "n", "least")


def keyed(rows: DataFrame, number: int) -> DataFrame:
    """The rows with `key`, a long in the order of the pass's bits, first bit first. The hyperplanes depend on the pass
    and the vector's length only."""

    def run(batches):
        weights = np.uint64(1) << np.arange(KEY_BITS, dtype=np.uint64)[::-1]
        for batch in batches:
            vectors = batch.column(CARRIED.index("vector"))
            sizes = vectors.value_lengths().to_numpy()
            key = np.zeros(len(sizes), np.uint64)
            for size in np.unique(sizes).tolist():
                here = np.flatnonzero(sizes == size)
                planes = np.random.default_rng([SEED, number, size]).normal(size=(size, KEY_BITS))
                bits = unit_rows(vectors.take(pa.array(here))) @ planes > 0
                key[here] = np.where(bits, weights, np.uint64(0)).sum(axis=1, dtype=np.uint64)
            # With the highest bit flipped, signed order is the order of the bits.
            signed = pa.array((key ^ np.uint64(1 << 63)).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, signed], [*CARRIED, "key"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in CARRIED)
    return rows.select(*CARRIED).mapInArrow(run, f"{kinds}, key long")


def sorted_pass(rows: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """The stored rows of a pass, and the same with `place`, their position in the order of (team, key, class). Sorted
    by range; to the position in a range the numbers of rows of the ranges before it are added."""
    order = ["team", "key", "class"]
    at = F.monotonically_increasing_id()
    ranged = keyed(rows, number).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.select("*", F.shiftright(at, 33).alias("part"), at.bitwiseAND((1 << 33) - 1).alias("row")), "sorted-pass")
    before, starts = 0, []
    for part, n in sorted(map(tuple, ranged.groupBy("part").count().collect())):
        starts.append((part, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(starts, "part long, before long")
    placed = ranged.join(F.broadcast(offsets), "part")
    return ranged, placed.select(*CARRIED, "key", (F.col("before") + F.col("row")).alias("place"))


def agreement(cosine: float) -> float:
    """Chance that a random hyperplane has two vectors at the cosine on one side."""
    return 1 - math.acos(cosine) / math.pi


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of two arrays of keys."""
    differ = np.frexp((a ^ b).view(np.uint64).astype(np.float64))[1]
    return np.maximum(KEY_BITS - differ, 0)


class Group:
    """Rows of one block and team that lie together in the sorted input of a task."""

    def __init__(self, team: str):
        self.team, self.parts = team, []

    def add(self, batch: pa.RecordBatch) -> None:
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        numbers = [column(c).to_numpy(zero_copy_only=False) for c in ("class", "key", "place", "asks", "n")]
        met = [column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), -1) for c in ("places", "reaches")]
        self.parts.append([*numbers, *met, unit_rows(column("vector"))])

    def close(self) -> Group:
        self.ids, self.keys, self.places, self.asks, self.n, self.before, self.reaches, self.units = (np.concatenate(x) for x in zip(*self.parts))
        return self

    def new(self, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Which of the pairs no earlier pass has compared."""
        step = self.before[col] - self.before[row]
        reach = np.where(step > 0, self.reaches[row], self.reaches[col])
        return ~(np.abs(step) <= reach).any(axis=1)

    def result(self, row: np.ndarray, col: np.ndarray, still: np.ndarray, seen: int = 0, chance: float = 0.0) -> pa.RecordBatch:
        """The result rows of the new links (row, col): two counts and at most one edge for each row of the group."""
        counts = (np.bincount(row, self.n[col], len(self.ids)) + np.bincount(col, self.n[row], len(self.ids))).astype(np.int64)
        roots = forest(len(self.ids), row, col)
        counted, joined = np.flatnonzero(counts), np.flatnonzero(roots != np.arange(len(roots)))
        sizes = [len(counted), len(joined), len(still), 1]
        fill = lambda *x: pa.array(np.concatenate(x).astype(np.int64))
        columns = [
            pa.array(np.repeat(["count", "edge", "open", "seen"], sizes)),
            pa.array([None] * sum(sizes[:3]) + [self.team], pa.string()),
            fill(self.ids[counted], self.ids[joined], self.ids[still], [seen]),
            fill(counts[counted], self.ids[roots[joined]], np.zeros(sizes[2] + 1)),
            fill(np.zeros(sum(sizes[:2])), self.places[still], [0]),
            pa.array(np.append(np.zeros(sum(sizes[:3])), chance)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["kind", "team", "a", "b", "place", "chance"])


def forest(n: int, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component under the links."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[row], roots[col])
        smaller = roots.copy()
        np.minimum.at(smaller, row, low)
        np.minimum.at(smaller, col, low)
        smaller = smaller[smaller]
        if np.array_equal(smaller, roots):
            return roots
        roots = smaller


def grouped(batches: Iterator[pa.RecordBatch], compare: Callable[[Group], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`compare` of every run of equal (block, team); columns 0 and 1 of the batches."""
    known, group = None, None
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for first, last in zip(cuts, cuts[1:]):
            if last > first:
                if group is None or keys[first] != known:
                    if group is not None:
                        yield compare(group.close())
                    known, group = keys[first], Group(keys[first][1])
                group.add(batch.slice(first, last - first))
    if group is not None:
        yield compare(group.close())


DEALT = ["block", "team", "class", "key", "place", "asks", "n", "places", "reaches", "vector"]


def window_links(placed: DataFrame, cosine: float, window: int, block: int) -> DataFrame:
    """Each row against the next `window` of its team. 'open' are the rows for which the last quarter of the window still
    held a link; the chance of a 'seen' row is summed over its rows: that a pair at the cosine is within the window.

    The order is cut into blocks of `block` places; the first `window` rows of a block also follow the block before. So a
    task holds one block and one window of rows, whatever a team's size.
    """
    own = F.floor(F.col("place") / block)
    blocks = F.when(F.col("place") % block < window, F.array(own, own - 1)).otherwise(F.array(own))
    dealt = placed.select("*", F.explode(blocks).alias("block")).where("block >= 0").withColumn("asks", F.col("block") == own)
    dealt = dealt.repartition("block").sortWithinPartitions("block", "place")
    agree = agreement(cosine)

    def compare(group):
        n = int(group.asks.sum())
        rows, cols, still = [], [], np.zeros(n, bool)
        for at in range(0, n, window):
            row, col = np.nonzero(group.units[at : min(at + window, n)] @ group.units[at : at + 2 * window].T >= cosine)
            step = col - row
            row, col, step = (x[(step > 0) & (step <= window)] for x in (row, col, step))
            still[at + row[step > window - window // 4]] = True
            new = group.new(at + row, at + col)
            rows.append(at + row[new])
            cols.append(at + col[new])
        # A pair is sure to be within the window if it agrees on one bit more than the window's two ends do.
        end = np.arange(n) + window
        bits = np.where(end < len(group.keys), shared_bits(group.keys[:n], group.keys[np.minimum(end, len(group.keys) - 1)]) + 1, 0)
        chance = np.where(still, 1.0, agree ** np.minimum(bits, KEY_BITS))
        empty = np.zeros(0, np.int64)
        return group.result(np.concatenate([empty, *rows]), np.concatenate([empty, *cols]), np.flatnonzero(still), n, float(chance.sum()))

    return dealt.select(*DEALT).mapInArrow(lambda batches: grouped(batches, compare), RESULT)


def further_links(placed: DataFrame, still: DataFrame, cosine: float, window: int, reach: int) -> DataFrame:
    """As `window_links`, for the rows `still` (class, place) and what follows them by more than `reach` and at most twice
    that. Cells of one window of asking rows by one window of following rows are compared, each a small group."""
    cell = F.floor(F.col("place") / window)
    far = reach // window
    cells = stored(still.select(cell.alias("home")).distinct().select("home", F.explode(F.sequence(F.col("home") + far, F.col("home") + 2 * far)).alias("to")), "cells")
    rows = placed.withColumn("cell", cell)
    asking = rows.join(still.select("class"), "class", "left_semi").join(cells.withColumn("cell", F.col("home")), "cell").withColumn("asks", F.lit(True))
    following = rows.join(cells.withColumn("cell", F.col("to")), "cell").withColumn("asks", F.lit(False))
    both = asking.unionByName(following).withColumn("block", F.concat_ws("/", "home", "to"))

    def compare(group):
        mine, theirs = np.flatnonzero(group.asks), np.flatnonzero(~group.asks)
        row, col = np.nonzero(group.units[mine] @ group.units[theirs].T >= cosine)
        row, col = mine[row], theirs[col]
        step = group.places[col] - group.places[row]
        row, col, step = (x[(step > reach) & (step <= 2 * reach)] for x in (row, col, step))
        last = np.unique(row[step > 2 * reach - reach // 4])
        new = group.new(row, col)
        return group.result(row[new], col[new], last)

    dealt = both.select(*DEALT).repartition("block").sortWithinPartitions("block", "team")
    return dealt.mapInArrow(lambda batches: grouped(batches, compare), RESULT)


def one_pass(rows: DataFrame, number: int, cosine: float, window: int, block: int) -> tuple[list[DataFrame], DataFrame, float]:
    """The stored results of one pass; its (class, place, reach), how far each row was compared; and the chance that it
    meets a pair at the cosine, in the team where that is least. Rows in crowds, whose window ends among links, get
    windows that double until they don't."""
    ranged, placed = sorted_pass(rows, number)
    results, reach = [stored(window_links(placed, cosine, window, block), "window-links")], window
    teams = results[0].where("kind = 'seen'").groupBy("team").agg((F.sum("chance") / F.sum("a")).alias("chance"))
    chance = teams.agg(F.min("chance")).first()[0]
    still = results[0].where("kind = 'open'").select(F.col("a").alias("class"), "place").distinct()
    longer = []
    while not still.isEmpty():
        longer.append(still.select("class", F.lit(2 * reach).cast("long").alias("reach")))
        results.append(stored(further_links(placed, still, cosine, window, reach), "further-links"))
        still = results[-1].where("kind = 'open'").select(F.col("a").alias("class"), "place").distinct()
        reach *= 2
    met = placed.select("class", "place")
    if longer:
        most = reduce(DataFrame.unionByName, longer).groupBy("class").agg(F.max("reach").alias("reach"))
        met = met.join(most, "class", "left").fillna(window, ["reach"])
    else:
        met = met.withColumn("reach", F.lit(window).cast("long"))
    met = stored(met, "met")
    discard(ranged)
    return results, met, 1.0 if chance is None else chance


def near_links(rows: DataFrame, cosine: float = COSINE, window: int = WINDOW, block: int = BLOCK, most_passes: int = MOST_PASSES) -> tuple[DataFrame, DataFrame]:
    """Of `rows` (class, team, vector, n): (class, others), the rows that each linked class is linked to in other classes;
    and edges (a, b) that connect the linked classes. Each link counts once, in the first pass that meets it."""
    nothing = F.array().cast("array<long>")
    rows, results, missed, number = rows.withColumns({"places": nothing, "reaches": nothing}), [], 1.0, 0
    while True:
        found, met, chance = one_pass(rows, number, cosine, window, max(block, window))
        results += found
        missed *= 1 - chance
        number += 1
        if missed <= MISS or number >= most_passes:
            break
        added = rows.join(met.hint("merge"), "class").withColumns(
            {"places": F.concat("places", F.array("place")), "reaches": F.concat("reaches", F.array("reach"))}
        )
        rows = stored(added.select(*CARRIED), "pass-rows")
    every = reduce(DataFrame.unionByName, results)
    counts = every.where("kind = 'count'").groupBy(F.col("a").alias("class")).agg(F.sum("b").alias("others"))
    return counts, every.where("kind = 'edge'").select("a", "b")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, block: int = BLOCK, column: str = "embedding") -> DataFrame:
    """Per row of vectors: vec_id, n_links, component_id, kept.

    Rows are linked if their labels are equal and not null, their vectors are of one length, and a pass finds their cosine,
    in double precision, to be at least `cosine`; no pair below it is linked. Vectors that are null, empty, all zero or
    hold null or non-finite entries link with nothing. n_links counts the other rows that a row is linked to, copies
    included; component_id is the smallest vec_id that links reach, a null one only if all are null; kept says whether it
    is the row's own (a null vec_id is kept unless a link reaches another). Repeated rows come back as often as they are
    there, and so do ids that repeat with other vectors. No rows, no rows.

    Equal vectors are compared once, as one class. Passes go on until a pair at the threshold is missed with a chance of
    at most MISS in every team; small teams are within one window, so their only pass is exact.
    """
    rows = stored(distinct_vectors(vectors, column), "distinct-vectors")
    counts, edges = near_links(rows.select("class", "team", "vector", "n"), cosine, window, block)
    sizes = rows.select("class", "n", "least")
    roots = components(edges).withColumnRenamed("node", "class")
    rooted = stored(sizes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")), "vector-roots")
    firsts = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "vector-firsts")
    named = rooted.join(firsts.hint("merge"), "root").join(counts.hint("merge"), "class", "left")
    named = named.select("class", "component_id", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    told = stored(rows.select("class", "label", "vector").join(named.hint("merge"), "class").drop("class"), "told-vectors")
    plain = vectors.select("vec_id", "label", plain_vector(vectors, column).alias("vector"))
    linked = plain.where(F.col("vector").isNotNull()).join(told.hint("merge"), ["label", "vector"])
    alone = plain.where(F.col("vector").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
