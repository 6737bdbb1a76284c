"""Spark ML's boosted trees, fitted to binned rows: what `histograms` computes, run as Spark jobs.

Spark ML runs two stages for each level of each tree, over rows that are objects. Here rows are bins in blocks of bytes.
As many rows as one task should hold grow all their trees in one job; more rows take one job for each level of each tree,
from which only histograms reach the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from sunledger.operators import histograms
from sunledger.operators.histograms import BLOCK_ROWS, THRESHOLD_ROWS, Block, Growth, Tree
from sunledger.session import scratch_path

BLOCKS = "part INT, nth INT, codes BINARY, rest BINARY"
# Trees after which the rows that a chain of jobs keeps in memory are stored, which ends its lineage.
STORED_EVERY = 25
# Partitions whose histograms the driver adds up itself.
SUMMED_BY_DRIVER = 64
KEPT = StorageLevel.MEMORY_AND_DISK


@dataclass
class Boosted:
    """Fitted trees with their weights, and the training rows with what the trees leave over."""

    trees: list[Tree]
    weights: list[float]
    growth: Growth
    left: DataFrame


class HistogramRegressor(GBTRegressor):
    """Spark ML's regressor with its parameters, fitted to a frame of `binned` rows with `features` features. `local`: the
    rows are few enough for one task."""

    features = 0
    local = True

    def _fit(self, dataset: DataFrame) -> Boosted:
        rounds, seed = self.getMaxIter(), self.getSeed()
        growth = Growth(self.getMaxDepth(), self.getMaxBins(), self.features, self.getSubsamplingRate(), _drawn_features(self), seed)
        growths = [replace(growth, seed=seed + i) for i in range(rounds)]
        weights = [1.0] + [self.getStepSize()] * (rounds - 1)
        fit = _fit_here if self.local else _fit_by_level
        trees, left = fit(dataset, growths, weights)
        return Boosted(trees, weights, growth, left)


def _drawn_features(trees: GBTRegressor) -> int:
    """How many features a node may choose from: a number of them, or a share."""
    told = trees.getFeatureSubsetStrategy()
    if told in ("all", "auto"):
        return trees.features
    return min(int(told), trees.features) if told.isdigit() else math.ceil(float(told) * trees.features)


def cuts(rows: DataFrame, columns: Sequence[str], n_rows: int, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of each column, from as many rows as Spark ML takes them from."""
    least = max(bins * bins, THRESHOLD_ROWS)
    values = rows.select(*columns)
    taken = values if n_rows <= least else values.sample(least / n_rows, seed)
    table = np.array(taken.collect(), dtype=float).reshape(-1, len(columns))
    return [histograms.thresholds(column, bins) for column in table.T]


def binned(rows: DataFrame, columns: Sequence[str], label: str, thresholds: Sequence[np.ndarray], bins: int) -> DataFrame:
    """Blocks of rows with their bins and label; columns and label are doubles without nulls."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, nth = [], 0, 0
        for batch in batches:
            values = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            waiting.append((histograms.packed(values[1:], thresholds, bins), values[0]))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield _batch([_joined(waiting, nth)])
                waiting, n, nth = [], 0, nth + 1
        if n:
            yield _batch([_joined(waiting, nth)])

    return rows.select(F.col(label).cast("double"), *[F.col(c).cast("double") for c in columns]).mapInArrow(blocks, BLOCKS)


def _joined(parts: Sequence[tuple[np.ndarray, np.ndarray]], nth: int) -> Block:
    return Block((TaskContext.get().partitionId(), nth), np.concatenate([c for c, _ in parts], 1), np.concatenate([x for _, x in parts]))


def _batch(blocks: Sequence[Block], **others: list) -> pa.RecordBatch:
    columns = {
        "part": pa.array([b.place[0] for b in blocks], pa.int32()),
        "nth": pa.array([b.place[1] for b in blocks], pa.int32()),
        "codes": pa.array([b.codes.tobytes() for b in blocks], pa.binary()),
        "rest": pa.array([b.left.tobytes() for b in blocks], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns | others)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for part, nth, codes, rest in zip(*(batch.column(i) for i in range(4))):
            left = np.frombuffer(rest.as_buffer())
            yield Block((part.as_py(), nth.as_py()), np.frombuffer(codes.as_buffer(), np.uint16).reshape(-1, len(left)), left)


def _doubles(arrays: Iterable[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _fit_here(rows: DataFrame, growths: Sequence[Growth], weights: Sequence[float]) -> tuple[list[Tree], DataFrame]:
    """All trees in one job of one task."""
    shapes = "feature BINARY, bin BINARY, gain BINARY, stats BINARY"

    def grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted(_blocks(batches), key=lambda b: b.place)
        if not parts:
            return
        codes, left = np.concatenate([b.codes for b in parts], 1), np.concatenate([b.left for b in parts])
        starts = range(0, len(left), BLOCK_ROWS)
        blocks = [Block((0, i), np.ascontiguousarray(codes[:, at : at + BLOCK_ROWS]), left[at : at + BLOCK_ROWS]) for i, at in enumerate(starts)]
        trees = list(histograms.boosted(blocks, growths, weights))
        told = {name: _doubles(getattr(t, name) for t in trees) for name in ("feature", "bin", "gain", "stats")}
        none = pa.nulls(len(trees))
        empty = {"part": none.cast(pa.int32()), "nth": none.cast(pa.int32()), "codes": none.cast(pa.binary()), "rest": none.cast(pa.binary())}
        yield pa.RecordBatch.from_pydict(empty | told)
        for block in blocks:
            yield _batch([block], **{name: pa.nulls(1, pa.binary()) for name in told})

    both = rows.coalesce(1).mapInArrow(grown, f"{BLOCKS}, {shapes}").persist(KEPT)
    found = both.where("part IS NULL").select("feature", "bin", "gain", "stats").collect()
    ints = [[np.frombuffer(x, np.int64) for x in row[:2]] for row in found]
    trees = [Tree(f, b, np.frombuffer(row.gain), np.frombuffer(row.stats).reshape(-1, 3)) for (f, b), row in zip(ints, found)]
    left = both.where("part IS NOT NULL").select("part", "nth", "codes", "rest")
    left.kept = [both]
    return trees, left


def _fit_by_level(rows: DataFrame, growths: Sequence[Growth], weights: Sequence[float]) -> tuple[list[Tree], DataFrame]:
    """One job for each level of each tree. A tree's first job also takes the tree before off what is left."""
    spark, shape = rows.sparkSession, f"{BLOCKS}, squares BINARY"
    n, size = rows.rdd.getNumPartitions(), 1 << growths[0].depth
    blocks, trees, kept, spent, stored = rows, [], [], [], []
    for round_, (growth, weight) in enumerate(zip(growths, weights)):

        def gathered(tree: Tree, level: int, wanted: list[int]) -> np.ndarray:
            counted = _level_of(tree, level, wanted, growth, round_)
            found, squares = _summed(blocks, counted, n, (2 * len(wanted) * growth.features * growth.bins, size))
            if level == 0 and "squares" in blocks.columns:
                trees[-1].settle(squares)
                _let_go(spent)  # this job has filled what follows
            return found.reshape(2, len(wanted), growth.features, growth.bins)

        tree = histograms.grow(growth, gathered)
        trees.append(tree)
        _let_go(spent)
        spent, blocks = kept, blocks.mapInArrow(_taken_off(tree, growth, weight, round_), shape).persist(KEPT)
        kept = [blocks]
        if (round_ + 1) % STORED_EVERY == 0 or round_ + 1 == len(growths):
            path = scratch_path(spark, "boosted-rows")
            _delete(spark, path, on_exit=True)
            blocks.write.parquet(path)
            _let_go([*spent, *kept])
            written = spark.read.schema(shape).parquet(path)
            tree.settle(np.sum([np.frombuffer(r.squares) for r in written.select("squares").collect()], axis=0))
            for old in stored:
                _delete(spark, old)
            blocks = written.select("part", "nth", "codes", "rest").persist(KEPT)
            stored, spent, kept = [path], [], [blocks]
    blocks.kept, blocks.stored = kept, stored
    return trees, blocks


def _let_go(frames: Sequence[DataFrame]) -> None:
    for frame in frames:
        frame.unpersist()


def let_go(left: DataFrame) -> None:
    """Frees what `Boosted.left` holds in memory and on disk."""
    _let_go(getattr(left, "kept", []))
    for path in getattr(left, "stored", []):
        _delete(left.sparkSession, path)


def _delete(spark: SparkSession, path: str, on_exit: bool = False) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(folder) if on_exit else files.delete(folder, True)


def _level_of(tree: Tree, level: int, wanted: list[int], growth: Growth, round_: int) -> Callable:
    """A task's histogram for some nodes of a level, and its sum of squares by leaf of the tree before."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = 0, 0
        for batch in batches:
            if "squares" in batch.schema.names:
                squares = squares + np.sum([np.frombuffer(x.as_buffer()) for x in batch.column("squares")], axis=0)
            for block in _blocks([batch]):
                rows, label = histograms.seen(block, growth, round_)
                codes = block.codes if rows is None else block.codes.take(rows, 1)
                at = histograms.placed(codes, tree, growth, level)
                total = total + histograms.histogram(codes, label, at, level, wanted, growth)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_pydict({"found": _doubles([total]), "squares": _doubles([squares if np.ndim(squares) else np.zeros(0)])})

    return counted


def _summed(blocks: DataFrame, counted: Callable, n: int, sizes: tuple[int, int]) -> list[np.ndarray]:
    """Sums of the arrays that `n` tasks come to; those of very many tasks are added up in tasks first."""

    def total(pairs: Iterable[tuple[bytes, bytes]]) -> list[np.ndarray]:
        sums = [np.zeros(n) for n in sizes]
        for pair in pairs:
            for k, told in enumerate(pair):
                if told:
                    sums[k] += np.frombuffer(told)
        return sums

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = total((found.as_py(), squares.as_py()) for batch in batches for found, squares in zip(batch.column(0), batch.column(1)))
        yield pa.RecordBatch.from_pydict({name: _doubles([x]) for name, x in zip(("found", "squares"), sums)})

    found = blocks.mapInArrow(counted, "found BINARY, squares BINARY")
    if n > SUMMED_BY_DRIVER:
        found = found.repartition(math.isqrt(n)).mapInArrow(added, "found BINARY, squares BINARY")
    return total(found.collect())


def _taken_off(tree: Tree, growth: Growth, weight: float, round_: int) -> Callable:
    def explained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            squares = histograms.explain(block, tree, growth, weight, round_)
            yield _batch([block], squares=_doubles([squares]))

    return explained


def judged(rows: DataFrame, fitted: Boosted) -> tuple[list[float], DataFrame]:
    """The mean absolute error on binned rows after each tree, and the rows with what the trees leave over."""
    trees, weights, growth = fitted.trees, fitted.weights, fitted.growth

    def errors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            wrong = histograms.judged(block, trees, growth, weights)
            yield _batch([block], wrong=pa.array([wrong.tolist()], pa.list_(pa.float64())), n=pa.array([len(block.left)], pa.int64()))

    done = rows.mapInArrow(errors, f"{BLOCKS}, wrong ARRAY<DOUBLE>, n BIGINT").persist(KEPT)
    told = done.select("wrong", "n").collect()
    left = done.select("part", "nth", "codes", "rest")
    left.kept = [done]
    return (np.sum([r.wrong for r in told], axis=0) / sum(r.n for r in told)).tolist(), left


def model(spark: SparkSession, trees: Sequence[Tree], weights: Sequence[float], thresholds: Sequence[np.ndarray]) -> GBTRegressionModel:
    """Spark ML's model of grown trees. A tree's nodes reach the JVM at once, as the records that Spark ML stores them as."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    ml, stored = jvm.org.apache.spark.ml, "org.apache.spark.ml.tree.DecisionTreeModelReadWrite"
    mapper = jvm.com.fasterxml.jackson.databind.ObjectMapper()
    mapper.registerModule(jvm.com.fasterxml.jackson.module.scala.DefaultScalaModule())
    records, built, of = jvm.java.lang.Class.forName(f"[L{stored}$NodeData;"), getattr(ml.tree, stored.rpartition(".")[2]), ml.regression.DecisionTreeRegressionModel
    made, weights_ = gateway.new_array(of, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        nodes = mapper.readValue(json.dumps(_nodes(tree, thresholds)), records)
        made[i] = of(f"tree_{i}", built.buildTreeFromNodes(nodes, "variance"), len(thresholds))
        weights_[i] = float(weight)
    return GBTRegressionModel(ml.regression.GBTRegressionModel(f"boosted_{len(trees)}", made, weights_, len(thresholds)))


def _nodes(tree: Tree, thresholds: Sequence[np.ndarray]) -> list[dict]:
    """The nodes that rows can reach, numbered from the root on."""
    inner = len(tree.feature)
    splits = lambda k: k < inner and tree.gain[k] >= 0
    reached = [0]
    for k in reached:
        reached += [2 * k + 1, 2 * k + 2] if splits(k) else []
    number = {k: i for i, k in enumerate(reached)}
    nodes = []
    for i, k in enumerate(reached):
        n, total, squares = tree.stats[k].tolist()
        mean = total / max(n, 1.0)
        node = {"id": i, "prediction": mean, "impurity": max(squares / max(n, 1.0) - mean * mean, 0.0), "impurityStats": [n, total, squares], "rawCount": int(n)}
        if splits(k):
            feature = int(tree.feature[k])
            split = {"featureIndex": feature, "leftCategoriesOrThreshold": [float(thresholds[feature][tree.bin[k]])], "numCategories": -1}
            node |= {"gain": float(tree.gain[k]), "leftChild": number[2 * k + 1], "rightChild": number[2 * k + 2], "split": split}
        else:
            node |= {"gain": -1.0, "leftChild": -1, "rightChild": -1, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        nodes.append(node)
    return nodes
