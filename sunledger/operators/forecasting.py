"""Chronological split, boosted-tree training, acceptance gates, model bundles and scoring."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, ImputerModel, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from sunledger.functions.scalars import at_least_zero
from sunledger.operators import boosting
from sunledger.operators.boosting import HistogramRegressor
from sunledger.operators.features import feature_columns
from sunledger.settings import (
    BOOST_ROUNDS,
    COLUMN_SAMPLE,
    EARLY_STOP_ROUNDS,
    FIT_ROWS_PER_PARTITION,
    LEARNING_RATE,
    PRICE_GATE_FACTOR,
    ROW_SAMPLE,
    SEED,
    TEST_MONTHS,
    TRAIN_MONTHS,
    TREE_DEPTH,
    VALIDATION_MONTHS,
)

BUNDLE_SCHEMA = "target STRING, model_version STRING, nonnegative BOOLEAN, features ARRAY<STRING>"


def chronological_split(
    rows: DataFrame,
    train_months: int = TRAIN_MONTHS,
    validation_months: int = VALIDATION_MONTHS,
    test_months: int = TEST_MONTHS,
    ts: str = "ts_utc",
    by: Sequence[str] = (),
) -> DataFrame:
    """Label rows 'train', 'validation' or 'test' by calendar month from the first month on; later rows go.

    The first month is that of all rows, as a scalar subquery: one lazy plan without a join. With `by`, each series (say, an
    asset) counts from its own first month, so a site that joins late has rows to train on; the first months have one
    row for each series, which adaptive execution broadcasts when they are few. Either way the last month that counts bounds
    `ts`, and the partition column `year` where there is one.
    """
    ends = (train_months, train_months + validation_months, train_months + validation_months + test_months)
    month = F.date_trunc("month", F.min(ts))
    if by:
        key = F.struct(*by)
        origins = rows.groupBy(key.alias("_k")).agg(month.alias("_first"))
        latest, first = origins.select(F.max("_first")).scalar(), F.col("_first")
    else:
        latest = first = rows.select(month).scalar()
    stop = F.add_months(latest, ends[2])
    kept = rows.where(F.col(ts) < stop.cast("timestamp"))
    if "year" in rows.columns:
        kept = kept.where(F.col("year") <= F.year(stop))
    if by:
        kept = kept.withColumn("_k", key).join(origins, "_k")
    before = lambda months: F.col(ts) < F.add_months(first, months).cast("timestamp")
    label = F.when(before(ends[0]), "train").when(before(ends[1]), "validation").otherwise("test")
    return kept.where(before(ends[2])).select(*rows.columns, label.alias("split"))


@dataclass
class Forecaster:
    """A fitted model with what is needed to use it again."""

    model: PipelineModel
    features: list[str]
    target: str
    version: str
    nonnegative: bool = False


def _inputs(rows: DataFrame, features: Sequence[str], *others: str) -> DataFrame:
    return rows.select(*others, *[F.col(c).cast("double").alias(c) for c in features])


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the lowest error seen before `patience` rounds in a row bring no gain, and whether such a
    stall was reached."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def _boost(
    trees: HistogramRegressor, training: DataFrame, validation: DataFrame | None, rounds: int, patience: int
) -> tuple[list, list[float]]:
    """Boosted trees and their weights, with early stopping on the validation MAE; no round is fitted twice.

    Boosting goes on in blocks: a block is fitted to what the blocks before it leave over, which is kept next to the
    features, until the error has stalled for `patience` rounds. The trees of all blocks, cut after the best round, are the
    model. Each block's first tree has full weight, as in any boosting run. One error per round comes back to the driver.
    Without validation rows, all rounds are one block.
    """
    block = min(rounds, patience + patience // 2) if validation is not None else rounds
    grown, weights, errors, kept = [], [], [], []
    left, checked = training, validation
    try:
        while True:
            size = min(block, rounds - len(grown))
            fitted = trees.copy({trees.maxIter: size, trees.seed: trees.getSeed() + len(grown)}).fit(left)
            kept.append(fitted.left)
            grown += fitted.trees
            weights += fitted.weights
            if validation is None:
                return grown, weights
            more, checked = boosting.judged(checked, fitted)
            kept.append(checked)
            errors += more
            best, stalled = best_round(errors, patience)
            if stalled or len(grown) >= rounds:
                return grown[:best], weights[:best]
            left = fitted.left
    finally:
        for part in kept:
            boosting.let_go(part)


# A tree is the value of a leaf, or (feature, threshold, tree where the feature is at most the threshold, other tree).
Tree = float | tuple[str, float, "Tree", "Tree"]


def tree_sql(tree: Tree, fills: Mapping[str, float]) -> str:
    """The tree as a SQL CASE expression that Spark and other engines read alike; `fills` replace missing features."""
    if not isinstance(tree, tuple):
        return f"CAST({float(tree)!r} AS DOUBLE)"
    feature, threshold, low, high = tree
    value = f"coalesce({feature}, CAST({float(fills.get(feature, 0.0))!r} AS DOUBLE))"
    return f"CASE WHEN {value} <= CAST({float(threshold)!r} AS DOUBLE) THEN {tree_sql(low, fills)} ELSE {tree_sql(high, fills)} END"


def ensemble_sql(trees: Sequence[tuple[float, Tree]], fills: Mapping[str, float] | None = None) -> str:
    """The weighted sum of (weight, tree), in their order."""
    return " + ".join(f"CAST({float(w)!r} AS DOUBLE) * {tree_sql(tree, fills or {})}" for w, tree in trees)


def features_of(trees: Sequence[tuple[float, Tree]]) -> list[str]:
    """The features that trees ask for, in order of appearance."""

    def walk(tree):
        if isinstance(tree, tuple):
            yield tree[0]
            yield from walk(tree[2])
            yield from walk(tree[3])

    return list(dict.fromkeys(name for _, tree in trees for name in walk(tree)))


def declared_forecaster(
    trees: Sequence[tuple[float, Tree]], target: str, version: str, nonnegative: bool = False, fills: Mapping[str, float] | None = None
) -> Forecaster:
    """A forecaster of declared trees. It is a Spark ML pipeline like a trained one, so it is scored and saved alike; its one
    stage is SQL, which scoring compiles with the rest of the plan."""
    statement = SQLTransformer(statement=f"SELECT *, {ensemble_sql(trees, fills)} AS prediction FROM __THIS__")
    return Forecaster(PipelineModel(stages=[statement]), features_of(trees), target, version, nonnegative)


def trees_of(forecaster: Forecaster) -> tuple[list[tuple[float, Tree]], dict[str, float]]:
    """A trained forecaster's weighted trees, and the training means that fill its missing features."""
    model = forecaster.model.stages[-1]
    imputer = next(s for s in forecaster.model.stages if isinstance(s, ImputerModel))
    means = imputer.surrogateDF.first().asDict()
    parsed = [_parsed_tree(tree.toDebugString, forecaster.features) for tree in model.trees]
    return list(zip(model.treeWeights, parsed)), {name: float(means[name]) for name in forecaster.features}


def _parsed_tree(text: str, features: Sequence[str]) -> Tree:
    """A tree from Spark ML's description of it: a line for each split's two sides and for each leaf, a side's subtree
    below its line."""
    lines = iter([line.strip() for line in text.splitlines()[1:] if line.strip()])

    def read() -> Tree:
        line = next(lines)
        if line.startswith("Predict:"):
            return float(line.split(":")[1])
        feature, threshold = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = read()
        next(lines)  # Else
        return features[int(feature)], float(threshold), low, read()

    return read()


def compiled(forecaster: Forecaster) -> Forecaster:
    """A trained forecaster as SQL: the same predictions but for the last bits of a sum. For small ensembles; every tree is a
    part of one expression."""
    trees, fills = trees_of(forecaster)
    sql = declared_forecaster(trees, forecaster.target, forecaster.version, forecaster.nonnegative, fills)
    return replace(sql, features=forecaster.features)


def fit_partitions(spark: SparkSession, rows: int, rows_per_partition: int = FIT_ROWS_PER_PARTITION) -> int:
    """Partitions of the frame that trees are fitted on: every level of every tree is a job over all of them, so the
    shuffle's many small partitions would each be a task; as many as the cluster has cores, or more as rows grow."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_partition), 1)


def train_forecaster(
    split: DataFrame,
    target: str,
    version: str | None = None,
    nonnegative: bool = False,
    rounds: int = BOOST_ROUNDS,
    depth: int = TREE_DEPTH,
    learning_rate: float = LEARNING_RATE,
    row_sample: float = ROW_SAMPLE,
    column_sample: float = COLUMN_SAMPLE,
    seed: int = SEED,
    patience: int = EARLY_STOP_ROUNDS,
    rows_per_task: int = FIT_ROWS_PER_PARTITION,
) -> Forecaster:
    """Boosted trees on the 'train' rows of a labelled frame, stopped early on the 'validation' rows.

    Missing features are filled with training means; a feature that no training row has is left out of the model. The split
    is best a stored table, as several passes prepare the fit. The fit itself holds bins of the features: up to
    `rows_per_task` training rows in one task that grows the trees of a block of rounds, more rows spread over the cluster
    (see `boosting`).
    """
    columns = feature_columns(split, target)
    usable = split.where(F.col("split").isin("train", "validation")).dropna(subset=[target])
    trees = HistogramRegressor(
        maxIter=rounds,
        maxDepth=depth,
        stepSize=learning_rate,
        subsamplingRate=row_sample,
        featureSubsetStrategy=str(column_sample),
        lossType="squared",
        seed=seed,
    )
    in_part = lambda rows, part: rows.where(F.col("split") == part)
    held = []
    try:
        seen = in_part(usable, "train").agg(*[F.count(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_rows")).first()
        features = [c for c in columns if seen[c]]
        filled = [f"{c}_filled" for c in features]
        rows = _inputs(usable, features, "split", target)
        prepare = Pipeline(
            stages=[
                Imputer(inputCols=features, outputCols=filled),
                VectorAssembler(inputCols=filled, outputCol="features"),
            ]
        ).fit(in_part(rows, "train"))
        ready = prepare.stages[0].transform(rows)
        cuts = boosting.cuts(in_part(ready, "train"), filled, seen["_rows"], trees.getMaxBins(), seed)
        ready = ready.coalesce(fit_partitions(split.sparkSession, seen["_rows"], rows_per_task))
        for part in ("train", "validation"):
            binned = boosting.binned(in_part(ready, part), filled, target, cuts, trees.getMaxBins())
            held.append(binned.persist(StorageLevel.MEMORY_AND_DISK))
        training, validation = held
        trees.features, trees.local = len(features), seen["_rows"] <= rows_per_task
        grown, weights = _boost(trees, training, None if validation.isEmpty() else validation, rounds, patience)
    finally:
        for part in held:
            part.unpersist()
    fitted = boosting.model(split.sparkSession, grown, weights, cuts)
    model = PipelineModel(stages=[*prepare.stages, fitted])
    return Forecaster(model, features, target, version or f"gbt_v1_{date.today()}", nonnegative)


def train_price(split: DataFrame, version: str | None = None, **options) -> Forecaster:
    return train_forecaster(split, "price_eur_mwh", version, **options)


def train_pv(split: DataFrame, version: str | None = None, **options) -> Forecaster:
    """PV forecasts are floored at zero."""
    return train_forecaster(split, "pv_power_kw", version, nonnegative=True, **options)


def score(rows: DataFrame, forecaster: Forecaster) -> DataFrame:
    """Feature rows with `y_pred`; the model is applied inside the tasks, row by row of the frame."""
    kept = [c for c in rows.columns if c not in forecaster.features]
    named = {c: f"_in_{c}" for c in forecaster.features}
    carried = rows.select("*", *[F.col(c).alias(n) for c, n in named.items()])
    scored = forecaster.model.transform(_inputs(carried, forecaster.features, *kept, *named.values()))
    prediction: Column = F.col("prediction")
    if forecaster.nonnegative:
        prediction = at_least_zero(prediction)
    return scored.select(
        *kept, *[F.col(n).alias(c) for c, n in named.items()], prediction.alias("y_pred")
    )


def score_test_window(split: DataFrame, forecaster: Forecaster) -> DataFrame:
    """Predictions for the 'test' rows only: the model has not seen them."""
    return score(split.where(F.col("split") == "test"), forecaster)


def forecast_rows(scored: DataFrame, target: str, version: str | Column) -> DataFrame:
    """Long forecast rows of one target."""
    label = version if isinstance(version, Column) else F.lit(version)
    return scored.select(
        "asset_id",
        "ts_utc",
        "ts_local",
        F.lit(target).alias("target"),
        F.col("y_pred").cast("double").alias("y_pred"),
        F.col(target).cast("double").alias("y_true"),
        label.alias("model_version"),
    )


def stack_forecasts(*parts: DataFrame) -> DataFrame:
    """One long table of all targets."""
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def acceptance_gate(
    rows: DataFrame,
    target: str,
    baseline: str,
    factor: float = 1.0,
    strict: bool = False,
    predicted: str = "y_pred",
) -> DataFrame:
    """One row: model MAE, baseline MAE, limit, and whether the model may be kept."""
    errors = rows.agg(
        F.avg(F.abs(F.col(target) - F.col(predicted))).alias("model_mae"),
        F.avg(F.abs(F.col(target) - F.col(baseline))).alias("baseline_mae"),
    ).withColumn("limit_mae", F.col("baseline_mae") * F.lit(float(factor)))
    within = F.col("model_mae") < F.col("limit_mae") if strict else F.col("model_mae") <= F.col("limit_mae")
    return errors.withColumn("accepted", within)


def price_gate(scored: DataFrame) -> DataFrame:
    """At least 15 % better than last week's price."""
    return acceptance_gate(scored, "price_eur_mwh", "price_lag_168h", PRICE_GATE_FACTOR)


def pv_gate(scored: DataFrame) -> DataFrame:
    """Better than yesterday's output."""
    return acceptance_gate(scored, "pv_power_kw", "pv_lag_24h", strict=True)


def save_bundle(forecaster: Forecaster, spark: SparkSession, path: str) -> None:
    """Model, feature list, target and version under one path."""
    forecaster.model.write().overwrite().save(f"{path}/model")
    described = spark.createDataFrame(
        [(forecaster.target, forecaster.version, forecaster.nonnegative, forecaster.features)],
        BUNDLE_SCHEMA,
    )
    described.coalesce(1).write.mode("overwrite").json(f"{path}/about")


def save_if_accepted(forecaster: Forecaster, gate: DataFrame, spark: SparkSession, path: str) -> bool:
    """Save the bundle only when the one-row gate says so."""
    accepted = bool(gate.select("accepted").first()[0])
    if accepted:
        save_bundle(forecaster, spark, path)
    return accepted


def load_bundle(spark: SparkSession, path: str) -> Forecaster:
    about = spark.read.schema(BUNDLE_SCHEMA).json(f"{path}/about").first()
    return Forecaster(
        PipelineModel.load(f"{path}/model"), list(about.features), about.target, about.model_version, about.nonnegative
    )
