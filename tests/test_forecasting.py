"""Boosting that goes on, and trees as SQL."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from sunledger.operators import boosting, forecasting


@pytest.fixture(scope="module")
def split(spark):
    """Labelled rows with a smooth target, noise, gaps in a feature and a feature without values."""
    x = F.col("id") / 100.0
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    part = F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 < 9, "validation").otherwise("test")
    frame = spark.range(0, 1500, 1, 2).select(
        F.lit("a").alias("asset_id"),
        F.timestamp_seconds(F.col("id") * 3600).alias("ts_utc"),
        F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts_local"),
        (3 * F.sin(x) + F.col("id") % 7 + noise).alias("price_eur_mwh"),
        F.sin(x).alias("wave"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 7).alias("step"),
        (F.col("id") % 2 == 0).alias("even"),
        F.lit(None).cast("double").alias("nothing"),
        part.alias("split"),
    )
    return frame.cache()


def test_no_round_is_fitted_twice(split, monkeypatch):
    """Blocks of six rounds with four of patience: what is fitted is what was judged, once."""
    blocks, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: blocks.append(self.getMaxIter()) or fit(self, data))
    model = forecasting.train_price(split, "v", rounds=40, patience=4, depth=3, learning_rate=0.3)
    trees = model.model.stages[-1]
    assert set(blocks[:-1]) <= {6} and sum(blocks) <= 40
    assert trees.getNumTrees <= sum(blocks) < trees.getNumTrees + 4 + 6
    assert model.features == ["wave", "step", "even"]
    scored = forecasting.score_test_window(split, model)
    error, spread = scored.agg(F.avg(F.abs(F.col("y_pred") - F.col("price_eur_mwh"))), F.stddev("price_eur_mwh")).first()
    assert scored.count() == 150 and error < spread / 2


def test_blocks_go_on_where_the_one_before_ended(split, monkeypatch):
    """With patience for all rounds, several blocks are fitted and the model is better than their first."""
    one = forecasting.train_price(split, "v", rounds=3, patience=2, depth=2, learning_rate=0.3)
    errors, best = [], forecasting.best_round
    monkeypatch.setattr(forecasting, "best_round", lambda e, p: (errors.clear(), errors.extend(e), best(e, 100))[2])
    more = forecasting.train_price(split, "v", rounds=12, patience=2, depth=2, learning_rate=0.3)
    mae = lambda m: forecasting.score_test_window(split, m).agg(F.avg(F.abs(F.col("y_pred") - F.col("price_eur_mwh")))).first()[0]
    assert len(errors) == 12 and min(errors[3:]) < min(errors[:3]) and mae(more) < mae(one)


def test_compiled_trees_predict_alike(spark, split, tmp_path):
    trained = forecasting.train_price(split, "v", rounds=8, patience=3, depth=4)
    forecasting.save_bundle(trained, spark, str(tmp_path / "bundle"))
    loaded = forecasting.load_bundle(spark, str(tmp_path / "bundle"))
    sql = forecasting.compiled(loaded)
    predictions = lambda m: {r.ts_utc: r.y_pred for r in forecasting.score(split, m).collect()}
    want = predictions(trained)
    assert predictions(loaded) == want and predictions(sql) == pytest.approx(want, rel=1e-12)
    forecasting.save_bundle(sql, spark, str(tmp_path / "sql"))
    assert predictions(forecasting.load_bundle(spark, str(tmp_path / "sql"))) == pytest.approx(want, rel=1e-12)
    trees, fills = forecasting.trees_of(loaded)
    assert fills["step"] == pytest.approx(split.where("split = 'train'").agg(F.avg("step")).first()[0])
    split.select("ts_utc", "wave", F.col("step").cast("double").alias("step"), F.col("even").cast("double").alias("even")).write.parquet(str(tmp_path / "rows"))
    other = duckdb.sql(f"SELECT epoch_us(ts_utc), {forecasting.ensemble_sql(trees, fills)} FROM '{tmp_path}/rows/*.parquet'").fetchall()
    assert sorted(v for _, v in other) == pytest.approx(sorted(want.values()), rel=1e-12)


def test_declared_trees():
    trees = [(2.0, ("a", 1.5, 10.0, ("b", 0.0, 20.0, 30.0))), (0.5, 4.0)]
    assert forecasting.features_of(trees) == ["a", "b"]
    rows = duckdb.sql(f"SELECT {forecasting.ensemble_sql(trees, {'a': 2.0})} FROM (VALUES (1.5, 9.0), (2.0, 0.0), (NULL, 0.1)) AS t(a, b)").fetchall()
    assert [r[0] for r in rows] == [22.0, 42.0, 62.0]


def test_trees_are_fitted_on_few_partitions(spark, split, monkeypatch):
    """A split of many shuffle partitions is fitted on one partition per core: each level of a tree is a task per partition."""
    parts, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: parts.append(data.rdd.getNumPartitions()) or fit(self, data))
    forecasting.train_price(split.repartition(200), "v", rounds=2, patience=2, depth=2)
    assert parts and max(parts) <= spark.sparkContext.defaultParallelism
    assert forecasting.fit_partitions(spark, 10**7, 10**6) == max(10, spark.sparkContext.defaultParallelism)


def test_a_block_of_rounds_is_one_job(spark, split):
    """Rows that one task can hold grow all trees of a block together: jobs do not follow the trees, nor their levels."""
    context, jobs = spark.sparkContext, {}
    for rounds in (3, 12):
        context.setJobGroup(f"fit {rounds}", "")
        trained = forecasting.train_price(split, "v", rounds=rounds, patience=12, depth=4, learning_rate=0.3)
        jobs[rounds] = len(context.statusTracker().getJobIdsForGroup(f"fit {rounds}"))
        assert trained.model.stages[-1].trees
    context.setJobGroup("others", "")
    assert 0 < jobs[12] <= jobs[3] + 2 < 12 * 4


@pytest.mark.parametrize("rows_per_task", [10_000, 300])
def test_trees_are_those_of_spark_ml(spark, split, monkeypatch, rows_per_task):
    """With all rows and all features in every tree, in one task or level by level, stored again on the way."""
    monkeypatch.setattr(boosting, "STORED_EVERY", 2)
    monkeypatch.setattr(boosting, "SUMMED_BY_DRIVER", 2)
    options = {"rounds": 5, "patience": 20, "depth": 3, "learning_rate": 0.3, "row_sample": 1.0, "column_sample": 1.0}
    all_rows = split.withColumn("split", F.when(F.col("split") == "validation", "train").otherwise(F.col("split"))).repartition(4)
    ours = forecasting.train_price(all_rows, "v", rows_per_task=rows_per_task, **options)
    prepare, trees = PipelineModel(stages=ours.model.stages[:-1]), ours.model.stages[-1]
    doubles = [F.col(c).cast("double").alias(c) for c in ours.features]
    rows = prepare.transform(all_rows.where("split = 'train'").select(*doubles, F.col("price_eur_mwh").alias("label")))
    theirs = GBTRegressor(maxIter=5, maxDepth=3, stepSize=0.3, subsamplingRate=1.0, featureSubsetStrategy="all").fit(rows)
    assert trees.getNumTrees == theirs.getNumTrees == 5 and trees.treeWeights == theirs.treeWeights
    predicted = [[r.prediction for r in m.transform(rows.coalesce(1)).collect()] for m in (trees, theirs)]
    assert predicted[0] == pytest.approx(predicted[1], rel=1e-9)
    assert trees.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), rel=1e-6)
    ours_root, theirs_root = (m.trees[1]._java_obj.rootNode() for m in (trees, theirs))
    assert ours_root.impurity() == pytest.approx(theirs_root.impurity()) and ours_root.gain() == pytest.approx(theirs_root.gain())


def test_trees_by_level_stop_early_like_trees_of_one_task(split):
    """Blocks that go on over rows of several tasks: the same trees, as no rows are drawn."""
    options = {"rounds": 12, "patience": 2, "depth": 2, "learning_rate": 0.3, "row_sample": 1.0}
    here, spread = (forecasting.train_price(split, "v", rows_per_task=n, **options) for n in (10_000, 300))
    assert here.model.stages[-1].getNumTrees == spread.model.stages[-1].getNumTrees
    mae = lambda m: forecasting.score_test_window(split, m).agg(F.avg(F.abs(F.col("y_pred") - F.col("price_eur_mwh")))).first()[0]
    assert mae(here) == pytest.approx(mae(spread), rel=1e-9)
