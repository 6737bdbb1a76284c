"""Series stored in buckets: same rows as the lazy ones, joins without an exchange, a hot series in many buckets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sunledger.operators import balance, features, series
from sunledger.sources.bucketed import PERIOD, bucket_count, read_bucketed, stage_bucketed


def hours(spark, value, n=40_000, every=1):
    """Nine tenths of the rows belong to one asset; hours are missing, a year boundary lies between rows of all assets."""
    start = F.unix_seconds(F.lit("2015-06-01").cast("timestamp"))
    hot = F.when(F.col("id") % 10 == 0, F.concat(F.lit("a"), F.col("id") % 7)).otherwise(F.lit("hot"))
    rows = spark.range(0, n, every, 3).where("id % 13 <> 5").select(
        hot.alias("asset_id"), F.timestamp_seconds(start + F.col("id") * 3600).alias("ts_utc"), (F.col("id") * 0.5).alias(value)
    )
    return rows.withColumn("ts_local", F.col("ts_utc").cast("timestamp_ntz"))


def stored(spark, folder, name, df, buckets=8, **options):
    staged = stage_bucketed(df, f"{folder}/{name}", buckets, **options)
    staged.publish()
    return read_bucketed(spark, staged.path)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def same(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.select(*left.columns).collect()))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_balance_of_stored_sides_has_no_exchange(spark, tmp_path, no_broadcast):
    pv, load = hours(spark, "pv_power_kw"), hours(spark, "load_kw", every=2)
    lazy = balance.energy_balance(pv, load)
    joined = balance.energy_balance(stored(spark, tmp_path, "pv", pv), stored(spark, tmp_path, "load", load))
    assert "Exchange" not in plan_of(joined) and "Exchange" in plan_of(lazy)
    assert joined.count() > 10_000 and same(lazy, joined)


def test_lags_of_stored_sides_shuffle_seams_only(spark, tmp_path, no_broadcast):
    pv = hours(spark, "pv_power_kw")
    weather = hours(spark, "ghi_w_m2", every=3).select("*", *[F.lit(1.5).alias(c) for c in features.WEATHER[1:]])
    lazy = features.pv_features(pv, weather)
    ours = features.pv_features(stored(spark, tmp_path, "pv", pv), stored(spark, tmp_path, "weather", weather))
    assert same(lazy, ours)
    plan = plan_of(ours).partition("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    # Of each asset and year, at most the first and the last 168 rows go through that exchange.
    ranges = pv.select("asset_id", F.year("ts_utc")).distinct().count()
    seams = series.lag_rows(stored(spark, tmp_path, "again", pv), {"lag": ("pv_power_kw", 168)})
    moved = [int(n) for n in exchanged(seams)]
    assert len(moved) == 1 and 0 < moved[0] <= 2 * 168 * ranges < pv.count() / 2


def exchanged(df):
    """Rows written by each shuffle of the plan that ran."""
    df.collect()
    left, found = [df._jdf.queryExecution().executedPlan()], []
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            left.append(node.plan())
        elif name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def test_a_hot_series_is_spread_by_its_periods(spark, tmp_path):
    rows = hours(spark, "pv_power_kw")
    by_month = stored(spark, tmp_path, "pv", rows, buckets=16, unit="month")
    sizes = [r["count"] for r in by_month.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == rows.count() and max(sizes) < rows.count() / 4
    files = [p.name for p in (tmp_path / "pv").iterdir() if p.name.endswith(".parquet")]
    assert len(files) == len({name.rpartition("_")[2] for name in files}) <= 16
    lags = {"lag": ("pv_power_kw", 168)}
    assert same(series.lag_rows(rows, lags), series.lag_rows(by_month, lags))


def test_rows_without_a_key_an_instant_or_any_row(spark, tmp_path):
    schema = "asset_id STRING, ts_utc TIMESTAMP, `a b` STRING, pv_power_kw DOUBLE"
    rows = spark.sql(
        "SELECT * FROM VALUES (NULL, TIMESTAMP'2019-12-31 23:00:00', 'x', 1.0D), (NULL, TIMESTAMP'2020-01-01 00:00:00', NULL, 2.0D), "
        "('a', NULL, 'y', 3.0D), ('a', TIMESTAMP'2020-01-01 00:00:00', 'z', 4.0D), ('a', TIMESTAMP'2021-01-01 00:00:00', 'z', NULL) "
        "AS t(asset_id, ts_utc, `a b`, pv_power_kw)"
    )
    lags = {"lag": ("pv_power_kw", 1)}
    kept = stored(spark, tmp_path, "some", rows)
    assert same(rows, kept) and same(series.lag_rows(rows, lags), series.lag_rows(kept, lags))
    empty = stored(spark, tmp_path, "none", spark.createDataFrame([], schema))
    assert empty.count() == 0 and empty.columns == ["asset_id", "ts_utc", "a b", "pv_power_kw", PERIOD]


def test_a_table_is_replaced_and_names_are_taken_back(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    path = f"{tmp_path}/it's"
    for buckets, n in ((4, 100), (2, 50)):
        stage_bucketed(hours(spark, "load_kw", n=n), path, buckets).publish()
        again = read_bucketed(spark, path)
        assert again.count() == hours(spark, "load_kw", n=n).count()
        assert f"{buckets} out of {buckets}" in plan_of(again.groupBy("asset_id", PERIOD).count())
    assert {t.name for t in spark.catalog.listTables()} == before
    hours(spark, "load_kw", n=5).write.parquet(f"{tmp_path}/plain")
    with pytest.raises(ValueError, match="no buckets"):
        read_bucketed(spark, f"{tmp_path}/plain")


def test_bucket_counts_divide_each_other():
    assert [bucket_count(n, 10) for n in (0, 10, 11, 40, 41)] == [1, 1, 2, 4, 8]
