from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sunledger.operators import medians as medians_
from sunledger.operators import series
from sunledger.operators.medians import agg_with_median, selected_median
from sunledger.operators.sizing import join_dimension

HOUR = 3600


def hours(spark, stamps, value=lambda h: float(h), asset="a"):
    rows = [(asset, h * HOUR, value(h)) for h in stamps]
    return spark.createDataFrame(rows, "asset_id STRING, s LONG, v DOUBLE").select(
        "asset_id", F.timestamp_seconds("s").alias("ts_utc"), "v"
    )


def by_key(df, *columns):
    return {(r.asset_id, r.ts_utc): tuple(r[c] for c in columns) for r in df.collect()}


def test_row_lag_and_time_lag_differ_after_a_gap(spark):
    df = hours(spark, [h for h in range(200) if h != 100])
    rows = by_key(series.lag_features(df, "v", "v", lags=(1, 24)), "v", "v_lag_1h", "v_lag_24h")
    times = by_key(series.lag_by_time(df, "v", "v", lags=(1, 24)), "v", "v_lag_1h", "v_lag_24h")
    row_at = {v[0]: v for v in rows.values()}
    time_at = {v[0]: v for v in times.values()}
    assert row_at[50.0] == time_at[50.0] == (50.0, 49.0, 26.0)
    assert row_at[101.0] == (101.0, 99.0, 76.0)
    assert time_at[101.0] == (101.0, None, 77.0)
    assert row_at[0.0] == (0.0, None, None)


def window_lags(df, lags):
    """The plain window over whole series."""
    window = Window.partitionBy("asset_id").orderBy("ts_utc")
    return df.withColumns({name: F.lag(c, n).over(window) for name, (c, n) in lags.items()})


@pytest.mark.parametrize("rows_per_task", [33, 40, 200, 5_000])
def test_lags_across_ranges_equal_the_window(spark, rows_per_task):
    """Dense and very sparse stretches, bursts, several assets and one without a name, null values, ranges shorter than the lag."""
    random.seed(3)
    parts = []
    for asset in ("a", "b", None):
        stamps = sorted(random.sample(range(3000), 400) + list(range(5000, 5400)) + [9000, 20_000])
        parts.append(hours(spark, stamps, lambda h: None if h % 17 == 0 else float(h), asset))
    bursts = spark.range(2000).select(
        F.lit("d").alias("asset_id"), F.timestamp_micros(F.col("id") + F.when(F.col("id") > 900, 10**12).otherwise(0)).alias("ts_utc"), F.col("id").cast("double").alias("v")
    )
    df = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(bursts)
    lags = {"l1": ("v", 1), "l24": ("v", 24), "l168": ("v", 168)}
    ranged = series.lag_rows(df, lags, rows_per_task=rows_per_task)
    assert ranged.columns == [*df.columns, *lags] and ranged.count() == df.count()
    assert by_key(ranged, "v", *lags) == by_key(window_lags(df, lags), "v", *lags)


def test_a_hot_series_gives_even_tasks(spark):
    """One series holds nine tenths of the rows: it is cut into even ranges, the small ones are not, and each range is a
    partition of its own before the window."""
    hot = hours(spark, range(45_000), asset="hot")
    small = spark.range(5_000).select(
        F.concat(F.lit("s"), (F.col("id") % 50).cast("string")).alias("asset_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts_utc"), F.col("id").cast("double").alias("v")
    )
    df = hot.unionByName(small)
    cuts = series.range_cuts(df, ["asset_id"], "ts_utc", rows_per_task=2_000)
    assert [r._k.asset_id for r in cuts.collect()] == ["hot"]
    sizes = series.in_ranges(df, cuts).groupBy("asset_id", "_range").count().collect()
    ranges = [r["count"] for r in sizes if r.asset_id == "hot"]
    assert len(ranges) >= 18 and max(ranges) <= 2 * 45_000 / len(ranges) and max(r["count"] for r in sizes) <= 4_500
    lags = {"l24": ("v", 24)}
    assert by_key(series.lag_rows(df, lags, rows_per_task=2_000), "v", "l24") == by_key(window_lags(df, lags), "v", "l24")


def test_uncut_series_run_one_window(spark, tmp_path):
    """Where no series is long, adaptive execution leaves one window and no union."""
    hours(spark, range(500)).write.parquet(str(tmp_path / "s"))
    lagged = series.lag_features(spark.read.parquet(str(tmp_path / "s")), "v", "v")
    lagged.collect()
    final = lagged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bWindow \[", final)) == 1 and "Union" not in final


def test_rows_of_one_instant_have_one_order(spark):
    rows = [("a", h // 3 * HOUR, float(h * 7 % 11)) for h in range(300)]
    df = spark.createDataFrame(rows, "asset_id STRING, s LONG, v DOUBLE").select("asset_id", F.timestamp_seconds("s").alias("ts_utc"), "v")
    shown = lambda n, r: sorted(map(repr, series.lag_features(df.repartition(n), "v", "v", rows_per_task=r).collect()))
    assert shown(1, 10_000) == shown(7, 10_000) == shown(3, 50)


def test_operators_run_no_job_while_a_frame_is_built(spark):
    from sunledger.plans.bindings import Bindings
    from sunledger.plans.queries import features, rollups, shaping  # noqa: F401
    from sunledger.plans.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    Bindings(spark, folder).table("lineitem").schema  # warm
    names = (
        "lag_features price_features pv_features baseline_frame hourly_shape_median series_summary_fleet kpi_monthly_fleet "
        "battery_monthly filter_target mae_by_hour"
    ).split()
    spark.sparkContext.setJobGroup("built", "frames")
    try:
        frames = [QUERIES[n](spark, folder) for n in names]
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("built")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Reading the footers of its tables is the only job a lazy frame may start; five tables at most.
    assert len(frames) == len(names) and len(jobs) <= 3 * len(names)


def test_baseline_frame_drops_warm_up(spark):
    df = hours(spark, range(336))
    frame = series.baseline_frame(df, "v")
    assert frame.count() == 168
    row = frame.orderBy("ts_utc").first()
    assert (row.y_true, row.y_pred_persistence, row.y_pred_seasonal_naive) == (168.0, 144.0, 0.0)


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_ordering_check_counts_steps_back(spark, chunk):
    stamps = [0, 1, 2, 1, 3, 3, 2, 9, 8, 7, 10, 11]
    rows = [("a", i, s) for i, s in enumerate(stamps)]
    df = spark.createDataFrame(rows, "asset_id STRING, seq LONG, s LONG").withColumn("ts_utc", F.timestamp_seconds("s"))
    got = series.ordering_check(df, "seq", chunk=chunk).first()
    assert (got.n_rows, got.n_backward) == (12, 4)


def test_missing_hours_across_months(spark):
    df = hours(spark, [h for h in range(24 * 70) if h not in (5, 800, 801)])
    got = sorted(r[0] for r in series.missing_hours(df).select(F.unix_seconds("ts_utc") / HOUR).collect())
    assert got == [5, 800, 801]
    edges = series.missing_hours(df.where(F.unix_seconds("ts_utc") >= 3 * HOUR), window=("1970-01-01", "1970-01-02"))
    assert sorted(r[0] for r in edges.select(F.unix_seconds("ts_utc") / HOUR).collect()) == [0, 1, 2, 5]


@pytest.mark.parametrize("window", [None, ("1970-01-05", "1970-04-11")])
def test_missing_hours_are_those_of_the_full_grid(spark, window):
    """Several series, repeated and unaligned rows, gaps of months, one series outside the window, one without a name."""
    rng = random.Random(8)
    stamps = {"a": rng.sample(range(3000), 900), "b": [5, 6, 2500, 2500], "c": [9000], None: rng.sample(range(200, 260), 20), "d": [None, 7]}
    rows = [(a, None if h is None else h * HOUR + rng.choice([0, 59])) for a, hs in stamps.items() for h in hs]
    df = spark.createDataFrame(rows, "asset_id STRING, s LONG").select("asset_id", F.timestamp_seconds("s").alias("ts_utc"))
    got = series.missing_hours(df, window=window).select("asset_id", (F.unix_seconds("ts_utc") / HOUR).cast("int")).collect()
    want = []
    for a, hs in stamps.items():
        known = [h for h in hs if h is not None]
        grid = range(min(known), max(known)) if window is None else range(4 * 24, 100 * 24)
        want += [(a, h) for h in grid if h not in known]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_missing_hours_make_no_grid(spark, tmp_path):
    """A series with one gap makes the hours of that gap, and nothing is joined."""
    hours(spark, [h for h in range(20_000) if not 500 <= h < 507]).write.parquet(str(tmp_path / "s"))
    missing = series.missing_hours(spark.read.parquet(str(tmp_path / "s")))
    assert len(missing.collect()) == 7
    final = missing._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in final and len(re.findall("Exchange hashpartitioning", final)) == 1


def test_source_positions_put_files_in_order(spark, tmp_path):
    """Two files cut into small blocks: steps back at and inside block borders are found, file by file."""
    from sunledger.sources.tables import read_raw_csv

    lines = lambda stamps: "asset_id,ts_utc\n" + "".join(f"a,1970-01-{1 + h // 24:02d} {h % 24:02d}:00:00\n" for h in stamps)
    good, bad = list(range(300)), [*range(100), *range(90, 300), 5]
    (tmp_path / "good.csv").write_text(lines(good))
    (tmp_path / "bad.csv").write_text(lines(bad))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        rows = read_raw_csv(spark, str(tmp_path), "asset_id STRING, ts_utc TIMESTAMP", with_source=True).cache()
        steps = series.ordering_check_blocks(rows).collect()
        blocks = rows.groupBy("source_file").agg(F.countDistinct("source_block").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(r.n > 5 for r in blocks)
    assert {r.source_file.rsplit("/")[-1]: (r.n_rows, r.n_backward) for r in steps} == {"good.csv": (300, 0), "bad.csv": (311, 2)}


def medians(df, name="m"):
    return {r.g: r[name] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_selected_median_is_exact(spark, seed):
    random.seed(seed)
    rows = [("zeros", 0.0)] * 900 + [("zeros", random.random()) for _ in range(700)]
    rows += [("even", float(i)) for i in range(10_000)] + [("odd", float(i * i)) for i in range(9_999)]
    rows += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("nulls", None), ("nulls", 3.0)]
    rows += [("heavy", random.lognormvariate(0, 5)) for _ in range(20_001)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(7)
    want = medians(df.groupBy("g").agg(F.expr("percentile(v, 0.5)").alias("m")))
    known = {g: m for g, m in want.items() if m is not None}
    assert medians(selected_median(df, ["g"], "v", "m")) == pytest.approx(known)
    # Cuts that are many, few or none: the answer is exact all the same.
    for values in (33, 2_000, 10**6):
        assert medians(selected_median(df, ["g"], "v", "m", values)) == pytest.approx(known)
    cuts = {r._k.g: r._at for r in medians_.value_cuts(df, ["g"], "v", 1_000).collect()}
    assert set(cuts) == {"even", "odd", "heavy"} and all(8 <= len(c) <= 60 and c == sorted(set(c)) for c in cuts.values())
    assert medians(agg_with_median(df, ["g"], "v", "m", values_per_task=1_000)) == pytest.approx(want)


def test_median_next_to_other_aggregates(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", 7.0)], "g STRING, v DOUBLE")
    for limit in (1, 1000):
        got = agg_with_median(df, ["g"], "v", "m", [F.count("v").alias("n")], values_per_task=limit)
        assert {(r.g, r.n, r.m) for r in got.collect()} == {("a", 10, 4.5), ("b", 1, 7.0)}


@pytest.mark.parametrize("cuts", [[], [7.5], [-1.0, 7.5, 8.0], [1e9, 2e9], [float(i) for i in range(0, 10**7, 10**5)], [6_000_000.0] * 3])
def test_cuts_that_are_far_off_give_the_same_answer(spark, cuts):
    """Cuts below, above and beside the middle, and one of a heavy value: counting the bins finds the middle, never a guess."""
    rows = [("g", float(i * i)) for i in range(5000)] + [("g", 7.5)] * 400 + [("h", 7.5)] * 3 + [("h", 7.0)] * 3 + [("n", None)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(5)
    placed = df.select(F.struct("g").alias("_k"), "v", F.array(*[F.lit(c) for c in cuts]).cast("array<double>").alias("_at"))
    got = {r._k.g: r.m for r in medians_.selected(placed, "v", "m").collect()}
    assert got == medians(df.where("v IS NOT NULL").groupBy("g").agg(F.median("v").alias("m")))


def test_median_of_small_groups_runs_one_aggregate(spark, tmp_path):
    spark.range(2000).select((F.col("id") % 5).alias("g"), F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "t"))
    found = agg_with_median(spark.read.parquet(str(tmp_path / "t")), ["g"], "v", "m")
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Union" not in final and "Window" not in final


def test_selected_median_without_a_group(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert selected_median(df, [], "v", "m").first().m == 50.0
    assert agg_with_median(df, [], "v", "m", values_per_task=33).first().m == 50.0


@pytest.mark.parametrize("kind", ["INT", "FLOAT", "DOUBLE", "DECIMAL(10,2)"])
def test_both_medians_give_one_answer(spark, kind, monkeypatch):
    """NULL keys, groups of NULLs only, values near the type's limit, an empty input."""
    rows = [("a", 1), ("a", 3), ("b", None), (None, 2), (None, 7), (None, None), ("c", 2147483646), ("c", 2147483647)]
    if kind != "INT":
        rows[-2:] = [("c", 16777214), ("c", 16777215)]
    df = spark.createDataFrame(rows, "g STRING, i INT").select("g", F.col("i").cast(kind).alias("v"))
    shown = lambda frame: sorted(map(repr, map(tuple, frame.collect())))
    for source in (df, df.where("1 = 0")):
        for by in (["g"], []):
            for others in ([], [F.count("v").alias("n"), F.count(F.lit(1)).alias("rows")]):
                small = agg_with_median(source, by, "v", "m", others)
                known = source.where("v IS NOT NULL")  # every group with values is large
                cuts = known.groupBy(medians_._key(by).alias("_k")).agg(F.array(F.lit(2.0)).alias("_at"))
                monkeypatch.setattr(medians_, "value_cuts", lambda *_: cuts)
                large = agg_with_median(source, by, "v", "m", others)
                monkeypatch.undo()
                assert shown(small) == shown(large) and small.columns == large.columns


def test_dimension_join_broadcasts_only_below_the_limit(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(join_dimension(rows, dim, "k", n_rows=10))
    assert "strategy=broadcast" not in plan(join_dimension(rows, dim, "k", n_rows=10, limit=5))
    assert "strategy=broadcast" not in plan(join_dimension(rows, dim, "k"))
    assert join_dimension(rows, dim, "k", n_rows=10, limit=5).count() == 100
