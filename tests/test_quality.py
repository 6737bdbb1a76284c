from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sunledger.operators import forecasting, quality
from sunledger.operators.forecasting import best_round


@pytest.fixture(scope="module")
def bad_rows(spark):
    """One null, one repeated key, one value out of range."""
    rows = [("a", 0, 1.0), ("a", 1, None), ("a", 2, 500.0), ("a", 3, 2.0), ("a", 3, 3.0)]
    return spark.createDataFrame(rows, "asset_id STRING, h LONG, load_kw DOUBLE").withColumns(
        {"ts_utc": F.timestamp_seconds(F.col("h") * 3600), "ts_local": F.timestamp_seconds(F.col("h") * 3600)}
    )


def bad(report):
    return {(r.check_name, r.column_name): (r.bad_rows, r.severity) for r in report.collect()}


def test_each_check_finds_its_fault(bad_rows):
    key = ["asset_id", "ts_utc"]
    assert bad(quality.check_not_null(bad_rows, "t", ["asset_id", "load_kw"])) == {
        ("not_null", "asset_id"): (0, "error"),
        ("not_null", "load_kw"): (1, "error"),
    }
    assert bad(quality.check_unique(bad_rows, "t", key)) == {("unique", "asset_id, ts_utc"): (1, "error")}
    assert bad(quality.check_known_duplicates(bad_rows, "t", key, ["t"])) == {
        ("unique", "asset_id, ts_utc"): (1, "warn")
    }
    assert bad(quality.check_range(bad_rows, "t", {"load_kw": (0, 300)})) == {("accepted_range", "load_kw"): (1, "error")}
    assert bad(quality.check_bounds_raw(bad_rows, "t", {"load_kw": (2, None)})) == {("raw_bounds", "load_kw"): (1, "error")}


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan parquet")


def test_one_scan_for_the_checks_of_columns_and_one_for_those_of_keys(spark, bad_rows, tmp_path):
    bad_rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    columns = quality.check_columns(stored, "t", ["asset_id", "load_kw"], {"load_kw": (0, 300)})
    apart = quality.all_checks([quality.check_not_null(stored, "t", ["asset_id", "load_kw"]), quality.check_range(stored, "t", {"load_kw": (0, 300)})])
    assert bad(columns) == bad(apart)
    columns.collect()
    assert scans(columns) == 1 < len(quality.check_columns(stored, "t", [], {"load_kw": (0, 300)}).collect()) + 1
    keys = quality.check_keys(stored, "t", ["asset_id", "ts_utc"])
    keys.collect()
    assert bad(keys) == {("unique", "asset_id, ts_utc"): (1, "error"), ("row_count", "ts_utc"): (0, "error")}


@pytest.mark.parametrize("window", [None, ("1970-01-01", "1970-01-08")])
def test_keys_in_one_pass_equal_both_checks(spark, window):
    rows = [("a", m * 7) for m in range(400)] + [("a", 14), ("b", 0), ("b", 90), ("b", 90), ("b", 90), (None, 300)]
    df = spark.createDataFrame(rows, "asset_id STRING, m LONG").select("asset_id", F.timestamp_seconds(F.col("m") * 60).alias("ts_utc"))
    key = ["asset_id", "ts_utc"]
    apart = quality.all_checks([quality.check_known_duplicates(df, "t", key, ["t"]), quality.check_hour_coverage(df, "t", window=window)])
    got = bad(quality.check_keys(df, "t", key, ["t"], window))
    assert got == bad(apart) and got["unique", "asset_id, ts_utc"] == (2, "warn")
    empty = quality.check_keys(df.where("1 = 0"), "t", key, ["t"], window)
    assert bad(empty)["row_count", "ts_utc"] == bad(quality.check_hour_coverage(df.where("1 = 0"), "t", window=window))["row_count", "ts_utc"]


def test_figures_tell_what_the_checks_tell(spark, bad_rows):
    figures = bad_rows.agg(F.count(F.lit(1)).alias("n_rows"), *quality.column_figures(["load_kw"], {"load_kw": (0, 300)})).first().asDict()
    told = bad(quality.report_figures(spark, figures, "t", "raw_bounds", expected=10))
    assert told == {("not_null", "load_kw"): (1, "error"), ("raw_bounds", "load_kw"): (1, "error"), ("row_count", "*"): (5, "error")}


def test_limits_are_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (300.0,)], "load_kw DOUBLE")
    assert quality.check_range(df, "t", {"load_kw": (0, 300)}).first().bad_rows == 0


def test_row_counts(bad_rows):
    assert quality.check_row_count(bad_rows, "t", 5).first().bad_rows == 0
    assert quality.check_row_count(bad_rows, "t", 10).first().bad_rows == 5
    assert quality.check_row_count(bad_rows, "t", 4, exact=True).first().bad_rows == 1
    assert quality.check_row_count(bad_rows, "t", 5, distinct="ts_utc").first().bad_rows == 1
    assert quality.check_hour_coverage(bad_rows, "t").first().bad_rows == 0


def test_hour_coverage_of_each_series(spark):
    """One full asset beside one with 2 of 100 hours, a window that reaches beyond the data, no rows."""
    rows = [("full", h) for h in range(100)] + [("poor", 0), ("poor", 1), ("poor", 1)]
    df = spark.createDataFrame(rows, "asset_id STRING, h LONG").select("asset_id", F.timestamp_seconds(F.col("h") * 3600).alias("ts_utc"))
    window = ("1970-01-01", "1970-01-11")
    lacks = lambda frame, **options: quality.check_hour_coverage(frame, "t", **options).first().bad_rows
    assert lacks(df) == 96
    assert lacks(df.where("asset_id = 'full'")) == 0
    assert lacks(df, window=window, share=1.0) == 140 + 238
    assert lacks(df.limit(0)) == 0 and lacks(df.limit(0), window=window, share=1.0) == 240


def test_split_overlap(spark):
    df = spark.createDataFrame([("a", 1, "train"), ("a", 1, "test"), ("a", 2, "test")], "asset_id STRING, ts_utc LONG, split STRING")
    assert quality.check_split_overlap(df, "t").first().bad_rows == 1


def test_annual_total(bad_rows):
    assert quality.check_annual_total(bad_rows, "t", "load_kw", 506.0).first().bad_rows == 0
    assert quality.check_annual_total(bad_rows, "t", "load_kw", 600.0).first().bad_rows == 1


def test_summary(bad_rows):
    report = quality.all_checks(
        [quality.check_not_null(bad_rows, "t", ["asset_id", "load_kw"]), quality.check_range(bad_rows, "t", {"load_kw": (0, 300)})]
    )
    row = quality.passed(report).first()
    assert (row.severity, row.n_checks, row.n_failed) == ("error", 3, 2)


@pytest.fixture(scope="module")
def months(spark):
    return spark.sql(
        "SELECT 'a' AS asset_id, explode(sequence(timestamp'2015-01-08 00:00:00', timestamp'2020-02-08 00:00:00', "
        "interval 1 month)) AS ts_utc"
    )


def test_chronological_split(months):
    split = forecasting.chronological_split(months)
    spans = {
        r.split: (str(r.lo)[:7], str(r.hi)[:7], r.n)
        for r in split.groupBy("split").agg(F.min("ts_utc").alias("lo"), F.max("ts_utc").alias("hi"), F.count("*").alias("n")).collect()
    }
    assert spans == {
        "train": ("2015-01", "2018-12", 48),
        "validation": ("2019-01", "2019-06", 6),
        "test": ("2019-07", "2019-12", 6),
    }
    assert quality.check_split_bounds(split, "t").first().bad_rows == 0
    assert quality.check_split_total(split, months, "t").first().bad_rows == 0
    assert quality.split_overlap(split).count() == 0


def test_split_checks_find_faults(months):
    split = forecasting.chronological_split(months)
    moved = split.withColumn("split", F.when(F.col("ts_utc") > "2019-12-01", "train").otherwise(F.col("split")))
    assert quality.check_split_bounds(moved, "t").first().bad_rows == 1
    doubled = split.unionByName(split.where("split = 'test'").withColumn("split", F.lit("train")))
    assert quality.split_overlap(doubled).count() == 6
    assert quality.check_split_total(doubled.unionByName(doubled), months, "t").first().bad_rows > 0


def test_each_series_may_count_from_its_own_first_month(spark, tmp_path):
    """A site that joins in month 30 has train rows of its own; the stored table is bounded by year."""
    month = lambda m: f"{2000 + m // 12}-{m % 12 + 1:02d}-15 12:00:00"
    rows = [("old", month(m)) for m in range(70)] + [("new", month(m)) for m in range(30, 100)] + [(None, month(5))]
    df = spark.createDataFrame(rows, "asset_id STRING, t STRING").select("asset_id", F.to_timestamp("t").alias("ts_utc"), F.year(F.to_timestamp("t")).alias("year"))
    df.write.partitionBy("year").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    split = forecasting.chronological_split(stored, by=["asset_id"])
    counts = {(r.asset_id, r.split): r["count"] for r in split.groupBy("asset_id", "split").count().collect()}
    parts = {"train": 48, "validation": 6, "test": 6}
    assert counts == {**{(a, p): n for a in ("old", "new") for p, n in parts.items()}, (None, "train"): 1}
    assert quality.check_split_bounds(split, "t", by=["asset_id"]).first().bad_rows == 0
    assert quality.check_split_bounds(split, "t").first().bad_rows > 0
    together = forecasting.chronological_split(stored)
    assert together.where("asset_id = 'new' AND split = 'train'").count() == 18
    assert quality.check_split_bounds(together, "t").first().bad_rows == 0
    for frame in (split, together):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year" in plan


def test_clocks_that_are_not_those_of_their_instants(spark):
    rows = [("2019-01-01 00:00:00", "2019-01-01 01:00:00"), ("2019-07-01 00:00:00", "2019-07-01 01:00:00"), ("2019-07-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "u STRING, l STRING").select(F.to_timestamp("u").alias("ts_utc"), F.to_timestamp_ntz("l").alias("ts_local"))
    assert bad(quality.check_local_time(df, "t")) == {("local_time", "ts_local"): (1, "warn")}
    figures = df.agg(F.count(F.lit(1)).alias("n_rows"), quality.clock_figure()).first().asDict()
    assert bad(quality.report_figures(spark, figures, "t")) == {("local_time", "ts_local"): (1, "warn")}


def test_best_round():
    assert best_round([5, 4, 3, 3.5, 3.4, 3.3], patience=3) == (3, True)
    assert best_round([5, 4, 3, 3.5], patience=3) == (3, False)
    assert best_round([5, 4, 3], patience=50) == (3, False)


def test_gate(spark):
    df = spark.createDataFrame([(10.0, 11.0, 12.0), (10.0, 9.0, 8.0)], "y DOUBLE, y_pred DOUBLE, base DOUBLE")
    row = forecasting.acceptance_gate(df, "y", "base", 0.85).first()
    assert (row.model_mae, row.baseline_mae, row.limit_mae, row.accepted) == (1.0, 2.0, 1.7, True)
    assert not forecasting.acceptance_gate(df, "y", "base", 0.5, strict=True).first().accepted
    assert forecasting.acceptance_gate(df, "y", "base", 0.5).first().accepted
