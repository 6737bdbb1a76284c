from __future__ import annotations

from pyspark.sql import functions as F

from sunledger.operators import balance, economics, evaluation, rollups, staging
from sunledger.functions import scalars


def test_years_are_united_by_name(spark):
    first = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "asset_id STRING, price DOUBLE")
    second = spark.createDataFrame([(2.0, "b")], "price DOUBLE, asset_id STRING")
    rows = rollups.concat_years({1999: first, 2000: second}).select("year", "asset_id", "price").collect()
    assert sorted(map(tuple, rows)) == [(1999, "a", 1.0), (1999, "a", 1.0), (2000, "b", 2.0)]


def test_years_of_stored_folders(spark, tmp_path):
    """Folders with unequal columns, one without a year: one scan of each, the lacking column null."""
    from sunledger.sources.tables import read_year_folders

    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1.0, 1999), ("b", 2.0, None)], "asset_id STRING, price DOUBLE, year INT").write.partitionBy("year").parquet(path)
    spark.createDataFrame([("c", 3.0, 4, 2000)], "asset_id STRING, price DOUBLE, extra INT, year INT").write.mode("append").partitionBy("year").parquet(path)
    frames = read_year_folders(spark, path)
    assert list(frames) == [1999, 2000, None]
    united = rollups.concat_years(frames)
    assert {(r.year, r.asset_id, r.price, r.extra) for r in united.collect()} == {(1999, "a", 1.0, None), (2000, "c", 3.0, 4), (None, "b", 2.0, None)}
    assert united._jdf.queryExecution().executedPlan().toString().count("FileScan") == 3
    assert read_year_folders(spark, str(tmp_path / "none")) == {}


def facts(spark, rows):
    """rows: (local timestamp, pv, load) of one asset with the default tariffs."""
    df = spark.createDataFrame([("a", *r) for r in rows], "asset_id STRING, t STRING, pv_power_kw DOUBLE, load_kw DOUBLE")
    timed = df.select(
        "asset_id",
        F.to_timestamp("t").alias("ts_utc"),
        F.to_timestamp_ntz("t").alias("ts_local"),
        "pv_power_kw",
        "load_kw",
    )
    tariff = spark.createDataFrame(
        [("a", 0.28, 0.08, 30.0)],
        "asset_id STRING, retail_chf_per_kwh DOUBLE, feed_in_chf_per_kwh DOUBLE, grid_carbon_g_per_kwh DOUBLE",
    )
    return balance.asset_facts(balance.split_flows(timed), tariff)


def test_daily_kpis(spark):
    row = rollups.kpi_daily(facts(spark, [("2019-06-01 10:00:00", 50.0, 20.0), ("2019-06-01 11:00:00", 10.0, 30.0)])).first()
    assert (row.total_pv_kwh, row.total_load_kwh, row.self_consumption_kwh) == (60.0, 50.0, 30.0)
    assert (row.surplus_kwh, row.deficit_kwh) == (30.0, 20.0)
    assert (row.self_consumption_ratio, row.autarky_ratio) == (0.5, 0.6)
    assert (row.co2_avoided_kg, row.chf_saved) == (0.9, 6.0)


def test_zero_pv_is_zero_by_day_and_null_by_month(spark):
    daily = rollups.kpi_daily(facts(spark, [("2019-12-01 10:00:00", 0.0, 20.0)]))
    assert daily.first().self_consumption_ratio == 0.0
    monthly = rollups.kpi_monthly(daily).first()
    assert monthly.self_consumption_ratio is None
    assert monthly.autarky_ratio == 0.0


def test_month_adds_up_rounded_days(spark):
    """Three days of 0.0345 kg round to 0.035 (0.0345 -> 3 decimals) before they are added."""
    rows = [(f"2019-06-0{d} 10:00:00", 1.15, 1.15) for d in (1, 2, 3)]
    monthly = rollups.kpi_monthly(rollups.kpi_daily(facts(spark, rows))).first()
    assert monthly.co2_avoided_kg == 0.11
    assert monthly.chf_saved == 0.69


def test_overview_and_report(spark):
    rows = [("2018-06-01 10:00:00", 10.0, 10.0), ("2019-06-01 10:00:00", 10.0, 30.0)]
    monthly = rollups.kpi_monthly(rollups.kpi_daily(facts(spark, rows)))
    overview = rollups.kpi_overview(monthly, n_years=2).first()
    assert overview.avg_sc_ratio == 1.0
    assert round(overview.avg_autarky, 5) == 0.66665
    assert overview.avg_chf_yr == 2.0
    report = rollups.kpi_monthly_report(monthly, years=[2019]).collect()
    assert len(report) == 1 and report[0].grid_import_mwh == 0.02 and report[0].self_consumption_pct == 100.0
    assert rollups.kpi_monthly_report(monthly).count() == 2


def test_balance_joins_on_asset_and_hour(spark):
    schema = "asset_id STRING, ts_utc TIMESTAMP, ts_local TIMESTAMP_NTZ, "
    make = lambda rows, name: spark.createDataFrame(rows, "asset_id STRING, t STRING, v DOUBLE").select(
        "asset_id", F.to_timestamp("t").alias("ts_utc"), F.to_timestamp_ntz("t").alias("ts_local"), F.col("v").alias(name)
    )
    pv = make([("a", "2019-01-01 00:00:00", 5.0), ("b", "2019-01-01 00:00:00", 7.0)], "pv_power_kw")
    load = make([("a", "2019-01-01 00:00:00", 2.0), ("b", "2019-01-01 01:00:00", 7.0)], "load_kw")
    got = balance.energy_balance(pv, load).collect()
    assert [(r.asset_id, r.direct_self_consumption_kw, r.surplus_kw, r.deficit_kw) for r in got] == [("a", 2.0, 3.0, 0.0)]
    assert schema


def test_duplicate_hours_are_averaged(spark):
    raw = spark.createDataFrame(
        [("a", "2019-03-31 01:00:00", "2019-03-31 03:00:00", v) for v in ("10", "20")],
        "asset_id STRING, ts_utc STRING, ts_local STRING, load_kw STRING",
    )
    row = staging.dedupe_avg(raw).first()
    assert row.load_kw == 15.0


def test_pv_staging_floors_and_derives_local_time(spark):
    raw = spark.createDataFrame(
        [("a", "2019-07-01 10:10:00", "5.5")], "asset_id STRING, ts_local STRING, pv_power_kw STRING"
    ).withColumns({c: F.lit("0") for c in ("irradiance_w_m2", "sun_height_deg", "temp_2m_c", "wind_speed_m_s")})
    row = staging.stg_pv(raw).select("ts_utc", F.col("ts_local").cast("string").alias("local"), "pv_power_kw").first()
    assert str(row.ts_utc) == "2019-07-01 10:00:00"
    assert (row.local, row.pv_power_kw) == ("2019-07-01 12:00:00", 5.5)


def test_generation_mix_shares(spark):
    rows = [("solar", 10.0), ("hydro_reservoir", 20.0), ("hydro_run_of_river", 10.0), ("nuclear", 50.0), ("waste", 10.0)]
    long = spark.createDataFrame(
        [("a", "2019-01-01 00:00:00", k, v) for k, v in rows], "asset_id STRING, ts_utc STRING, gen_type STRING, generation_mw DOUBLE"
    ).withColumn("ts_local", F.col("ts_utc"))
    row = staging.genmix_pivot(long).first()
    assert (row.hydro_mw, row.gas_mw, row.total_gen_mw) == (30.0, 0.0, 100.0)
    assert (row.solar_share, row.hydro_share, row.nuclear_share) == (0.1, 0.3, 0.5)
    empty = staging.genmix_pivot(long.withColumn("generation_mw", F.lit(0.0))).first()
    assert empty.solar_share == 0.0


def test_labels(spark):
    df = spark.createDataFrame([(" Fossil Gas ",), ("Hydro Run-of-river and poundage",), ("__x--",)], "t STRING")
    got = [r[0] for r in df.select(scalars.normalize_label("t")).collect()]
    assert got == ["fossil_gas", "hydro_run_of_river_and_poundage", "x"]


def test_error_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 8.0), (-5.0, -5.0)], "y_true DOUBLE, y_pred DOUBLE")
    row = evaluation.error_metrics(df).first()
    assert (row.mae, row.mape, row.rmse) == (1.0, 40.0, 1.291)


def test_metrics_by_split(spark):
    rows = [("price_eur_mwh", "v1", h, 10.0, 10.0 + h, 8.0, 4.0) for h in (7, 8, 19, 20)]
    df = spark.createDataFrame(
        rows, "target STRING, model_version STRING, hour_of_day INT, y_true DOUBLE, y_pred DOUBLE, lag_24h DOUBLE, lag_168h DOUBLE"
    )
    got = {(r.split, r.model): r.mae for r in evaluation.error_metrics_by_split(df, "price_eur_mwh").collect()}
    assert len(got) == 9
    assert got[("overall", "model")] == 13.5
    assert got[("peak_8_19h", "model")] == 13.5
    assert got[("offpeak", "model")] == 13.5
    assert got[("peak_8_19h", "persistence_24h")] == 2.0
    lift = evaluation.forecast_lift(evaluation.error_metrics_by_split(df, "price_eur_mwh"), "seasonal_naive_168h").first()
    assert (lift.model_mae, lift.baseline_mae, lift.lift_pct) == (13.5, 6.0, -125.0)
    assert evaluation.error_metrics_by_split(df, "pv_power_kw").count() == 0


def test_battery_savings_and_payback(spark):
    comparison = spark.createDataFrame(
        [(0.0, 1000.0, 0.5, 0.4), (50.0, 900.0, 0.6, 0.5), (100.0, 1100.0, 0.7, 0.6)],
        "battery_capacity_kwh DOUBLE, total_net_chf_cost DOUBLE, self_consumption_ratio DOUBLE, autarky_ratio DOUBLE",
    )
    savings = economics.capacity_savings(comparison)
    got = {r.battery_capacity_kwh: r for r in savings.collect()}
    assert got[0.0].annual_savings_chf == 0.0 and got[50.0].annual_savings_chf == 20.0
    assert round(got[50.0].autarky_gain, 6) == 0.1
    payback = {r.battery_capacity_kwh: r for r in economics.capacity_payback(savings).collect()}
    assert set(payback) == {50.0, 100.0}
    assert (payback[50.0].investment_chf, payback[50.0].payback_years) == (25_000.0, 1250.0)
    assert payback[100.0].payback_years is None


def test_local_date_filter_is_pushed_as_a_range(spark, tmp_path):
    spark.createDataFrame(
        [("2019-07-01 00:00:00",), ("2019-07-14 23:00:00",), ("2019-07-15 00:00:00",)], "t STRING"
    ).select(F.to_timestamp_ntz("t").alias("ts_local")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    chosen = evaluation.filter_local_date_range(stored, "2019-07-01", "2019-07-14")
    assert chosen.count() == 2
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts_local" in plan and "LessThan(ts_local" in plan


def test_stored_forecasts_are_filtered_in_the_scan(spark, tmp_path):
    rows = [("a", "price_eur_mwh", 1.0, 2.0), ("a", "pv_power_kw", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "asset_id STRING, target STRING, y_pred DOUBLE, y_true DOUBLE")
    df.write.partitionBy("target").parquet(str(tmp_path / "f"))
    chosen = evaluation.filter_target(spark.read.parquet(str(tmp_path / "f")), "pv_power_kw")
    assert chosen.count() == 1
    assert "PartitionFilters: [isnotnull(target" in chosen._jdf.queryExecution().executedPlan().toString()


def test_scale_to_annual_total(spark):
    df = spark.createDataFrame(
        [("a", "2018-05-01 00:00:00", 1.0), ("a", "2018-06-01 00:00:00", 3.0), ("a", "2019-05-01 00:00:00", 5.0)],
        "asset_id STRING, t STRING, load_kw DOUBLE",
    ).withColumn("ts_local", F.to_timestamp_ntz("t"))
    got = {r.t: r.load_kw for r in rollups.scale_to_annual_total(df, "load_kw", 100.0).collect()}
    assert got == {"2018-05-01 00:00:00": 25.0, "2018-06-01 00:00:00": 75.0, "2019-05-01 00:00:00": 100.0}
