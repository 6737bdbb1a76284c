"""The whole path on five years of one site: CSV files in, KPI marts, models, forecasts and metrics out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sunledger.functions import timeops
from sunledger.operators import economics
from sunledger.operators.calendar_dim import holiday_dim
from sunledger.plans.warehouse import Warehouse
from sunledger.settings import BATTERY_CAPACITIES_KWH
from sunledger.sources.schemas import RAW_TABLES
from sunledger.sources.sinks import write_csv, write_csv_rounded
from sunledger.sources.tables import read_raw_table


def write_raw(spark, folder):
    start = F.unix_seconds(F.lit("2015-01-01").cast("timestamp"))
    day = 2 * 3.14159265 / 24
    hours = spark.range(0, 43_824, 1, 4).select(
        F.lit("site").alias("asset_id"),
        F.col("id").alias("h"),
        F.timestamp_seconds(start + F.col("id") * 3600).alias("ts_utc"),
    )
    sun = F.greatest(F.sin((F.col("h") - 6) * day), F.lit(0.0)) * (1 + 0.3 * F.sin(F.col("h") / 50.0))
    file = lambda name: f"{folder}/{RAW_TABLES[name].file}"

    pv = hours.select(
        "asset_id",
        F.lit(47.0).alias("lat"),
        F.lit(8.0).alias("lon"),
        F.lit(100.0).alias("peak_power_kwp"),
        (F.col("ts_utc") + F.expr("INTERVAL 10 MINUTES")).cast("timestamp_ntz").alias("ts_local"),
        (sun * 70).alias("pv_power_kw"),
        (sun * 70_000).alias("pv_power_w"),
        (sun * 800).alias("irradiance_w_m2"),
        (sun * 60).alias("sun_height_deg"),
        F.lit(12.0).alias("temp_2m_c"),
        F.lit(2.0).alias("wind_speed_m_s"),
        F.lit(0.0).alias("reconstruction_flag"),
    )
    write_csv(pv, file("pvgis_hourly"))

    wall = F.col("ts_utc").cast("timestamp_ntz")
    local_utc = timeops.localize_wall_clock(wall)
    load = hours.select(
        "asset_id",
        local_utc.alias("ts_utc"),
        timeops.utc_to_local(local_utc).alias("ts_local"),
        (F.lit(57.0) + 20 * F.sin(F.col("h") * day)).alias("load_kw"),
    )
    write_csv_rounded(load, file("load_hourly"), 3)

    local = timeops.utc_to_local("ts_utc").alias("ts_local")
    price = F.lit(45.0) + 15 * F.sin(F.col("h") * day) + 5 * F.sin(F.col("h") / 100.0)
    prices = hours.select("asset_id", "ts_utc", local, price.alias("price_eur_mwh"), (price / 1000).alias("price_eur_kwh"))
    write_csv_rounded(prices, file("entsoe_prices"), 4)
    weather = hours.select(
        "asset_id",
        "ts_utc",
        local,
        (sun * 800).alias("ghi_w_m2"),
        F.lit(10.0).alias("temp_c"),
        (F.col("h") % 101).cast("int").alias("cloud_pct"),
        F.lit(3.0).alias("wind_ms"),
    )
    write_csv(weather, file("openmeteo_hourly"))
    write_csv_rounded(
        hours.select("asset_id", "ts_utc", local, (F.lit(7000.0) + F.col("h") % 500).alias("load_forecast_mw")),
        file("entsoe_load_forecast"),
        1,
    )
    types = F.explode(F.array(F.lit("solar"), F.lit("nuclear"), F.lit("hydro_reservoir"))).alias("gen_type")
    write_csv_rounded(
        hours.select("asset_id", "ts_utc", local, types, (F.lit(100.0) + F.col("h") % 50).alias("generation_mw")),
        file("entsoe_genmix"),
        1,
    )


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    csv = str(tmp_path_factory.mktemp("csv"))
    write_raw(spark, csv)
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    rows = warehouse.load_raw(csv)
    assert rows["load_hourly"] == 43_824 and rows["entsoe_genmix"] == 3 * 43_824
    assets = spark.createDataFrame(
        [("site", 0.28, 0.08, 30.0)],
        "asset_id STRING, retail_chf_per_kwh DOUBLE, feed_in_chf_per_kwh DOUBLE, grid_carbon_g_per_kwh DOUBLE",
    )
    warehouse.rows = warehouse.build(assets, holiday_dim(spark, 2014, 2020))
    return warehouse


def test_rows_follow_the_daylight_saving_rules(house):
    assert house.rows["int_hourly_energy_balance"] == 43_818
    assert house.rows["fct_asset_performance"] == 43_818
    assert house.rows["mrt_zev_kpis_monthly"] == 60
    assert house.rows["fct_hourly_market"] == house.rows["fct_pv_features"] == 43_824


def test_checks_pass(house):
    stored = ("int_hourly_energy_balance", "fct_asset_performance", "fct_hourly_market", "fct_pv_features")
    kpis = ("mrt_zev_kpis_daily", "mrt_zev_kpis_monthly")
    tables = {**house.staged(), **{name: house.table(name) for name in (*stored, *kpis)}}
    report = house.report(tables)
    assert report.where("bad_rows > 0").collect() == []
    assert report.count() > 50


def test_load_fails_on_a_broken_file(spark, tmp_path):
    broken = spark.createDataFrame(
        [("site", "2019-01-01 00:00:00", None), ("site", "2019-01-01 01:00:00", 1.0)],
        "asset_id STRING, ts STRING, load_kw DOUBLE",
    ).select(
        "asset_id",
        F.to_timestamp("ts").alias("ts_utc"),
        F.to_timestamp_ntz("ts").alias("ts_local"),
        "load_kw",
    )
    write_csv(broken, str(tmp_path / "csv" / RAW_TABLES["load_hourly"].file))
    with pytest.raises(ValueError, match="load_hourly.load_kw"):
        Warehouse(spark, str(tmp_path / "out")).load_raw(str(tmp_path / "csv"), ["load_hourly"])


def test_load_fails_on_a_truncated_file(spark, tmp_path):
    hours = spark.range(20).select(
        F.lit("site").alias("asset_id"),
        F.timestamp_seconds(F.col("id") * 3600).alias("ts_utc"),
        F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts_local"),
        F.lit(1.0).alias("load_kw"),
    )
    write_csv(hours, str(tmp_path / "csv" / RAW_TABLES["load_hourly"].file))
    house = Warehouse(spark, str(tmp_path / "out"))
    assert house.load_raw(str(tmp_path / "csv"), ["load_hourly"]) == {"load_hourly": 20}
    with pytest.raises(ValueError, match="load_hourly.ts_utc: row_count 4"):
        house.load_raw(str(tmp_path / "csv"), ["load_hourly"], window=("1970-01-01", "1970-01-02"))


def load_csv(spark, folder, stamps, value=lambda h: 1.0):
    lines = "".join(f"site,1970-01-{1 + h // 24:02d} {h % 24:02d}:00:00,1970-01-{1 + h // 24:02d} {h % 24:02d}:00:00,{value(h)}\n" for h in stamps)
    folder.mkdir()
    (folder / RAW_TABLES["load_hourly"].file).write_text("asset_id,ts_utc,ts_local,load_kw\n" + lines)
    return str(folder)


def test_a_failed_load_leaves_the_old_rows(spark, tmp_path):
    """A null, a step back in time and a malformed line: every time the first load stays readable."""
    house = Warehouse(spark, str(tmp_path / "out"))
    good = load_csv(spark, tmp_path / "good", range(48))
    assert house.load_raw(good, ["load_hourly"]) == {"load_hourly": 48}
    bad = {
        "load_kw: not_null 1": load_csv(spark, tmp_path / "null", range(20), lambda h: "" if h == 3 else 2.0),
        "source_order 2": load_csv(spark, tmp_path / "unsorted", [*range(10), 12, 11, 10, *range(13, 30)]),
        "MALFORMED|Malformed": load_csv(spark, tmp_path / "malformed", range(20), lambda h: "much" if h == 19 else 2.0),
    }
    for message, folder in bad.items():
        with pytest.raises(Exception, match=message):
            house.load_raw(folder, ["load_hourly"])
        assert house.raw("load_hourly").agg(F.count("*"), F.sum("load_kw")).first() == (48, 48.0)
        assert [p.name for p in (tmp_path / "out" / "raw").iterdir()] == ["load_hourly"]
    assert house.raw_report(["load_hourly"]).where("bad_rows > 0 AND severity = 'error'").count() == 0
    assert house.raw("load_hourly").columns == ["asset_id", "ts_utc", "ts_local", "load_kw"]


def test_a_mart_that_fails_its_checks_is_not_published(house):
    before = house.table("fct_pv_features").count()
    with pytest.raises(ValueError, match="fct_pv_features.pv_power_kw: accepted_range"):
        house._store("fct_pv_features", house.table("fct_pv_features").drop("year").withColumn("pv_power_kw", F.lit(121.0)))
    assert house.table("fct_pv_features").count() == before and house.table("fct_pv_features").agg(F.max("pv_power_kw")).first()[0] < 121


def test_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / RAW_TABLES["load_hourly"].file
    path.write_text("asset_id,ts_utc,ts_local,load_kw\nsite,2019-01-01 00:00:00,2019-01-01 01:00:00,much\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_raw_table(spark, str(tmp_path), "load_hourly").collect()


def test_sql_over_registered_marts(spark, house):
    house.register(["mrt_zev_kpis_monthly", "fct_asset_performance"])
    row = spark.sql(
        "SELECT AVG(self_consumption_ratio) AS sc, SUM(chf_saved) / 5 AS chf FROM mrt_zev_kpis_monthly"
    ).first()
    assert 0 < row.sc <= 1 and row.chf > 0


def test_year_filter_skips_folders(house):
    plan = house.table("fct_asset_performance").where("year = 2019")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_battery_marts(house):
    hourly = house.table("int_hourly_energy_balance")
    capacity = F.explode(F.array(*[F.lit(float(c)) for c in BATTERY_CAPACITIES_KWH])).alias("battery_capacity_kwh")
    share = F.lit(1.0) - F.col("battery_capacity_kwh") / 1000
    dispatch = hourly.select("asset_id", "ts_utc", "surplus_kw", "deficit_kw", capacity).select(
        "asset_id",
        "ts_utc",
        "battery_capacity_kwh",
        F.lit(-1e-12).alias("charge_kw"),
        F.lit(0.0).alias("discharge_kw"),
        F.lit(0.0).alias("soc_kwh"),
        (F.col("deficit_kw") * share).alias("grid_import_kw"),
        (F.col("surplus_kw") * share).alias("grid_export_kw"),
    )
    rows = house.build_battery(dispatch)
    assert rows["fct_asset_performance_battery"] == 5 * 43_818
    assert rows["mrt_zev_kpis_battery_monthly"] == 5 * 60
    names = ("fct_asset_performance_battery", "mrt_zev_kpis_battery_daily", "mrt_zev_kpis_battery_monthly")
    assert house.report({name: house.table(name) for name in names}).where("bad_rows > 0").collect() == []
    monthly = house.table("mrt_zev_kpis_battery_monthly")
    savings = economics.capacity_savings(economics.capacity_comparison(monthly)).orderBy("battery_capacity_kwh").collect()
    assert savings[0].annual_savings_chf == 0
    gains = [r.annual_savings_chf for r in savings]
    assert gains == sorted(gains)


def test_train_predict_evaluate(house):
    saved = house.train(rounds=12, patience=4, version="v1")
    assert saved == {"price_eur_mwh": True, "pv_power_kw": True}
    assert house.predict() == 2 * 4_416
    forecasts = house.table("fct_forecasts")
    assert forecasts.where("target = 'pv_power_kw' AND y_pred < 0").count() == 0
    metrics = {(r.target, r.split, r.model): r for r in house.evaluate().collect()}
    assert len(metrics) == 18
    price = metrics[("price_eur_mwh", "overall", "model")]
    assert price.model_version == "v1"
    assert price.mae < 0.85 * metrics[("price_eur_mwh", "overall", "seasonal_naive_168h")].mae
    assert price.lift_vs_seasonal_pct > 15


def test_marts_from_stored_series_equal_the_lazy_ones(spark, house):
    """A rebuild from buckets gives the same marts; last, as it writes them again."""
    names = ("int_hourly_energy_balance", "fct_hourly_market", "fct_pv_features")
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
    before = {name: digest(house.table(name)) for name in names}
    assert house.store_staged(rows_per_bucket=20_000)["stg_entsoe_prices"] == 43_824
    scans = house.stored_series()["stg_pvgis_hourly"].groupBy("asset_id", "_range").count()._jdf.queryExecution().executedPlan().toString()
    assert "8 out of 8" in scans
    assets = spark.createDataFrame(
        [("site", 0.28, 0.08, 30.0)],
        "asset_id STRING, retail_chf_per_kwh DOUBLE, feed_in_chf_per_kwh DOUBLE, grid_carbon_g_per_kwh DOUBLE",
    )
    assert house.build(assets, holiday_dim(spark, 2014, 2020), from_stored=True) == house.rows
    assert {name: digest(house.table(name)) for name in names} == before
