from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from sunledger.functions.scalars import fixed_decimals
from sunledger.sources import payloads
from sunledger.sources.tables import replace_table, restore_table, stage_table


def test_fixed_decimals_round_like_c(spark):
    random.seed(5)
    values = [0.25, 0.35, 0.15, 1.25, 2.675, -0.25, -1.35, 0.0, 1e6 + 0.05, 123456.785]
    values += [round(random.uniform(-500, 500), d) for d in (1, 2, 3, 4, 5) for _ in range(400)]
    values += [random.randrange(-4000, 4000) / 2**k for k in range(1, 8) for _ in range(100)]
    for digits in (0, 1, 3, 4):
        df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select("v", fixed_decimals("v", digits).alias("t"))
        for r in df.collect():
            assert r.t == f"{r.v:.{digits}f}", (r.v, digits)


def test_fixed_decimals_of_missing_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v DOUBLE").select(fixed_decimals("v", 2).alias("t"))
    assert [r.t for r in df.collect()] == [None, None]


def test_pv_reply(spark):
    reply = {
        "inputs": {"ignored": 1},
        "outputs": {
            "hourly": [
                {"time": "20190701:1010", "P": 5500.0, "G(i)": 80.5, "H_sun": 30, "T2m": 20.1, "WS10m": 1.2, "Int": 0.0},
                {"time": "20190701:1110", "P": 0.0, "G(i)": 0.0, "H_sun": 31, "T2m": 20.2, "WS10m": 1.3, "Int": 1.0},
            ]
        },
    }
    replies = spark.createDataFrame([("a", json.dumps(reply))], "asset_id STRING, body STRING")
    site = {"lat": F.lit(47.0), "lon": F.lit(8.0)}
    rows = payloads.explode_records(replies, literals=site).orderBy("ts_local").collect()
    assert [(str(r.ts_local), r.pv_power_kw, r.irradiance_w_m2, r.lat, r.reconstruction_flag) for r in rows] == [
        ("2019-07-01 10:10:00", 5.5, 80.5, 47.0, 0.0),
        ("2019-07-01 11:10:00", 0.0, 0.0, 47.0, 1.0),
    ]


def test_weather_reply(spark):
    reply = {
        "hourly": {
            "time": ["2019-07-01T00:00", "2019-07-01T01:00"],
            "shortwave_radiation": [0.0, None],
            "temperature_2m": [15.5, 15.1],
            "cloud_cover": [30, 100],
            "wind_speed_10m": [3.0, 2.5],
        }
    }
    replies = spark.createDataFrame([("a", json.dumps(reply))], "asset_id STRING, body STRING")
    rows = payloads.explode_parallel_arrays(replies).orderBy("ts_utc").collect()
    assert [(str(r.ts_utc), str(r.ts_local), r.ghi_w_m2, r.temp_c, r.cloud_pct) for r in rows] == [
        ("2019-07-01 00:00:00", "2019-07-01 02:00:00", 0.0, 15.5, 30),
        ("2019-07-01 01:00:00", "2019-07-01 03:00:00", None, 15.1, 100),
    ]


def test_generation_reply(spark):
    wide = spark.sql(
        "SELECT 'a' AS asset_id, timestamp'2019-01-01 00:00:00' AS ts_utc, 1.0D AS `Fossil Gas|Actual Aggregated`, "
        "2.0D AS `Hydro|Actual Consumption`, CAST(NULL AS DOUBLE) AS `Wind Onshore|Actual Aggregated`"
    )
    rows = payloads.parse_generation_mix(wide).collect()
    assert [(r.gen_type, r.generation_mw, str(r.ts_local)) for r in rows] == [("fossil_gas", 1.0, "2019-01-01 01:00:00")]


def test_replace_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(10).withColumn("year", F.lit(2019))
    assert replace_table(first, path, partition_by=["year"], sort_by=["id"]) == 10
    assert replace_table(first.where("id < 3"), path, partition_by=["year"]) == 3
    assert spark.read.parquet(path).count() == 3


def test_a_table_is_published_only_after_its_audit(spark, tmp_path):
    """Audits that raise, writes that fail and processes that die leave the old rows readable, and no folder behind."""
    path = str(tmp_path / "t")
    seen = {}
    replace_table(spark.range(10), path, figures=[F.max("id").alias("most"), F.count_if(F.col("id") > 6).alias("over")], audit=lambda s: seen.update(s.figures))
    assert seen == {"n_rows": 10, "most": 9, "over": 3}

    def refuse(staged):
        assert staged.read().count() == 3 and spark.read.parquet(path).count() == 10
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        replace_table(spark.range(3), path, audit=refuse)
    with pytest.raises(Exception, match="broken"):
        replace_table(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert spark.read.parquet(path).count() == 10 and [p.name for p in tmp_path.iterdir()] == ["t"]
    staged = stage_table(spark.range(4), path)
    (tmp_path / "t").rename(tmp_path / "t__old_x")  # dies between both renames
    assert restore_table(spark, path) and not restore_table(spark, path) and spark.read.parquet(path).count() == 10
    staged.publish()
    assert spark.read.parquet(path).count() == 4 and [p.name for p in tmp_path.iterdir()] == ["t"]
    assert replace_table(spark.read.parquet(path).where("id > 1"), path) == 2  # reads what it replaces
    assert replace_table(spark.range(0), path) == 0 and spark.read.parquet(path).count() == 0


def test_raw_csv_keeps_the_decimals_of_its_table(spark, tmp_path):
    from sunledger.sources import sinks, tables

    df = spark.createDataFrame([("a", 1.23456, 2.0)], "asset_id STRING, load_kw DOUBLE, other DOUBLE")
    for table, want in (("load_hourly", ("a", "1.235", "2.000")), ("pvgis_hourly", ("a", "1.23456", "2.0"))):
        sinks.write_raw_csv(df, table, str(tmp_path / table))
        assert tuple(spark.read.option("header", True).csv(str(tmp_path / table)).first()) == want
    names = "asset_id,ts_utc,battery_capacity_kwh,charge_kw,discharge_kw,soc_kwh,grid_import_kw,grid_export_kw"
    (tmp_path / "battery.csv").write_text(f"{names}\na,2019-01-01 00:00:00,50,1,0,2,3,4\n")
    row = tables.read_battery(spark, str(tmp_path / "battery.csv")).first()
    assert (row.battery_capacity_kwh, row.grid_export_kw) == (50.0, 4.0)
