from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sunledger.operators import features
from sunledger.operators.calendar_dim import holiday_dim


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Stored staged tables of seven assets, with gaps in every joined side."""
    folder = tmp_path_factory.mktemp("staged")
    start = F.unix_seconds(F.lit("2019-12-20").cast("timestamp"))
    base = spark.range(0, 7 * 600, 1, 3).select(
        F.concat(F.lit("a"), (F.col("id") % 7).cast("string")).alias("asset_id"),
        F.timestamp_seconds(start + F.floor(F.col("id") / 7) * 3600).alias("ts_utc"),
        "id",
    )
    number = lambda seed: F.abs(F.hash("id", F.lit(seed))) % 1000 / 10
    local = F.col("ts_utc").cast("timestamp_ntz").alias("ts_local")

    def stored(name, df):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return {
        "prices": stored(
            "prices",
            base.select("asset_id", "ts_utc", local, number(1).alias("price_eur_mwh"), number(1).alias("price_eur_kwh")),
        ),
        "weather": stored(
            "weather",
            base.where("id % 5 > 0").select(
                "asset_id", "ts_utc", number(2).alias("ghi_w_m2"), number(3).alias("temp_c"),
                F.lit(3).alias("cloud_pct"), number(4).alias("wind_ms"),
            ),
        ),
        "load_forecast": stored(
            "forecast", base.where("id % 7 > 1").select("asset_id", "ts_utc", number(5).alias("load_forecast_mw"))
        ),
        "genmix": stored(
            "mix",
            base.where("id % 3 > 0").select(
                "asset_id", "ts_utc", *[number(6 + i).alias(c) for i, c in enumerate(features.MIX)]
            ),
        ),
    }


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def shuffles(df):
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"Exchange hashpartitioning\(asset_id", final))


def test_four_plans_one_answer(spark, tables):
    holidays = holiday_dim(spark, 2019, 2020)
    build = lambda **how: features.price_features(holidays=holidays, **tables, **how)
    natural = build()
    want = rows(natural)
    assert len(want) == 4200
    assert rows(build(together=True)) == want
    assert rows(build(rows_per_task=100)) == want
    assert rows(build(rows_per_task=100, together=True)) == want
    assert natural.where("is_holiday").select(F.to_date("ts_local").alias("d")).distinct().count() == 4


def test_partitioned_by_range_shuffles_each_input_once(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        holidays = holiday_dim(spark, 2019, 2020)
        natural = features.price_features(holidays=holidays, **tables)
        together = features.price_features(holidays=holidays, **tables, together=True)
        assert rows(natural) == rows(together)
        # Counted in the plans that ran: prices, three sides, and only without `together` the joined rows.
        assert (shuffles(natural), shuffles(together)) == (5, 4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_day_ahead_safe_leaves_out_the_last_hour(spark, tables):
    safe = features.price_features(holidays=holiday_dim(spark, 2019, 2020), **tables, day_ahead_safe=True)
    assert "price_lag_1h" not in safe.columns and "price_lag_24h" in safe.columns


def test_feature_columns_leave_out_keys_target_and_twin():
    class Frame:
        columns = ["asset_id", "ts_utc", "ts_local", "price_eur_mwh", "price_eur_kwh", "x", "split"]

    assert features.feature_columns(Frame, "price_eur_mwh") == ["x"]
