"""Raw tables to typed, keyed series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.scalars import at_least_zero, has_prefix, safe_share
from sunledger.functions.timeops import floor_hour, utc_to_local
from sunledger.settings import ZONE


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _clock() -> list[Column]:
    return [
        F.col("asset_id"),
        F.col("ts_utc").cast("timestamp").alias("ts_utc"),
        F.col("ts_local").cast("timestamp_ntz").alias("ts_local"),
    ]


def stg_prices(raw: DataFrame) -> DataFrame:
    return raw.select(*_clock(), _double("price_eur_mwh"), _double("price_eur_kwh"))


def stg_load_forecast(raw: DataFrame) -> DataFrame:
    return raw.select(*_clock(), _double("load_forecast_mw"))


def stg_weather(raw: DataFrame) -> DataFrame:
    cloud = F.col("cloud_pct").cast("int").alias("cloud_pct")
    return raw.select(*_clock(), _double("ghi_w_m2"), _double("temp_c"), cloud, _double("wind_ms"))


def stg_pv(raw: DataFrame, zone: str = ZONE) -> DataFrame:
    """PV series: the raw `ts_local` is in fact UTC, stamped some minutes into the hour."""
    hour = floor_hour(F.col("ts_local").cast("timestamp_ntz"))
    return raw.select(
        "asset_id",
        hour.alias("ts_utc"),
        utc_to_local(hour, zone).alias("ts_local"),
        *[_double(c) for c in ("pv_power_kw", "irradiance_w_m2", "sun_height_deg", "temp_2m_c", "wind_speed_m_s")],
    )


def dedupe_avg(raw: DataFrame, value: str = "load_kw") -> DataFrame:
    """Load series with repeated (asset, hour) rows averaged.

    Partial sums leave the map side, so a hot asset costs no more than its number of distinct hours. The wall clock
    follows from the instant; carrying it as an aggregate leaves the result partitioned by (asset_id, ts_utc), the
    key of the joins that come next.
    """
    typed = raw.select(*_clock(), _double(value))
    return typed.groupBy("asset_id", "ts_utc").agg(F.min("ts_local").alias("ts_local"), F.avg(value).alias(value))


def genmix_pivot(long: DataFrame) -> DataFrame:
    """Generation mix: one row per (asset, hour) with MW per group, total and shares; partitioned like
    `dedupe_avg`."""
    typed = long.select(*_clock(), "gen_type", _double("generation_mw"))
    mw, kind = F.col("generation_mw"), F.col("gen_type")

    def total_of(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, mw).otherwise(F.lit(0.0))).alias(name)

    wide = typed.groupBy("asset_id", "ts_utc").agg(
        F.min("ts_local").alias("ts_local"),
        total_of(kind == "solar", "solar_mw"),
        total_of(has_prefix(kind, "hydro"), "hydro_mw"),
        total_of(kind == "nuclear", "nuclear_mw"),
        total_of(kind == "fossil_gas", "gas_mw"),
        total_of(kind == "wind_onshore", "wind_mw"),
        F.sum(mw).alias("total_gen_mw"),
    )
    return wide.withColumns(
        {f"{c}_share": safe_share(f"{c}_mw", "total_gen_mw") for c in ("solar", "hydro", "nuclear")}
    )


def stg_battery(raw: DataFrame, zone: str = ZONE) -> DataFrame:
    """Battery dispatch: solver noise below zero is floored, local time is derived."""
    flows = ("charge_kw", "discharge_kw", "soc_kwh", "grid_import_kw", "grid_export_kw")
    ts = F.col("ts_utc").cast("timestamp")
    return raw.select(
        "asset_id",
        ts.alias("ts_utc"),
        utc_to_local(ts, zone).alias("ts_local"),
        _double("battery_capacity_kwh"),
        *[at_least_zero(F.col(c).cast("double")).alias(c) for c in flows],
    )
