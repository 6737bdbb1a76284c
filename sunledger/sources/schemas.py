"""Declared schemas of the raw CSV tables, and the catalog of tables to load."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RawTable:
    """One raw table: CSV columns in file order (as DDL), required columns, key, whether repeated keys are expected, and
    whether each series of a file must be in the order of time."""

    name: str
    file: str
    schema: str
    required: tuple[str, ...]
    key: tuple[str, ...]
    duplicates_known: bool = False
    ordered: bool = True


# Raw table names, file names and CSV columns.
RAW_TABLES = {
    table.name: table
    for table in (
        RawTable(
            "pvgis_hourly",
            "pvgis_hourly.csv",
            (
                "asset_id STRING, lat DOUBLE, lon DOUBLE, peak_power_kwp DOUBLE, ts_local TIMESTAMP_NTZ, "
                "pv_power_kw DOUBLE, pv_power_w DOUBLE, irradiance_w_m2 DOUBLE, sun_height_deg DOUBLE, "
                "temp_2m_c DOUBLE, wind_speed_m_s DOUBLE, reconstruction_flag DOUBLE"
            ),
            ("pv_power_kw",),
            ("asset_id", "ts_local"),
        ),
        RawTable(
            "load_hourly",
            "load_hourly.csv",
            ("asset_id STRING, ts_utc TIMESTAMP, ts_local TIMESTAMP_NTZ, load_kw DOUBLE"),
            ("load_kw",),
            ("asset_id", "ts_utc"),
            duplicates_known=True,
        ),
        RawTable(
            "entsoe_prices",
            "entsoe_day_ahead_prices.csv",
            (
                "asset_id STRING, ts_utc TIMESTAMP, ts_local TIMESTAMP_NTZ, price_eur_mwh DOUBLE, "
                "price_eur_kwh DOUBLE"
            ),
            ("price_eur_mwh",),
            ("asset_id", "ts_utc"),
        ),
        RawTable(
            "openmeteo_hourly",
            "openmeteo_hourly.csv",
            (
                "asset_id STRING, ts_utc TIMESTAMP, ts_local TIMESTAMP_NTZ, ghi_w_m2 DOUBLE, temp_c DOUBLE, "
                "cloud_pct INT, wind_ms DOUBLE"
            ),
            ("ghi_w_m2", "temp_c"),
            ("asset_id", "ts_utc"),
        ),
        RawTable(
            "entsoe_load_forecast",
            "entsoe_load_forecast.csv",
            ("asset_id STRING, ts_utc TIMESTAMP, ts_local TIMESTAMP_NTZ, load_forecast_mw DOUBLE"),
            ("load_forecast_mw",),
            ("asset_id", "ts_utc"),
        ),
        RawTable(
            "entsoe_genmix",
            "entsoe_genmix.csv",
            (
                "asset_id STRING, ts_utc TIMESTAMP, ts_local TIMESTAMP_NTZ, gen_type STRING, generation_mw DOUBLE"
            ),
            ("generation_mw",),
            ("asset_id", "ts_utc"),
            duplicates_known=True,
            ordered=False,
        ),
    )
}

# Battery dispatch results come from outside this engine, as a table.
BATTERY_SCHEMA = (
    "asset_id STRING, ts_utc TIMESTAMP, battery_capacity_kwh DOUBLE, charge_kw DOUBLE, discharge_kw DOUBLE, "
    "soc_kwh DOUBLE, grid_import_kw DOUBLE, grid_export_kw DOUBLE"
)

# Fields of one record of the PV reply, and arrays of the weather reply.
PV_REPLY = (
    "outputs STRUCT<hourly: ARRAY<STRUCT<time: STRING, P: DOUBLE, `G(i)`: DOUBLE, H_sun: DOUBLE, T2m: DOUBLE, "
    "WS10m: DOUBLE, Int: DOUBLE>>>"
)
PV_RECORD_TIME = "yyyyMMdd:HHmm"
WEATHER_REPLY = (
    "hourly STRUCT<time: ARRAY<STRING>, shortwave_radiation: ARRAY<DOUBLE>, temperature_2m: ARRAY<DOUBLE>, "
    "cloud_cover: ARRAY<DOUBLE>, wind_speed_10m: ARRAY<DOUBLE>>"
)
