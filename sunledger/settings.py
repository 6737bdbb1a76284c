"""Default parameters. Every operator takes these as arguments; nothing reads them implicitly."""

from __future__ import annotations

# They must agree with published results.
ZONE = "Europe/Zurich"
FIRST_YEAR, LAST_YEAR = 2015, 2019
RETAIL_CHF_PER_KWH = 0.28
FEED_IN_CHF_PER_KWH = 0.08
GRID_CARBON_G_PER_KWH = 30.0
PV_PEAK_KWP = 100.0
ANNUAL_DEMAND_KWH = 500_000.0
BATTERY_CAPACITIES_KWH = (0, 50, 100, 150, 200)
BATTERY_COST_CHF_PER_KWH = 500.0

# Feature lags in rows of an hourly series, split lengths in months, hour bands (inclusive).
LAGS = (1, 24, 168)
TRAIN_MONTHS, VALIDATION_MONTHS, TEST_MONTHS = 48, 6, 6
PRICE_PEAK_HOURS = (8, 19)
PV_DAY_HOURS = (6, 20)
WINTER_MONTHS = (12, 1, 2)
SUMMER_MONTHS = (6, 7, 8)

# Boosted-tree settings and acceptance gates.
BOOST_ROUNDS = 500
TREE_DEPTH = 6
LEARNING_RATE = 0.05
ROW_SAMPLE = 0.8
COLUMN_SAMPLE = 0.8
SEED = 42
EARLY_STOP_ROUNDS = 50
# Rows of a partition of the frame trees are fitted on, beyond one partition per core.
FIT_ROWS_PER_PARTITION = 1_000_000
PRICE_GATE_FACTOR = 0.85

# Share of the expected hours that must be present, allowed yearly deviation from the target.
MIN_HOUR_SHARE = 0.98
ANNUAL_TOLERANCE_PCT = 5.0

# Accepted ranges by staged table and column (inclusive; nulls are not judged).
ACCEPTED_RANGES = {
    "stg_pvgis_hourly": {"pv_power_kw": (0, 120)},
    "stg_load_hourly": {"load_kw": (0, 300)},
    "stg_entsoe_prices": {"price_eur_mwh": (-500, 4000)},
    "stg_openmeteo_hourly": {"ghi_w_m2": (0, 1200), "cloud_pct": (0, 100)},
    "stg_entsoe_load_forecast": {"load_forecast_mw": (0, 20000)},
    "stg_entsoe_genmix": {"solar_share": (0, 1), "hydro_share": (0, 1), "nuclear_share": (0, 1)},
    "stg_battery_simulations": {
        "battery_capacity_kwh": (0, 200),
        "charge_kw": (0, 50),
        "discharge_kw": (0, 50),
        "soc_kwh": (0, 200),
        "grid_import_kw": (0, 350),
        "grid_export_kw": (0, 120),
    },
    "int_hourly_energy_balance": {
        "pv_power_kw": (0, 120),
        "load_kw": (0, 300),
        "direct_self_consumption_kw": (0, 120),
    },
    "int_price_features": {
        "price_eur_mwh": (-500, 4000),
        "ghi_w_m2": (0, 1200),
        "cloud_pct": (0, 100),
        "solar_share_lag24h": (0, 1),
        "hydro_share_lag24h": (0, 1),
        "nuclear_share_lag24h": (0, 1),
    },
    "int_pv_features": {"pv_power_kw": (0, 120), "ghi_w_m2": (0, 1200), "cloud_pct": (0, 100)},
    "fct_asset_performance": {
        "pv_power_kw": (0, 120),
        "load_kw": (0, 300),
        "direct_self_consumption_kw": (0, 120),
    },
    "fct_hourly_market": {"price_eur_mwh": (-500, 4000), "ghi_w_m2": (0, 1200), "cloud_pct": (0, 100)},
    "fct_pv_features": {"pv_power_kw": (0, 120), "ghi_w_m2": (0, 1200)},
    "fct_asset_performance_battery": {
        "battery_capacity_kwh": (0, 200),
        "on_site_pv_kw": (0, 120),
        "own_covered_load_kw": (0, 300),
    },
    "mrt_zev_kpis_daily": {"self_consumption_ratio": (0, 1), "autarky_ratio": (0, 1)},
    "mrt_zev_kpis_monthly": {"self_consumption_ratio": (0, 1), "autarky_ratio": (0, 1)},
    "mrt_zev_kpis_battery_daily": {"self_consumption_ratio": (0, 1), "autarky_ratio": (0, 1)},
    "mrt_zev_kpis_battery_monthly": {"self_consumption_ratio": (0, 1), "autarky_ratio": (0, 1)},
}

# Columns that must not be null, by table, and the tables with one row per key.
NOT_NULL = {
    "stg_pvgis_hourly": ("asset_id", "ts_utc", "ts_local", "pv_power_kw"),
    "stg_load_hourly": ("asset_id", "ts_utc", "ts_local", "load_kw"),
    "stg_entsoe_prices": ("asset_id", "ts_utc", "ts_local", "price_eur_mwh"),
    "stg_openmeteo_hourly": ("asset_id", "ts_utc", "ts_local", "ghi_w_m2", "temp_c", "cloud_pct", "wind_ms"),
    "stg_entsoe_load_forecast": ("asset_id", "ts_utc", "ts_local", "load_forecast_mw"),
    "stg_entsoe_genmix": (
        "asset_id",
        "ts_utc",
        "ts_local",
        "total_gen_mw",
        "solar_share",
        "hydro_share",
        "nuclear_share",
    ),
    "stg_battery_simulations": (
        "asset_id",
        "ts_utc",
        "battery_capacity_kwh",
        "ts_local",
        "charge_kw",
        "discharge_kw",
        "soc_kwh",
        "grid_import_kw",
        "grid_export_kw",
    ),
    "int_hourly_energy_balance": (
        "asset_id",
        "ts_utc",
        "ts_local",
        "pv_power_kw",
        "load_kw",
        "direct_self_consumption_kw",
        "surplus_kw",
        "deficit_kw",
    ),
    "int_price_features": ("asset_id", "ts_utc", "ts_local", "price_eur_mwh"),
    "int_pv_features": ("asset_id", "ts_utc", "ts_local", "pv_power_kw"),
    "fct_asset_performance": (
        "asset_id",
        "ts_utc",
        "ts_local",
        "pv_power_kw",
        "load_kw",
        "direct_self_consumption_kw",
    ),
    "fct_hourly_market": ("asset_id", "ts_utc", "ts_local", "price_eur_mwh"),
    "fct_pv_features": ("asset_id", "ts_utc", "ts_local", "pv_power_kw"),
    "fct_asset_performance_battery": (
        "asset_id",
        "ts_utc",
        "battery_capacity_kwh",
        "on_site_pv_kw",
        "own_covered_load_kw",
    ),
    "mrt_zev_kpis_daily": ("asset_id", "date", "self_consumption_ratio", "autarky_ratio"),
    "mrt_zev_kpis_monthly": ("asset_id", "month", "self_consumption_ratio", "autarky_ratio"),
    "mrt_zev_kpis_battery_daily": (
        "asset_id",
        "date",
        "battery_capacity_kwh",
        "self_consumption_ratio",
        "autarky_ratio",
    ),
    "mrt_zev_kpis_battery_monthly": (
        "asset_id",
        "month",
        "battery_capacity_kwh",
        "self_consumption_ratio",
        "autarky_ratio",
    ),
}
UNIQUE_KEYS = {
    **{
        name: ("asset_id", "ts_utc")
        for name in (
            "stg_pvgis_hourly",
            "stg_load_hourly",
            "stg_entsoe_prices",
            "stg_openmeteo_hourly",
            "stg_entsoe_load_forecast",
            "stg_entsoe_genmix",
            "int_hourly_energy_balance",
            "int_price_features",
            "int_pv_features",
            "fct_asset_performance",
            "fct_hourly_market",
            "fct_pv_features",
        )
    },
}

# Unit-error bounds on the raw series, before staging.
RAW_BOUNDS = {
    "pvgis_hourly": {"pv_power_kw": (0, 120)},
    "load_hourly": {"load_kw": (0, None)},
    "entsoe_prices": {"price_eur_mwh": (-500, 3000)},
    "openmeteo_hourly": {"ghi_w_m2": (0, 1500), "cloud_pct": (0, 100), "temp_c": (-50, 60)},
    "entsoe_load_forecast": {"load_forecast_mw": (0, 20000)},
    "entsoe_genmix": {"generation_mw": (-500, 20000)},
}

# Rows of one series that a task should order: longer series are cut into time ranges of about this many.
ROWS_PER_TASK = 5_000_000
