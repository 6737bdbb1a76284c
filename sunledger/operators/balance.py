"""Hourly energy balance and its enriched fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.scalars import at_least_zero
from sunledger.operators.series import hour_key
from sunledger.operators.sizing import join_dimension

FACT_COLUMNS = (
    "asset_id",
    "ts_utc",
    "ts_local",
    "pv_power_kw",
    "load_kw",
    "direct_self_consumption_kw",
    "surplus_kw",
    "deficit_kw",
)
TARIFF_COLUMNS = ("retail_chf_per_kwh", "feed_in_chf_per_kwh", "grid_carbon_g_per_kwh")


def split_flows(df: DataFrame, pv: str = "pv_power_kw", load: str = "load_kw") -> DataFrame:
    """Add self-consumed, surplus and deficit power. A missing side makes all three follow null-skipping
    LEAST/GREATEST."""
    return df.withColumns(
        {
            "direct_self_consumption_kw": F.least(pv, load),
            "surplus_kw": at_least_zero(F.col(pv) - F.col(load)),
            "deficit_kw": at_least_zero(F.col(load) - F.col(pv)),
        }
    )


def energy_balance(pv: DataFrame, load: DataFrame) -> DataFrame:
    """PV and load on the same UTC hour. Both sides are unique on (asset_id, ts_utc), so the join key spreads
    a hot asset over all its hours. Sides stored in the same number of buckets are joined without a shuffle."""
    key = hour_key(pv, load)
    joined = pv.select(*key, "ts_local", "pv_power_kw").join(load.select(*key, "load_kw"), key)
    return split_flows(joined).select(*FACT_COLUMNS)


def asset_facts(balance: DataFrame, assets: DataFrame, n_assets: int | None = None) -> DataFrame:
    """Balance rows with tariff and carbon constants of their asset."""
    return join_dimension(balance, assets.select("asset_id", *TARIFF_COLUMNS), "asset_id", n_rows=n_assets).select(
        *FACT_COLUMNS, *TARIFF_COLUMNS
    )
