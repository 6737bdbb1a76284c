"""Battery economics from a dispatch table: flows across the meter, KPI marts, savings and payback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.scalars import per_thousand, ratio, safe_ratio
from sunledger.functions.timeops import local_date, month_start
from sunledger.operators.balance import TARIFF_COLUMNS
from sunledger.operators.rollups import exact_sum
from sunledger.settings import BATTERY_COST_CHF_PER_KWH

BATTERY_ENERGY = (
    "total_pv_kwh",
    "total_load_kwh",
    "self_consumption_kwh",
    "own_covered_load_kwh",
    "grid_import_kwh",
    "grid_export_kwh",
)


def border_flows(facts: DataFrame, dispatch: DataFrame) -> DataFrame:
    """Facts per (asset, hour, capacity) with what crosses the meter: PV kept on site, load covered by the site
    itself, and the hourly bill."""
    flows = dispatch.drop("ts_local")
    joined = facts.select(
        "asset_id", "ts_utc", "ts_local", "pv_power_kw", "load_kw", *TARIFF_COLUMNS
    ).join(flows, ["asset_id", "ts_utc"])
    paid = F.col("grid_import_kw") * F.col("retail_chf_per_kwh")
    earned = F.col("grid_export_kw") * F.col("feed_in_chf_per_kwh")
    return joined.withColumns(
        {
            "on_site_pv_kw": F.col("pv_power_kw") - F.col("grid_export_kw"),
            "own_covered_load_kw": F.col("load_kw") - F.col("grid_import_kw"),
            "hourly_net_chf": paid - earned,
        }
    )


def battery_daily(flows: DataFrame) -> DataFrame:
    """Daily KPIs per (asset, local day, capacity). CO2 avoided counts the load the site covered itself."""
    keys = ["asset_id", local_date("ts_local").alias("date"), "battery_capacity_kwh", "grid_carbon_g_per_kwh"]
    sums = flows.groupBy(*keys).agg(
        F.sum("pv_power_kw").alias("total_pv_kwh"),
        F.sum("load_kw").alias("total_load_kwh"),
        F.sum("on_site_pv_kw").alias("self_consumption_kwh"),
        F.sum("own_covered_load_kw").alias("own_covered_load_kwh"),
        F.sum("grid_import_kw").alias("grid_import_kwh"),
        F.sum("grid_export_kw").alias("grid_export_kwh"),
        F.sum("hourly_net_chf").alias("_net"),
    )
    return sums.select(
        "asset_id",
        "date",
        "battery_capacity_kwh",
        *BATTERY_ENERGY,
        safe_ratio("self_consumption_kwh", "total_pv_kwh").alias("self_consumption_ratio"),
        safe_ratio("own_covered_load_kwh", "total_load_kwh").alias("autarky_ratio"),
        F.round(per_thousand(F.col("own_covered_load_kwh") * F.col("grid_carbon_g_per_kwh")), 3).alias(
            "co2_avoided_kg"
        ),
        F.round("_net", 2).alias("net_chf_cost"),
    )


def battery_monthly(daily: DataFrame) -> DataFrame:
    """Monthly KPIs per (asset, month, capacity), ratios re-derived from the sums."""
    sums = daily.groupBy("asset_id", month_start("date").alias("month"), "battery_capacity_kwh").agg(
        *[F.sum(c).alias(c) for c in BATTERY_ENERGY],
        F.round(exact_sum("co2_avoided_kg", 3), 2).cast("double").alias("co2_avoided_kg"),
        exact_sum("net_chf_cost", 2).cast("double").alias("net_chf_cost"),
    )
    return sums.withColumns(
        {
            "self_consumption_ratio": ratio("self_consumption_kwh", "total_pv_kwh"),
            "autarky_ratio": ratio("own_covered_load_kwh", "total_load_kwh"),
        }
    )


def filter_capacity(monthly: DataFrame, capacity_kwh: float) -> DataFrame:
    """One battery size; the equality reaches the Parquet scan of a stored mart."""
    return monthly.where(F.col("battery_capacity_kwh") == F.lit(float(capacity_kwh)))


def capacity_comparison(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All months summed per capacity (and per `by`, e.g. asset_id)."""
    sums = monthly.groupBy(*by, "battery_capacity_kwh").agg(
        F.sum("total_pv_kwh").alias("total_pv_kwh"),
        F.sum("total_load_kwh").alias("total_load_kwh"),
        F.sum("self_consumption_kwh").alias("self_consumption_kwh"),
        F.sum("own_covered_load_kwh").alias("own_covered_load_kwh"),
        F.sum("net_chf_cost").alias("total_net_chf_cost"),
        F.sum("co2_avoided_kg").alias("total_co2_kg"),
    )
    return sums.withColumns(
        {
            "self_consumption_ratio": F.try_divide("self_consumption_kwh", "total_pv_kwh"),
            "autarky_ratio": F.try_divide("own_covered_load_kwh", "total_load_kwh"),
        }
    )


def capacity_savings(comparison: DataFrame, n_years: float = 5, by: Sequence[str] = ()) -> DataFrame:
    """Yearly savings and ratio gains against the same site without a battery.

    The window covers one row per simulated capacity, so its size does not grow with the hours behind it.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    no_battery = F.col("battery_capacity_kwh") == 0
    base = lambda c: F.max(F.when(no_battery, F.col(c))).over(group)
    return comparison.select(
        *by,
        "battery_capacity_kwh",
        (F.col("total_net_chf_cost") / F.lit(float(n_years))).alias("annual_cost_chf"),
        ((base("total_net_chf_cost") - F.col("total_net_chf_cost")) / F.lit(float(n_years))).alias(
            "annual_savings_chf"
        ),
        (F.col("self_consumption_ratio") - base("self_consumption_ratio")).alias("self_consumption_gain"),
        (F.col("autarky_ratio") - base("autarky_ratio")).alias("autarky_gain"),
    )


def capacity_payback(
    savings: DataFrame, cost_per_kwh: float = BATTERY_COST_CHF_PER_KWH, by: Sequence[str] = ()
) -> DataFrame:
    """Investment and simple payback per battery size; NULL where nothing is saved, no row without battery."""
    investment = F.col("battery_capacity_kwh") * F.lit(float(cost_per_kwh))
    saved = F.col("annual_savings_chf")
    return savings.where(F.col("battery_capacity_kwh") != 0).select(
        *by,
        "battery_capacity_kwh",
        investment.alias("investment_chf"),
        "annual_savings_chf",
        F.when(saved > 0, investment / saved).alias("payback_years"),
    )
