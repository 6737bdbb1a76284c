"""KPI marts, series rollups, battery economics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.operators import economics, rollups, staging
from sunledger.operators.balance import split_flows
from sunledger.operators.medians import selected_median
from sunledger.plans.bindings import Bindings
from sunledger.plans.queries.shaping import BATTERY_SUMS
from sunledger.plans.registry import query, rounded, rounds
from sunledger.session import scratch_path
from sunledger.sources.tables import read_year_folders

KPI_SUMS = "total_pv_kwh total_load_kwh self_consumption_kwh surplus_kwh deficit_kwh"
KPI_REST = "self_consumption_ratio, autarky_ratio, co2_avoided_kg, chf_saved"


@query("SELECT asset_id, ts_utc, ts_local, round(avg(load_kw), 8) AS load_kw FROM load_raw GROUP BY 1, 2, 3")
def dedupe_avg(b: Bindings) -> DataFrame:
    return rounded(staging.dedupe_avg(b.load_raw), 8)


@query(f"SELECT asset_id, date, {rounds(KPI_SUMS, 4)}, {KPI_REST} FROM daily")
def kpi_daily(b: Bindings) -> DataFrame:
    return rounded(rollups.kpi_daily(b.facts), 4)


@query(f"SELECT asset_id, month, {rounds(KPI_SUMS, 4)}, {KPI_REST} FROM monthly")
def kpi_monthly(b: Bindings) -> DataFrame:
    return rounded(rollups.kpi_monthly(rollups.kpi_daily(b.facts)), 4)


def fleet_daily(b: Bindings) -> DataFrame:
    return rollups.kpi_daily(split_flows(b.supplier_hourly), b.supplier_assets)


def fleet_monthly(b: Bindings) -> DataFrame:
    return rollups.kpi_monthly(fleet_daily(b))


@query(
    f"""
SELECT asset_id, date, {rounds(KPI_SUMS, 2)}, {KPI_REST} FROM fleet_daily
"""
)
def kpi_daily_fleet(b: Bindings) -> DataFrame:
    return fleet_daily(b).withColumns({c: F.round(c, 2) for c in KPI_SUMS.split()})


@query(
    f"""
SELECT asset_id, month, {rounds(KPI_SUMS, 2)}, self_consumption_ratio, autarky_ratio, co2_avoided_kg, chf_saved
FROM fleet_monthly
"""
)
def kpi_monthly_fleet(b: Bindings) -> DataFrame:
    return fleet_monthly(b).withColumns({c: F.round(c, 2) for c in KPI_SUMS.split()})


@query(
    """
SELECT round(avg(self_consumption_ratio), 6) AS avg_sc_ratio, round(avg(autarky_ratio), 6) AS avg_autarky,
  round(sum(co2_avoided_kg) / 1000, 6) AS total_co2_t, round(sum(chf_saved) / 5, 4) AS avg_chf_yr FROM fleet_monthly
"""
)
def kpi_overview(b: Bindings) -> DataFrame:
    overview = rollups.kpi_overview(fleet_monthly(b), n_years=5)
    digits = {"avg_sc_ratio": 6, "avg_autarky": 6, "total_co2_t": 6, "avg_chf_yr": 4}
    return overview.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    """
SELECT asset_id, month, round(self_consumption_kwh / 1000, 5) AS self_consumed_mwh,
  round(deficit_kwh / 1000, 5) AS grid_import_mwh, round(surplus_kwh / 1000, 5) AS exported_mwh,
  round(self_consumption_ratio * 100, 2) AS self_consumption_pct, round(autarky_ratio * 100, 2) AS autarky_pct,
  co2_avoided_kg, chf_saved FROM fleet_monthly
"""
)
def kpi_monthly_report(b: Bindings) -> DataFrame:
    report = rollups.kpi_monthly_report(fleet_monthly(b))
    return report.withColumns(
        {
            **{c: F.round(c, 5) for c in ("self_consumed_mwh", "grid_import_mwh", "exported_mwh")},
            **{c: F.round(c, 2) for c in ("self_consumption_pct", "autarky_pct")},
        }
    )


@query(f"SELECT asset_id, month, {rounds(KPI_SUMS, 2)}, {KPI_REST} FROM fleet_monthly")
def order_output(b: Bindings) -> DataFrame:
    ordered = fleet_monthly(b).orderBy("month", "asset_id")
    return ordered.withColumns({c: F.round(c, 2) for c in KPI_SUMS.split()})


@query(
    """
SELECT asset_id, date_trunc('hour', stamp) AS stamp, round(avg(value), 8) AS value FROM event_rows GROUP BY 1, 2
"""
)
def resample_hourly(b: Bindings) -> DataFrame:
    return rounded(rollups.resample_hourly(b.event_rows, "value", ts="stamp"), 8)


@query(
    """
SELECT asset_id, CAST(ts_local AS DATE) AS date, round(avg(load_kw), 6) AS mean_load_kw FROM load_hourly GROUP BY 1, 2
"""
)
def daily_mean(b: Bindings) -> DataFrame:
    return rounded(rollups.daily_mean(b.load_hourly, "load_kw"), 6)


@query(
    """
SELECT season, hour, round(median(price_eur_mwh), 4) AS median_price_eur_mwh FROM (
  SELECT CASE WHEN month(ts_local) IN (12, 1, 2) THEN 'winter' WHEN month(ts_local) IN (6, 7, 8) THEN 'summer' END
    AS season, CAST(extract(hour FROM ts_local) AS INTEGER) AS hour, price_eur_mwh FROM price_hourly) AS seasons
WHERE season IS NOT NULL GROUP BY 1, 2
"""
)
def hourly_shape_median(b: Bindings) -> DataFrame:
    return rounded(rollups.hourly_shape_median(b.price_hourly, "price_eur_mwh"), 4)


@query(
    """
SELECT asset_id, CAST(date_trunc('month', ts_local) AS DATE) AS month, round(sum(load_kw) / 1000, 5) AS energy_mwh
FROM supplier_hourly GROUP BY 1, 2
"""
)
def monthly_energy(b: Bindings) -> DataFrame:
    return rounded(rollups.monthly_energy(b.supplier_hourly, "load_kw"), 5)


@query(
    """
SELECT asset_id, year(ts_local) AS year, round(sum(load_kw), 2) AS total_kwh,
  round((sum(load_kw) - 500000) / 500000 * 100, 6) AS deviation_pct FROM supplier_hourly GROUP BY 1, 2
"""
)
def annual_total(b: Bindings) -> DataFrame:
    totals = rollups.annual_total(b.supplier_hourly, "load_kw", target_kwh=500_000.0)
    return totals.select(
        "asset_id",
        F.col("year").cast("long").alias("year"),
        F.round("total_kwh", 2).alias("total_kwh"),
        F.round("deviation_pct", 6).alias("deviation_pct"),
    )


@query(
    """
SELECT asset_id, ts_utc, round(load_kw * 500000.0::DOUBLE / sum(load_kw) OVER (PARTITION BY asset_id, year(ts_local)), 6)
  AS load_kw FROM load_hourly
"""
)
def scale_to_annual_total(b: Bindings) -> DataFrame:
    scaled = rollups.scale_to_annual_total(b.load_hourly, "load_kw", 500_000.0)
    return rounded(scaled.select("asset_id", "ts_utc", "load_kw"), 6)


@query(
    """
SELECT 'timestamp' AS kind, CAST(count(DISTINCT ts_utc) AS VARCHAR) AS entry FROM genmix_long
UNION ALL SELECT DISTINCT 'label', gen_type FROM genmix_long
UNION ALL SELECT DISTINCT 'year', CAST(year(ts_utc) AS VARCHAR) FROM genmix_long
"""
)
def distinct_series(b: Bindings) -> DataFrame:
    return rollups.distinct_series(b.genmix_long)


@query(
    """
SELECT asset_id, min(ts_utc) AS first_ts, max(ts_utc) AS last_ts, count(price_eur_mwh) AS n,
  min(price_eur_mwh) AS min_value, max(price_eur_mwh) AS max_value, round(avg(price_eur_mwh), 5) AS mean_value,
  round(median(price_eur_mwh), 4) AS median_value FROM price_hourly GROUP BY 1
"""
)
def series_summary(b: Bindings) -> DataFrame:
    summary = rollups.series_summary(b.price_hourly, "price_eur_mwh")
    return summary.withColumns({"mean_value": F.round("mean_value", 5), "median_value": F.round("median_value", 4)})


@query(
    """
SELECT asset_id, min(ts_utc) AS first_ts, max(ts_utc) AS last_ts, count(load_kw) AS n, min(load_kw) AS min_value,
  max(load_kw) AS max_value, round(avg(load_kw), 5) AS mean_value, round(median(load_kw), 4) AS median_value
FROM supplier_hourly GROUP BY 1
"""
)
def series_summary_fleet(b: Bindings) -> DataFrame:
    """Many series, with a third of all values equal to zero."""
    summary = rollups.series_summary(b.supplier_hourly, "load_kw")
    return summary.withColumns({"mean_value": F.round("mean_value", 5), "median_value": F.round("median_value", 4)})


@query(
    """
SELECT asset_id, round(median(load_kw), 4) AS median_load_kw FROM supplier_hourly GROUP BY 1
"""
)
def median_large_groups(b: Bindings) -> DataFrame:
    """The path for groups too large for one task; a third of all values is the same."""
    return rounded(selected_median(b.supplier_hourly, ["asset_id"], "load_kw", "median_load_kw", values_per_task=100), 4)


@query(
    """
SELECT gen_type, round(avg(generation_mw), 8) AS mean_mw, max(generation_mw) AS max_mw, count(generation_mw) AS n_rows
FROM genmix_long GROUP BY 1
"""
)
def summary_by_type(b: Bindings) -> DataFrame:
    return rounded(rollups.summary_by_type(b.genmix_long), 8)


@query(
    """
SELECT year(ts_local) AS year, asset_id, ts_utc, price_eur_mwh, CASE WHEN year(ts_local) >= 1995 THEN price_eur_kwh END AS price_eur_kwh
FROM price_hourly
"""
)
def concat_years(b: Bindings) -> DataFrame:
    """Prices stored in a folder for each year, of which the older ones lack a column, united."""
    path, columns = scratch_path(b.spark, "prices-by-year"), ["asset_id", "ts_utc", "price_eur_mwh", "price_eur_kwh"]
    dated = b.price_hourly.select(*columns, F.year("ts_local").alias("year"))
    write = lambda rows: rows.write.mode("append").partitionBy("year").parquet(path)
    write(dated.where("year >= 1995 OR year IS NULL"))
    write(dated.where("year < 1995").drop("price_eur_kwh"))
    empty = {None: b.spark.createDataFrame([], dated.drop("year").schema)}
    return rollups.concat_years(read_year_folders(b.spark, path) or empty).select("year", *columns)


# ---- battery economics
@query(
    """
SELECT asset_id, ts_utc, ts_local, battery_capacity_kwh, round(on_site_pv_kw, 6) AS on_site_pv_kw,
  round(own_covered_load_kw, 6) AS own_covered_load_kw, round(hourly_net_chf, 6) AS hourly_net_chf FROM battery_flows
"""
)
def border_flows(b: Bindings) -> DataFrame:
    columns = [
        "asset_id", "ts_utc", "ts_local", "battery_capacity_kwh", "on_site_pv_kw", "own_covered_load_kw",
        "hourly_net_chf",
    ]
    return rounded(b.battery_flows.select(*columns), 6)


@query(
    f"""
SELECT asset_id, date, battery_capacity_kwh, {rounds(BATTERY_SUMS, 5)}, self_consumption_ratio, autarky_ratio,
  co2_avoided_kg, net_chf_cost FROM battery_daily
"""
)
def battery_daily(b: Bindings) -> DataFrame:
    return rounded(economics.battery_daily(b.battery_flows), 5)


def _battery_monthly(b: Bindings) -> DataFrame:
    return economics.battery_monthly(economics.battery_daily(b.battery_flows))


@query(
    f"""
SELECT asset_id, month, battery_capacity_kwh, {rounds(BATTERY_SUMS, 4)}, self_consumption_ratio, autarky_ratio,
  co2_avoided_kg, net_chf_cost FROM battery_monthly
"""
)
def battery_monthly(b: Bindings) -> DataFrame:
    return rounded(_battery_monthly(b), 4)


@query(
    """
SELECT battery_capacity_kwh, round(total_pv_kwh, 4) AS total_pv_kwh, round(total_load_kwh, 4) AS total_load_kwh,
  round(self_consumption_kwh, 4) AS self_consumption_kwh, round(own_covered_load_kwh, 4) AS own_covered_load_kwh,
  round(total_net_chf_cost, 4) AS total_net_chf_cost, round(total_co2_kg, 4) AS total_co2_kg,
  round(self_consumption_ratio, 6) AS self_consumption_ratio, round(autarky_ratio, 6) AS autarky_ratio FROM comparison
"""
)
def capacity_comparison(b: Bindings) -> DataFrame:
    table = economics.capacity_comparison(_battery_monthly(b))
    ratios = ("self_consumption_ratio", "autarky_ratio")
    skip = (*ratios, "battery_capacity_kwh")
    return table.withColumns(
        {**{c: F.round(c, 6) for c in ratios}, **{c: F.round(c, 4) for c in table.columns if c not in skip}}
    )


@query(
    f"""
SELECT battery_capacity_kwh, {rounds('annual_cost_chf annual_savings_chf', 4)},
  {rounds('self_consumption_gain autarky_gain', 6)} FROM savings
"""
)
def capacity_savings(b: Bindings) -> DataFrame:
    savings = economics.capacity_savings(economics.capacity_comparison(_battery_monthly(b)))
    return savings.withColumns(
        {
            **{c: F.round(c, 4) for c in ("annual_cost_chf", "annual_savings_chf")},
            **{c: F.round(c, 6) for c in ("self_consumption_gain", "autarky_gain")},
        }
    )


@query(
    """
SELECT battery_capacity_kwh, battery_capacity_kwh * 500 AS investment_chf,
  round(annual_savings_chf, 4) AS annual_savings_chf,
  round(CASE WHEN annual_savings_chf > 0 THEN battery_capacity_kwh * 500 / annual_savings_chf END, 4) AS payback_years
FROM savings WHERE battery_capacity_kwh <> 0
"""
)
def capacity_payback(b: Bindings) -> DataFrame:
    comparison = economics.capacity_comparison(_battery_monthly(b))
    payback = economics.capacity_payback(economics.capacity_savings(comparison))
    return payback.withColumns({c: F.round(c, 4) for c in ("annual_savings_chf", "payback_years")})
