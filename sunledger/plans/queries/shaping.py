"""Projections, filters, scalar functions, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions import scalars, timeops
from sunledger.operators import balance, economics, evaluation, features, forecasting, staging
from sunledger.operators.balance import split_flows
from sunledger.operators.features import PV_LAGS
from sunledger.operators.rollups import filter_years as years_of
from sunledger.operators.rollups import kpi_daily, kpi_monthly
from sunledger.plans.bindings import Bindings
from sunledger.plans.oracle_text import GENMIX_SUMS, LINE_HOURS, local, share_of
from sunledger.plans.registry import query, rounded, rounds
from sunledger.sources.tables import scan_ordered


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, the way an untyped load would deliver them."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query("SELECT asset_id, ts_utc, ts_local, price_eur_mwh, price_eur_kwh FROM price_hourly")
def stg_prices(b: Bindings) -> DataFrame:
    return staging.stg_prices(as_text(b.price_hourly))


@query(
    "SELECT CAST(asset_id AS VARCHAR) AS asset_id, ts_utc, ts_local, load_forecast_mw FROM price_load_forecast"
)
def stg_load_forecast(b: Bindings) -> DataFrame:
    return staging.stg_load_forecast(as_text(b.price_load_forecast))


@query(
    """
SELECT CAST(asset_id AS VARCHAR) AS asset_id, ts_utc, ts_local, ghi_w_m2, temp_c, cloud_pct, wind_ms
FROM weather_hourly
"""
)
def stg_weather(b: Bindings) -> DataFrame:
    return staging.stg_weather(as_text(b.weather_hourly))


@query(
    """
SELECT CAST(asset_id AS VARCHAR) AS asset_id, ts_utc, ts_local, pv_power_kw, ghi_w_m2 AS irradiance_w_m2,
  temp_c AS sun_height_deg, wind_ms AS temp_2m_c, CAST(cloud_pct AS DOUBLE) AS wind_speed_m_s
FROM pv_hourly JOIN (SELECT * EXCLUDE (ts_local) FROM weather_hourly) AS w USING (asset_id, ts_utc)
"""
)
def stg_pv(b: Bindings) -> DataFrame:
    hours = b.pv_hourly.join(b.weather_hourly.drop("ts_local"), ["asset_id", "ts_utc"])
    raw = hours.select(
        "asset_id",
        (F.col("ts_utc").cast("timestamp_ntz") + F.expr("INTERVAL 10 MINUTES")).alias("ts_local"),
        "pv_power_kw",
        F.col("ghi_w_m2").alias("irradiance_w_m2"),
        F.col("temp_c").alias("sun_height_deg"),
        F.col("wind_ms").alias("temp_2m_c"),
        F.col("cloud_pct").alias("wind_speed_m_s"),
    )
    return staging.stg_pv(as_text(raw))


@query(f"SELECT o_orderkey, ts_utc, {local('ts_utc')} AS ts_local FROM order_rows")
def utc_to_local(b: Bindings) -> DataFrame:
    return b.order_series.select("o_orderkey", "ts_utc", timeops.utc_to_local("ts_utc").alias("ts_local"))


@query(
    """
SELECT o_orderkey, wall,
  CAST((wall AT TIME ZONE 'Europe/Zurich') AT TIME ZONE 'UTC' AS TIMESTAMP) AS ts_utc FROM order_rows
"""
)
def localize_wall_clock(b: Bindings) -> DataFrame:
    return b.order_rows.select("o_orderkey", "wall", timeops.localize_wall_clock("wall").alias("ts_utc"))


@query(
    """
SELECT o_orderkey, CAST(extract(hour FROM wall) AS INTEGER) AS hour_of_day,
  CAST(extract(doy FROM wall) AS INTEGER) AS day_of_year, CAST(extract(dow FROM wall) AS INTEGER) AS day_of_week
FROM order_rows
"""
)
def calendar_parts(b: Bindings) -> DataFrame:
    return b.order_rows.select(
        "o_orderkey",
        timeops.hour_of_day("wall").alias("hour_of_day"),
        timeops.day_of_year("wall").alias("day_of_year"),
        timeops.day_of_week("wall").alias("day_of_week"),
    )


@query(
    """
SELECT extract(dow FROM wall) IN (0, 6) AS is_weekend, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM order_rows GROUP BY 1
"""
)
def is_weekend(b: Bindings) -> DataFrame:
    flag = timeops.is_weekend(timeops.day_of_week("wall")).alias("is_weekend")
    return b.order_rows.groupBy(flag).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


HOLIDAY_SQL = """
SELECT asset_id, ts_utc, ts_local, h.holiday_date IS NOT NULL AS is_holiday FROM price_hourly
LEFT JOIN (SELECT DISTINCT holiday_date FROM holidays) AS h ON CAST(ts_local AS DATE) = h.holiday_date
"""


@query(HOLIDAY_SQL)
def holiday_join(b: Bindings) -> DataFrame:
    return features.holiday_join(b.price_hourly.select("asset_id", "ts_utc", "ts_local"), b.holidays)


@query(f"SELECT is_holiday, count(*) AS n FROM ({HOLIDAY_SQL}) AS flagged GROUP BY 1")
def is_holiday(b: Bindings) -> DataFrame:
    flagged = features.holiday_join(b.price_hourly.select("asset_id", "ts_utc", "ts_local"), b.holidays)
    return flagged.groupBy("is_holiday").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT asset_id, CAST(ts_local AS DATE) AS day, count(*) AS n FROM price_hourly GROUP BY 1, 2")
def cast_date(b: Bindings) -> DataFrame:
    return b.price_hourly.groupBy("asset_id", timeops.local_date("ts_local").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("SELECT asset_id, CAST(date_trunc('month', ts_local) AS DATE) AS month, count(*) AS n FROM price_hourly GROUP BY 1, 2")
def trunc_month(b: Bindings) -> DataFrame:
    month = timeops.month_start(timeops.local_date("ts_local")).alias("month")
    return b.price_hourly.groupBy("asset_id", month).agg(F.count(F.lit(1)).alias("n"))


FLOW_COLUMNS = "direct_self_consumption_kw surplus_kw deficit_kw"


@query(
    f"""
SELECT asset_id, ts_utc, {rounds(FLOW_COLUMNS, 2)} FROM supplier_facts
"""
)
def least_greatest_balance(b: Bindings) -> DataFrame:
    flows = balance.split_flows(b.supplier_hourly)
    return rounded(flows.select("asset_id", "ts_utc", *FLOW_COLUMNS.split()), 2)


@query(
    """
SELECT asset_id, ts_utc, 100.0::DOUBLE AS battery_capacity_kwh, ts_local,
  round(greatest(pv_power_kw - load_kw, 0.0::DOUBLE), 2) AS charge_kw,
  round(greatest(load_kw - pv_power_kw, 0.0::DOUBLE), 2) AS discharge_kw, round(greatest(pv_power_kw, 0), 2) AS soc_kwh,
  round(greatest(load_kw - 10.0::DOUBLE, 0.0::DOUBLE), 2) AS grid_import_kw,
  round(greatest(pv_power_kw - 10.0::DOUBLE, 0.0::DOUBLE), 2) AS grid_export_kw
FROM balance
"""
)
def clamp_noise(b: Bindings) -> DataFrame:
    """Dispatch columns that go below zero are floored by the battery staging."""
    gap = F.col("pv_power_kw") - F.col("load_kw")
    raw = b.balance.select(
        "asset_id",
        "ts_utc",
        F.lit(100.0).alias("battery_capacity_kwh"),
        gap.alias("charge_kw"),
        (-gap).alias("discharge_kw"),
        F.col("pv_power_kw").alias("soc_kwh"),
        (F.col("load_kw") - 10.0).alias("grid_import_kw"),
        (F.col("pv_power_kw") - 10.0).alias("grid_export_kw"),
    )
    return rounded(staging.stg_battery(raw), 2)


@query(
    """
SELECT asset_id, ts_utc, round(CASE WHEN pv_power_kw + load_kw > 0 THEN pv_power_kw / (pv_power_kw + load_kw)
  ELSE 0 END, 8) AS pv_share FROM supplier_hourly
"""
)
def safe_share(b: Bindings) -> DataFrame:
    share = scalars.safe_share("pv_power_kw", F.col("pv_power_kw") + F.col("load_kw"))
    return b.supplier_hourly.select("asset_id", "ts_utc", F.round(share, 8).alias("pv_share"))


@query(
    """
SELECT asset_id, ts_utc, round(coalesce(load_kw / nullif(pv_power_kw, 0), 0), 4) AS safe,
  round(load_kw / nullif(pv_power_kw, 0), 4) AS strict FROM supplier_hourly
"""
)
def safe_ratio(b: Bindings) -> DataFrame:
    return b.supplier_hourly.select(
        "asset_id",
        "ts_utc",
        scalars.safe_ratio("load_kw", "pv_power_kw").alias("safe"),
        scalars.ratio("load_kw", "pv_power_kw").alias("strict"),
    )


@query(
    """
SELECT p_partkey, trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '_') AS name,
  trim(regexp_replace(lower(trim(p_brand)), '[^a-z0-9]+', '_', 'g'), '_') AS brand FROM part
"""
)
def normalize_label(b: Bindings) -> DataFrame:
    return b.table("part").select(
        "p_partkey",
        scalars.normalize_label("p_name").alias("name"),
        scalars.normalize_label("p_brand").alias("brand"),
    )


@query("SELECT asset_id, ts_utc, round(price_eur_mwh / 1000.0::DOUBLE, 6) AS price_eur_kwh FROM price_hourly")
def unit_scale(b: Bindings) -> DataFrame:
    scaled = F.round(scalars.per_thousand("price_eur_mwh"), 6)
    return b.price_hourly.select("asset_id", "ts_utc", scaled.alias("price_eur_kwh"))


@query(
    """
SELECT asset_id, ts_utc, round(sum(generation_mw), 2) AS hydro_mw FROM genmix_long
WHERE gen_type LIKE 'hydro%' GROUP BY 1, 2
"""
)
def prefix_match(b: Bindings) -> DataFrame:
    return b.genmix_long.where(scalars.has_prefix("gen_type", "hydro")).groupBy("asset_id", "ts_utc").agg(
        F.round(F.sum("generation_mw"), 2).alias("hydro_mw")
    )


FORECAST_SQL = (
    "SELECT asset_id, ts_utc, ts_local, target, round(y_pred, 3) AS y_pred, y_true, model_version FROM price_blend"
)


@query(FORECAST_SQL)
def filter_target(b: Bindings) -> DataFrame:
    """One target out of a forecast table."""
    return rounded(evaluation.filter_target(b.forecasts, "price_eur_mwh"), 3)


@query(
    """
SELECT asset_id, ts_utc, ts_local, load_kw FROM load_hourly
WHERE CAST(ts_local AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-18'
"""
)
def filter_local_date_range(b: Bindings) -> DataFrame:
    return evaluation.filter_local_date_range(b.load_hourly, "2024-01-05", "2024-01-18")


@query(
    """
SELECT asset_id, ts_utc, ts_local, price_eur_mwh FROM price_hourly
WHERE ts_utc BETWEEN TIMESTAMP '1999-07-01 00:00:00' AND TIMESTAMP '1999-07-14 23:00:00'
"""
)
def filter_ts_range(b: Bindings) -> DataFrame:
    rows = b.price_hourly.select("asset_id", "ts_utc", "ts_local", "price_eur_mwh")
    return evaluation.filter_ts_range(rows, "1999-07-01 00:00:00", "1999-07-14 23:00:00")


@query(
    f"""
SELECT asset_id, month, {rounds('total_pv_kwh total_load_kwh', 2)}, self_consumption_ratio, autarky_ratio
FROM fleet_monthly WHERE year(month) IN (1996, 1999)
"""
)
def filter_years(b: Bindings) -> DataFrame:
    monthly = kpi_monthly(kpi_daily(split_flows(b.supplier_hourly), b.supplier_assets))
    columns = ["asset_id", "month", "total_pv_kwh", "total_load_kwh", "self_consumption_ratio", "autarky_ratio"]
    ratios = ("self_consumption_ratio", "autarky_ratio")
    chosen = years_of(monthly, [1996, 1999]).select(*columns)
    return chosen.withColumns({c: F.round(c, 2) for c in columns[2:] if c not in ratios})


BATTERY_SUMS = (
    "total_pv_kwh total_load_kwh self_consumption_kwh own_covered_load_kwh grid_import_kwh grid_export_kwh"
)


@query(
    f"""
SELECT asset_id, month, battery_capacity_kwh, {rounds(BATTERY_SUMS, 4)}, self_consumption_ratio, autarky_ratio,
  co2_avoided_kg, net_chf_cost FROM battery_monthly WHERE battery_capacity_kwh = 100
"""
)
def filter_capacity(b: Bindings) -> DataFrame:
    monthly = economics.battery_monthly(economics.battery_daily(b.battery_flows))
    return rounded(economics.filter_capacity(monthly, 100), 4)


@query(
    """
SELECT season, count(*) AS n, round(sum(price_eur_mwh), 2) AS total FROM (
  SELECT CASE WHEN month(ts_local) IN (12, 1, 2) THEN 'winter' WHEN month(ts_local) IN (6, 7, 8) THEN 'summer' END
    AS season, price_eur_mwh FROM price_hourly) AS seasons WHERE season IS NOT NULL GROUP BY 1
"""
)
def filter_season(b: Bindings) -> DataFrame:
    rows = b.price_hourly.select(timeops.season("ts_local").alias("season"), "price_eur_mwh")
    return rows.where(F.col("season").isNotNull()).groupBy("season").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price_eur_mwh"), 2).alias("total")
    )


@query(
    """
SELECT asset_id, extract(hour FROM ts_local) BETWEEN 8 AND 19 AS is_peak,
  extract(hour FROM ts_local) BETWEEN 6 AND 20 AS is_day, count(*) AS n FROM price_hourly GROUP BY 1, 2, 3
"""
)
def hour_band(b: Bindings) -> DataFrame:
    hour = timeops.hour_of_day("ts_local")
    bands = [timeops.in_hours(hour, (8, 19)).alias("is_peak"), timeops.in_hours(hour, (6, 20)).alias("is_day")]
    return b.price_hourly.groupBy("asset_id", *bands).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
SELECT asset_id, ts_utc, round(greatest(pv_power_kw - load_kw, 0.0::DOUBLE), 2) AS y_pred FROM supplier_hourly
"""
)
def clip_nonnegative(b: Bindings) -> DataFrame:
    raw = F.col("pv_power_kw") - F.col("load_kw")
    return b.supplier_hourly.select(
        "asset_id", "ts_utc", F.round(scalars.at_least_zero(raw), 2).alias("y_pred")
    )


# ---- joins
BALANCE_SQL = f"""
SELECT asset_id, ts_utc, ts_local, pv_power_kw, load_kw, {rounds(FLOW_COLUMNS, 2)} FROM balance
"""


@query(BALANCE_SQL)
def energy_balance(b: Bindings) -> DataFrame:
    return rounded(b.balance, 2)


@query(BALANCE_SQL)
def energy_balance_bucketed(b: Bindings) -> DataFrame:
    """The same from series stored in buckets of (asset, year): no shuffle is left."""
    return rounded(balance.energy_balance(*b.bucketed(b.pv_hourly, b.load_hourly)), 2)


@query(
    f"""
SELECT asset_id, ts_utc, ts_local, pv_power_kw, load_kw, {rounds(FLOW_COLUMNS, 2)},
  {rounds('retail_chf_per_kwh feed_in_chf_per_kwh grid_carbon_g_per_kwh', 7)} FROM facts
"""
)
def asset_facts(b: Bindings) -> DataFrame:
    return b.facts.withColumns(
        {
            **{c: F.round(c, 2) for c in FLOW_COLUMNS.split()},
            **{c: F.round(c, 7) for c in balance.TARIFF_COLUMNS},
        }
    )


@query(
    """
SELECT p.asset_id, p.ts_utc, p.ts_local, p.pv_power_kw, ghi_w_m2, temp_c, cloud_pct, wind_ms
FROM supplier_hourly p LEFT JOIN supplier_weather w ON p.asset_id = w.asset_id AND p.ts_utc = w.ts_utc
"""
)
def pv_weather_join(b: Bindings) -> DataFrame:
    return features.pv_weather_join(
        b.supplier_hourly.select("asset_id", "ts_utc", "ts_local", "pv_power_kw"), b.supplier_weather
    )


ENRICHED_SQL = f"""
SELECT p.asset_id, p.ts_utc, p.price_eur_mwh, ghi_w_m2, temp_c, cloud_pct, wind_ms, load_forecast_mw,
  {rounds('solar_share hydro_share nuclear_share', 8)}, round(total_gen_mw, 2) AS total_gen_mw
FROM price_hourly p
LEFT JOIN price_weather w ON p.asset_id = w.asset_id AND p.ts_utc = w.ts_utc
LEFT JOIN price_load_forecast f ON p.asset_id = f.asset_id AND p.ts_utc = f.ts_utc
LEFT JOIN price_genmix g ON p.asset_id = g.asset_id AND p.ts_utc = g.ts_utc
"""


@query(ENRICHED_SQL)
def price_enrich_join(b: Bindings) -> DataFrame:
    prices = b.price_hourly.select("asset_id", "ts_utc", "price_eur_mwh")
    enriched = features.price_enrich_join(prices, b.price_weather, b.price_load_forecast, b.price_genmix)
    shares = {c: F.round(c, 8) for c in ("solar_share", "hydro_share", "nuclear_share")}
    return enriched.withColumns({**shares, "total_gen_mw": F.round("total_gen_mw", 2)})


@query(
    """
SELECT b.asset_id, b.ts_utc, b.ts_local, round(y_pred, 3) AS forecast, y_true AS actual,
  price_lag_168h AS seasonal_naive
FROM price_blend b LEFT JOIN price_features p ON b.asset_id = p.asset_id AND b.ts_utc = p.ts_utc
"""
)
def forecast_vs_seasonal(b: Bindings) -> DataFrame:
    return rounded(evaluation.forecast_vs_seasonal(b.forecasts, b.price_features), 3)


@query(
    f"""
SELECT asset_id, ts_utc, {local('ts_utc')} AS ts_local, round(day * 0.5::DOUBLE + week * 0.5::DOUBLE, 3) AS forecast, actual, day AS persistence
FROM (
  SELECT *, datediff('month', min(ts_utc) OVER (), ts_utc) AS age FROM (
    SELECT CAST(l_suppkey AS VARCHAR) AS asset_id, ts_utc, pv AS actual, lag(pv, 24) OVER series AS day, lag(pv, 168) OVER series AS week
    FROM ({LINE_HOURS}) AS hours WINDOW series AS (PARTITION BY l_suppkey ORDER BY ts_utc)
  ) AS lagged WHERE week IS NOT NULL
) AS aged WHERE age BETWEEN 54 AND 59
"""
)
def forecast_vs_persistence(b: Bindings) -> DataFrame:
    """Of forecasts of both targets those of PV, next to the stored mart's lag; the mart is read, not made, three times."""
    pv = b.blend(forecasting.chronological_split(scan_ordered(b.pv_mart, PV_LAGS)), "pv_power_kw", "pv")
    return rounded(evaluation.forecast_vs_persistence(forecasting.stack_forecasts(b.price_blend, pv), b.pv_mart), 3)


@query(
    """
SELECT asset_id, ts_utc, ts_local, target, round(y_pred, 3) AS y_pred, y_true, model_version, lag_24h, lag_168h,
  hour_of_day FROM price_attached
"""
)
def attach_baselines(b: Bindings) -> DataFrame:
    return rounded(evaluation.attach_baselines(b.price_blend, b.price_features, "price"), 3)


# ---- pivot of the long generation table
@query(
    f"""
SELECT asset_id, ts_utc, ts_local, {rounds('solar_mw hydro_mw nuclear_mw gas_mw wind_mw total_gen_mw', 2)},
  {", ".join(f"round({share_of(c)}, 8) AS {c}_share" for c in ("solar", "hydro", "nuclear"))}
FROM (SELECT asset_id, ts_utc, ts_local, {GENMIX_SUMS} FROM genmix_long GROUP BY 1, 2, 3) AS summed
"""
)
def genmix_pivot(b: Bindings) -> DataFrame:
    pivoted = staging.genmix_pivot(b.genmix_long)
    return pivoted.withColumns(
        {c: F.round(c, 8 if c.endswith("_share") else 2) for c in pivoted.columns if c[-3:] in ("_mw", "are")}
    )


@query(
    """
SELECT asset_id, ts_utc, gen_type, round(sum(generation_mw), 2) AS generation_mw FROM genmix_long GROUP BY 1, 2, 3
"""
)
def sort_long(b: Bindings) -> DataFrame:
    long = b.genmix_long.groupBy("asset_id", "ts_utc", "gen_type").agg(
        F.round(F.sum("generation_mw"), 2).alias("generation_mw")
    )
    return long.orderBy("ts_utc", "gen_type", "asset_id")
