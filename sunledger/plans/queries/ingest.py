"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.operators.evaluation import attach_baselines, error_metrics_by_split
from sunledger.operators.features import PRICE_LAGS, PV_LAGS
from sunledger.operators.forecasting import chronological_split
from sunledger.plans.bindings import GEN_TYPES, Bindings
from sunledger.plans.registry import query, rounded, rounds
from sunledger.session import scratch_path
from sunledger.sources import payloads, sinks
from sunledger.sources.schemas import RAW_TABLES
from sunledger.sources.tables import raw_catalog as catalog_report
from sunledger.sources.tables import read_raw_csv as read_csv
from sunledger.sources.tables import replace_table as replace
from sunledger.sources.tables import scan_ordered as scan


@query("SELECT CAST(asset_id AS VARCHAR) AS asset_id, ts_utc, ts_local, load_kw FROM load_hourly")
def read_raw_csv(b: Bindings) -> DataFrame:
    path = scratch_path(b.spark, "load-csv")
    sinks.write_csv(b.load_hourly.select("asset_id", "ts_utc", "ts_local", "load_kw"), path)
    return read_csv(b.spark, path, RAW_TABLES["load_hourly"].schema)


@query(
    """
SELECT 'pvgis_hourly' AS table_name, 'pv_power_kw' AS column_name, count(*) AS n_rows,
  count(*) FILTER (pv_power_kw IS NULL) AS n_nulls FROM pv_hourly
UNION ALL SELECT 'load_hourly', 'load_kw', count(*), count(*) FILTER (load_kw IS NULL) FROM load_raw
UNION ALL SELECT 'entsoe_prices', 'price_eur_mwh', count(*), count(*) FILTER (price_eur_mwh IS NULL) FROM price_hourly
UNION ALL SELECT 'openmeteo_hourly', 'ghi_w_m2', count(*), count(*) FILTER (ghi_w_m2 IS NULL) FROM weather_hourly
UNION ALL SELECT 'openmeteo_hourly', 'temp_c', count(*), count(*) FILTER (temp_c IS NULL) FROM weather_hourly
UNION ALL SELECT 'entsoe_load_forecast', 'load_forecast_mw', count(*),
  count(*) FILTER (load_forecast_mw IS NULL) FROM price_load_forecast
UNION ALL SELECT 'entsoe_genmix', 'generation_mw', count(*), count(*) FILTER (generation_mw IS NULL) FROM genmix_long
"""
)
def raw_catalog(b: Bindings) -> DataFrame:
    return catalog_report(
        {
            "pvgis_hourly": b.pv_hourly,
            "load_hourly": b.load_raw,
            "entsoe_prices": b.price_hourly,
            "openmeteo_hourly": b.weather_hourly,
            "entsoe_load_forecast": b.price_load_forecast,
            "entsoe_genmix": b.genmix_long,
        }
    )


@query("SELECT asset_id, ts_utc, ts_local, pv_power_kw, load_kw FROM supplier_hourly")
def replace_table(b: Bindings) -> DataFrame:
    path = scratch_path(b.spark, "supplier")
    table = b.supplier_hourly.withColumn("year", F.year("ts_utc"))
    replace(table, path, partition_by=["year"], sort_by=["asset_id", "ts_utc"])
    return b.spark.read.parquet(path).drop("year")


@query(
    """
SELECT asset_id, ts_utc + INTERVAL 10 MINUTE AS ts_local, 47.0::DOUBLE AS lat, 8.0::DOUBLE AS lon,
  100.0::DOUBLE AS peak_power_kwp, round(pv_power_kw, 4) AS pv_power_kw, round(pv_power_kw * 1000, 1) AS pv_power_w,
  ghi_w_m2 AS irradiance_w_m2, temp_c AS sun_height_deg, wind_ms AS temp_2m_c,
  CAST(cloud_pct AS DOUBLE) AS wind_speed_m_s, 0.0::DOUBLE AS reconstruction_flag
FROM pv_hourly JOIN weather_hourly USING (asset_id, ts_utc)
"""
)
def explode_records(b: Bindings) -> DataFrame:
    """Replies are rebuilt as JSON text, one per asset and day, then parsed back into rows."""
    hours = b.pv_hourly.join(b.weather_hourly.drop("ts_local"), ["asset_id", "ts_utc"])
    stamp = F.date_format(F.col("ts_utc") + F.expr("INTERVAL 10 MINUTES"), "yyyyMMdd:HHmm")
    record = F.struct(
        stamp.alias("time"),
        F.round(F.col("pv_power_kw") * 1000, 1).alias("P"),
        F.col("ghi_w_m2").alias("G(i)"),
        F.col("temp_c").alias("H_sun"),
        F.col("wind_ms").alias("T2m"),
        F.col("cloud_pct").cast("double").alias("WS10m"),
        F.lit(0.0).alias("Int"),
    )
    replies = hours.groupBy("asset_id", F.to_date("ts_utc").alias("day")).agg(
        F.to_json(F.struct(F.struct(F.collect_list(record).alias("hourly")).alias("outputs"))).alias("body")
    )
    site = {"lat": F.lit(47.0), "lon": F.lit(8.0), "peak_power_kwp": F.lit(100.0)}
    parsed = payloads.explode_records(replies, literals=site)
    return parsed.withColumns({"pv_power_kw": F.round("pv_power_kw", 4), "pv_power_w": F.round("pv_power_w", 1)})


@query("SELECT asset_id, ts_utc, ts_local, ghi_w_m2, temp_c, cloud_pct, wind_ms FROM weather_hourly")
def explode_parallel_arrays(b: Bindings) -> DataFrame:
    """Replies are rebuilt as JSON text, one per asset and day, then parsed back into rows."""
    hour = F.struct(
        F.date_format("ts_utc", "yyyy-MM-dd'T'HH:mm").alias("time"), "ghi_w_m2", "temp_c", "cloud_pct", "wind_ms"
    )
    days = b.weather_hourly.groupBy("asset_id", F.to_date("ts_utc").alias("day")).agg(
        F.sort_array(F.collect_list(hour)).alias("h")
    )
    hourly = F.struct(
        F.col("h.time").alias("time"),
        F.col("h.ghi_w_m2").alias("shortwave_radiation"),
        F.col("h.temp_c").alias("temperature_2m"),
        F.col("h.cloud_pct").alias("cloud_cover"),
        F.col("h.wind_ms").alias("wind_speed_10m"),
    )
    replies = days.select("asset_id", F.to_json(F.struct(hourly.alias("hourly"))).alias("body"))
    return payloads.explode_parallel_arrays(replies)


@query("SELECT asset_id, ts_utc, gen_type, generation_mw FROM mix_by_type")
def melt_wide(b: Bindings) -> DataFrame:
    return payloads.melt_wide(b.wide_mix)


@query(
    """
SELECT asset_id, ts_utc, max(CASE WHEN gen_type = 'solar' THEN generation_mw END) AS solar,
  max(CASE WHEN gen_type = 'nuclear' THEN generation_mw END) AS nuclear FROM mix_by_type GROUP BY 1, 2
"""
)
def select_generation_columns(b: Bindings) -> DataFrame:
    two_level = b.wide_mix.select(
        "asset_id",
        "ts_utc",
        F.col("solar").alias("solar|Actual Aggregated"),
        F.col("hydro_reservoir").alias("hydro|Actual Consumption"),
        F.col("nuclear").alias("nuclear|Actual Aggregated"),
    )
    return payloads.select_generation_columns(two_level, ["asset_id", "ts_utc"])


@query(
    """
SELECT asset_id, ts_utc, ts_local, gen_type, generation_mw FROM mix_by_type
JOIN (SELECT DISTINCT asset_id, ts_utc, ts_local FROM genmix_long) AS hours USING (asset_id, ts_utc)
"""
)
def parse_generation_mix(b: Bindings) -> DataFrame:
    titled = {c: f"{c.replace('_', ' ').title()} |Actual Aggregated" for c in GEN_TYPES.values()}
    return payloads.parse_generation_mix(b.wide_mix.withColumnsRenamed(titled))


@query("SELECT asset_id, ts_utc, price_eur_mwh AS price FROM price_hourly")
def first_value_column(b: Bindings) -> DataFrame:
    reply = b.price_hourly.select("asset_id", "ts_utc", "price_eur_mwh", "price_eur_kwh")
    return payloads.first_value_column(reply, ("asset_id", "ts_utc"), "price")


@query("SELECT asset_id, ts_utc, ts_local, price_eur_mwh, round(price_eur_kwh, 6) AS price_eur_kwh FROM price_hourly")
def parse_price_series(b: Bindings) -> DataFrame:
    series = b.price_hourly.select("asset_id", "ts_utc", F.col("price_eur_mwh").alias("value"))
    return rounded(payloads.parse_price_series(series), 6)


@query("SELECT asset_id, ts_utc, ts_local, load_forecast_mw FROM price_load_forecast")
def parse_load_forecast(b: Bindings) -> DataFrame:
    reply = b.price_load_forecast.select(
        "asset_id", "ts_utc", F.col("load_forecast_mw").alias("Forecasted Load"), F.lit(0.0).alias("Other")
    )
    return payloads.parse_load_forecast(reply)


@query(
    """
SELECT asset_id, strftime(ts_utc, '%Y-%m-%dT%H:%M:%S.000Z') AS ts_utc, printf('%.4f', price_eur_mwh) AS price_eur_mwh
FROM price_hourly
"""
)
def write_csv_rounded(b: Bindings) -> DataFrame:
    """Read back as text, to show the fixed decimals."""
    path = scratch_path(b.spark, "price-csv")
    sinks.write_csv_rounded(b.price_hourly.select("asset_id", "ts_utc", "price_eur_mwh"), path, 4)
    return b.spark.read.option("header", True).csv(path)


@query(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, printf('%.1f', value) AS one, "
    "printf('%.3f', value / 8.0::DOUBLE) AS three FROM event_rows"
)
def write_csv_rounded_ties(b: Bindings) -> DataFrame:
    """Many values end in 5, so that the side of the tie matters."""
    path = scratch_path(b.spark, "ties-csv")
    rows = b.event_rows.select("event_id", F.col("value").alias("one"), (F.col("value") / 8.0).alias("three"))
    sinks.write_csv_rounded(rows, path, {"one": 1, "three": 3})
    return b.spark.read.option("header", True).csv(path)


@query("SELECT asset_id, ts_utc, ts_local, ghi_w_m2, temp_c, cloud_pct, wind_ms FROM weather_hourly")
def write_csv(b: Bindings) -> DataFrame:
    path = scratch_path(b.spark, "weather-csv")
    columns = ["asset_id", "ts_utc", "ts_local", "ghi_w_m2", "temp_c", "cloud_pct", "wind_ms"]
    rows = b.weather_hourly.select(*columns)
    sinks.write_csv(rows, path)
    return read_csv(b.spark, path, rows.schema)


@query(
    f"""
SELECT asset_id, ts_utc, ts_local, price_eur_mwh, price_lag_1h, price_lag_24h, price_lag_168h, hour_of_day,
  day_of_week, is_weekend, is_holiday, load_forecast_mw, cloud_pct,
  {rounds('solar_share_lag24h hydro_share_lag24h nuclear_share_lag24h', 8)}
FROM price_features WHERE price_lag_1h IS NOT NULL AND price_lag_24h IS NOT NULL AND price_lag_168h IS NOT NULL
"""
)
def scan_ordered(b: Bindings) -> DataFrame:
    columns = [
        "asset_id", "ts_utc", "ts_local", "price_eur_mwh", *PRICE_LAGS, "hour_of_day", "day_of_week", "is_weekend",
        "is_holiday", "load_forecast_mw", "cloud_pct", "solar_share_lag24h", "hydro_share_lag24h",
        "nuclear_share_lag24h",
    ]
    return rounded(scan(b.price_features, PRICE_LAGS, columns, order_by=["ts_utc", "asset_id"]), 8)


@query(
    """
SELECT asset_id, ts_utc, pv_power_kw, pv_lag_1h, pv_lag_24h, pv_lag_168h
FROM pv_features WHERE pv_lag_1h IS NOT NULL AND pv_lag_24h IS NOT NULL AND pv_lag_168h IS NOT NULL
"""
)
def scan_ordered_pv(b: Bindings) -> DataFrame:
    columns = ["asset_id", "ts_utc", "pv_power_kw", *PV_LAGS]
    return scan(b.pv_features, PV_LAGS, columns, order_by=["ts_utc", "asset_id"])


def price_and_pv_metrics(b: Bindings) -> DataFrame:
    price_split = chronological_split(scan(b.price_mart, PRICE_LAGS))
    pv_split = chronological_split(scan(b.pv_mart, PV_LAGS))
    price = attach_baselines(b.blend(price_split, "price_eur_mwh", "price"), b.price_mart, "price")
    pv = attach_baselines(b.blend(pv_split, "pv_power_kw", "pv"), b.pv_mart, "pv")
    return error_metrics_by_split(price, "price_eur_mwh").unionByName(error_metrics_by_split(pv, "pv_power_kw"))


def metrics_sql() -> str:
    """Metrics per target, split and model, by brute force: every row is repeated per split and model."""

    def stacked(source: str, low: int, high: int, inside: str, outside: str) -> str:
        return f"""
SELECT target, model_version, split, model, y_true, y FROM (
  SELECT s.*, v.model AS model,
    CASE v.model WHEN 'model' THEN y_pred WHEN 'persistence_24h' THEN lag_24h ELSE lag_168h END AS y
  FROM (SELECT *, unnest(['overall', CASE WHEN hour_of_day BETWEEN {low} AND {high} THEN '{inside}'
          ELSE '{outside}' END]) AS split FROM {source}) AS s,
       (SELECT unnest(['model', 'persistence_24h', 'seasonal_naive_168h']) AS model) AS v) AS all_"""

    return f"""
SELECT target, min(model_version) AS model_version, split, model, round(avg(abs(y_true - y)), 4) AS mae,
  round(avg(abs((y_true - y) / CASE WHEN y_true = 0 THEN 1 ELSE y_true END)) * 100, 4) AS mape,
  round(sqrt(avg((y_true - y) * (y_true - y))), 4) AS rmse
FROM ({stacked('price_attached', 8, 19, 'peak_8_19h', 'offpeak')}
UNION ALL {stacked('pv_attached', 6, 20, 'daytime_6_20h', 'nighttime')}) AS rows_
GROUP BY target, split, model"""


@query(metrics_sql())
def write_metrics(b: Bindings) -> DataFrame:
    path = scratch_path(b.spark, "metrics")
    sinks.write_metrics(price_and_pv_metrics(b), path)
    return b.spark.read.schema(sinks.METRICS_SCHEMA).json(path)


@query(
    f"""
SELECT m.*, round((1 - mae / nullif(p.persistence_mae, 0)) * 100, 4) AS lift_vs_persistence_pct,
  round((1 - mae / nullif(p.seasonal_mae, 0)) * 100, 4) AS lift_vs_seasonal_pct
FROM ({metrics_sql()}) AS m JOIN (
  SELECT target, split, max(CASE WHEN model = 'persistence_24h' THEN mae END) AS persistence_mae,
    max(CASE WHEN model = 'seasonal_naive_168h' THEN mae END) AS seasonal_mae
  FROM ({metrics_sql()}) AS n GROUP BY 1, 2) AS p USING (target, split)
"""
)
def read_metrics(b: Bindings) -> DataFrame:
    path = scratch_path(b.spark, "metrics")
    sinks.write_metrics(price_and_pv_metrics(b), path)
    return sinks.read_metrics(b.spark, path)

