"""Lag windows, feature tables, calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.operators import features, series
from sunledger.plans.bindings import Bindings
from sunledger.plans.registry import query, rounds

LAG_SQL = """
SELECT asset_id, ts_utc, pv_power_kw, lag(pv_power_kw, 1) OVER w AS pv_lag_1h, lag(pv_power_kw, 24) OVER w AS pv_lag_24h,
  lag(pv_power_kw, 168) OVER w AS pv_lag_168h FROM supplier_hourly WINDOW w AS (PARTITION BY asset_id ORDER BY ts_utc)
"""


def pv_series(b: Bindings) -> DataFrame:
    return b.supplier_hourly.select("asset_id", "ts_utc", "pv_power_kw")


@query(LAG_SQL)
def lag_features(b: Bindings) -> DataFrame:
    return series.lag_features(pv_series(b), "pv_power_kw", "pv")


@query(LAG_SQL)
def lag_features_long_series(b: Bindings) -> DataFrame:
    """The path for series too long for one task: every series is cut into time ranges, settled at the seams."""
    return series.lag_features(pv_series(b), "pv_power_kw", "pv", rows_per_task=200)


@query(
    """
SELECT s.asset_id, s.ts_utc, s.load_kw, a.load_kw AS load_lag_1h, b.load_kw AS load_lag_24h, c.load_kw AS load_lag_168h
FROM load_hourly s
LEFT JOIN load_hourly a ON a.asset_id = s.asset_id AND a.ts_utc = s.ts_utc - INTERVAL 1 HOUR
LEFT JOIN load_hourly b ON b.asset_id = s.asset_id AND b.ts_utc = s.ts_utc - INTERVAL 24 HOUR
LEFT JOIN load_hourly c ON c.asset_id = s.asset_id AND c.ts_utc = s.ts_utc - INTERVAL 168 HOUR
"""
)
def lag_by_time(b: Bindings) -> DataFrame:
    return series.lag_by_time(b.load_hourly.select("asset_id", "ts_utc", "load_kw"), "load_kw", "load")


MIX_LAGS = "solar_share_lag24h hydro_share_lag24h nuclear_share_lag24h"


@query(
    f"""
SELECT asset_id, ts_utc, {rounds(MIX_LAGS, 8)}, round(total_gen_mw_lag24h, 2) AS total_gen_mw_lag24h
FROM price_features
"""
)
def lag_after_join(b: Bindings) -> DataFrame:
    prices = b.price_hourly.select("asset_id", "ts_utc", "price_eur_mwh")
    enriched = features.price_enrich_join(prices, b.price_weather, b.price_load_forecast, b.price_genmix)
    lagged = features.lag_after_join(enriched)
    return lagged.select(
        "asset_id",
        "ts_utc",
        *[F.round(c, 8).alias(c) for c in MIX_LAGS.split()],
        F.round("total_gen_mw_lag24h", 2).alias("total_gen_mw_lag24h"),
    )


@query("SELECT * FROM pv_features")
def pv_features(b: Bindings) -> DataFrame:
    return b.pv_features


@query("SELECT * FROM pv_features")
def pv_features_bucketed(b: Bindings) -> DataFrame:
    return features.pv_features(*b.bucketed(b.supplier_hourly, b.supplier_weather))


PRICE_FEATURE_SQL = f"""
SELECT asset_id, ts_utc, ts_local, price_eur_mwh, price_eur_kwh, price_lag_1h, price_lag_24h, price_lag_168h,
  hour_of_day, day_of_week, is_weekend, is_holiday, ghi_w_m2, temp_c, cloud_pct, wind_ms, load_forecast_mw,
  {rounds(MIX_LAGS, 8)}, round(total_gen_mw_lag24h, 2) AS total_gen_mw_lag24h FROM price_features
"""


def rounded_mix(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {**{c: F.round(c, 8) for c in MIX_LAGS.split()}, "total_gen_mw_lag24h": F.round("total_gen_mw_lag24h", 2)}
    )


@query(PRICE_FEATURE_SQL)
def price_features(b: Bindings) -> DataFrame:
    return rounded_mix(b.price_features)


@query(PRICE_FEATURE_SQL)
def price_features_bucketed(b: Bindings) -> DataFrame:
    """The same from series stored in buckets: joined where they are, lagged year by year, only the seams shuffled."""
    prices, *sides = b.bucketed(b.price_hourly, b.price_weather, b.price_load_forecast, b.price_genmix)
    return rounded_mix(features.price_features(prices, b.holidays, *sides))


NAIVE_SQL = """
SELECT asset_id, ts_utc, price_eur_mwh,
  lag(price_eur_mwh, {0}) OVER (PARTITION BY asset_id ORDER BY ts_utc) AS y_pred FROM price_hourly
"""


@query(NAIVE_SQL.format(24))
def persistence(b: Bindings) -> DataFrame:
    return series.persistence(b.price_hourly.select("asset_id", "ts_utc", "price_eur_mwh"), "price_eur_mwh")


@query(NAIVE_SQL.format(168))
def seasonal_naive(b: Bindings) -> DataFrame:
    return series.seasonal_naive(b.price_hourly.select("asset_id", "ts_utc", "price_eur_mwh"), "price_eur_mwh")


@query(
    """
SELECT * FROM (SELECT asset_id, ts_utc, pv_power_kw AS y_true, lag(pv_power_kw, 24) OVER w AS y_pred_persistence,
  lag(pv_power_kw, 168) OVER w AS y_pred_seasonal_naive FROM supplier_hourly
  WINDOW w AS (PARTITION BY asset_id ORDER BY ts_utc)) AS lagged
WHERE y_pred_persistence IS NOT NULL AND y_pred_seasonal_naive IS NOT NULL
"""
)
def baseline_frame(b: Bindings) -> DataFrame:
    return series.baseline_frame(b.supplier_hourly, "pv_power_kw")


@query(
    """
SELECT asset_id, count(*) AS n_rows, count(*) FILTER (ts_utc < before) AS n_backward FROM (
  SELECT asset_id, ts_utc, lag(ts_utc) OVER (PARTITION BY asset_id ORDER BY o_orderkey) AS before FROM order_rows
) AS steps GROUP BY 1
"""
)
def ordering_check(b: Bindings) -> DataFrame:
    """Orders are not sorted by time, so many steps go backward."""
    return series.ordering_check(b.order_series, "o_orderkey", chunk=1_000)


@query(
    """
SELECT asset_id, count(*) AS n_rows, count(*) FILTER (stamp < before) AS n_backward FROM (
  SELECT asset_id, stamp, lag(stamp) OVER (PARTITION BY asset_id ORDER BY event_id) AS before FROM event_rows
) AS steps GROUP BY 1
"""
)
def ordering_check_sorted(b: Bindings) -> DataFrame:
    return series.ordering_check(b.event_rows, "event_id", ts="stamp")


@query("SELECT DISTINCT holiday_date FROM holidays")
def holiday_dim(b: Bindings) -> DataFrame:
    return b.holidays


@query(
    """
SELECT asset_id, hour AS ts_utc FROM (
  SELECT asset_id, unnest(generate_series(min(ts_utc), max(ts_utc), INTERVAL 1 HOUR)) AS hour FROM load_hourly
  GROUP BY asset_id) AS hours
WHERE (asset_id, hour) NOT IN (SELECT (asset_id, ts_utc) FROM load_hourly)
"""
)
def missing_hours(b: Bindings) -> DataFrame:
    return series.missing_hours(b.load_hourly)


@query(
    """
SELECT unnest(['price_lag_1h', 'price_lag_24h', 'price_lag_168h', 'hour_of_day', 'day_of_week', 'is_weekend',
  'is_holiday', 'ghi_w_m2', 'temp_c', 'cloud_pct', 'wind_ms', 'load_forecast_mw', 'solar_share_lag24h',
  'hydro_share_lag24h', 'nuclear_share_lag24h', 'total_gen_mw_lag24h']) AS feature,
  unnest([count(price_lag_1h), count(price_lag_24h), count(price_lag_168h), count(hour_of_day), count(day_of_week),
    count(is_weekend), count(is_holiday), count(ghi_w_m2), count(temp_c), count(cloud_pct), count(wind_ms),
    count(load_forecast_mw), count(solar_share_lag24h), count(hydro_share_lag24h), count(nuclear_share_lag24h),
    count(total_gen_mw_lag24h)]) AS n_known FROM price_features
"""
)
def feature_columns(b: Bindings) -> DataFrame:
    """The model inputs of the price table, with how many rows know each."""
    table = b.price_features
    names = features.feature_columns(table, "price_eur_mwh")
    counts = table.agg(*[F.count(c).alias(c) for c in names])
    return counts.unpivot([], names, "feature", "n_known")
