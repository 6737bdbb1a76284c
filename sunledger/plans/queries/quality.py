"""Data-quality checks, over tables with known faults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.operators import evaluation, quality
from sunledger.operators.features import PRICE_LAGS
from sunledger.plans.bindings import Bindings
from sunledger.plans.registry import query


def row(check: str, table: str, column: str, bad: str, source: str, severity: str = "error") -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST({bad} AS BIGINT) AS bad_rows, '{severity}' AS severity FROM {source}"
    )


@query(
    " UNION ALL ".join(
        row("not_null", "price_features", c, f"count(*) FILTER ({c} IS NULL)", "price_features")
        for c in ("asset_id", "ts_utc", "price_eur_mwh", "price_lag_168h", "ghi_w_m2", "load_forecast_mw")
    )
)
def check_not_null(b: Bindings) -> DataFrame:
    columns = ["asset_id", "ts_utc", "price_eur_mwh", "price_lag_168h", "ghi_w_m2", "load_forecast_mw"]
    return quality.check_not_null(b.price_features, "price_features", columns)


REPEATED = "(SELECT asset_id, ts_utc FROM {0} GROUP BY 1, 2 HAVING count(*) > 1) AS repeated"


@query(
    row("unique", "load_raw", "asset_id, ts_utc", "count(*)", REPEATED.format("load_raw"))
    + " UNION ALL "
    + row("unique", "supplier_hourly", "asset_id, ts_utc", "count(*)", REPEATED.format("supplier_hourly"))
)
def check_unique(b: Bindings) -> DataFrame:
    key = ["asset_id", "ts_utc"]
    return quality.all_checks(
        [
            quality.check_unique(b.load_raw, "load_raw", key),
            quality.check_unique(b.supplier_hourly, "supplier_hourly", key),
        ]
    )


@query(
    row("unique", "load_hourly", "asset_id, ts_utc", "count(*)", REPEATED.format("load_raw"), "warn")
    + " UNION ALL "
    + row("unique", "entsoe_prices", "asset_id, ts_utc", "count(*)", REPEATED.format("order_rows"))
)
def check_known_duplicates(b: Bindings) -> DataFrame:
    key, known = ["asset_id", "ts_utc"], ["load_hourly", "entsoe_genmix"]
    return quality.all_checks(
        [
            quality.check_known_duplicates(b.load_raw, "load_hourly", key, known),
            quality.check_known_duplicates(b.order_series, "entsoe_prices", key, known),
        ]
    )


@query(
    row("accepted_range", "load_hourly", "load_kw", "count(*) FILTER (load_kw < 0 OR load_kw > 300)", "load_hourly")
)
def check_range(b: Bindings) -> DataFrame:
    return quality.check_range(b.load_hourly, "load_hourly", {"load_kw": (0, 300)})


@query(
    row(
        "row_count",
        "load_hourly",
        "ts_utc",
        "sum(greatest(ceil(expected * 0.98::DOUBLE) - n, 0))",
        "(SELECT count(DISTINCT ts_utc) AS n FROM load_hourly GROUP BY asset_id) AS seen, "
        "(SELECT date_diff('hour', min(ts_utc), max(ts_utc)) + 1 AS expected FROM load_hourly) AS hours",
    )
    + " UNION ALL "
    + row(
        "row_count",
        "load_1994",
        "ts_utc",
        "sum(greatest(ceil(365 * 24 * 0.98::DOUBLE) - n, 0))",
        "(SELECT count(DISTINCT ts_utc) FILTER (year(ts_utc) = 1994) AS n FROM load_hourly GROUP BY asset_id) AS seen",
    )
    + " UNION ALL "
    + row("row_count", "price_hourly", "*", "greatest(ceil(100000 * 0.98::DOUBLE) - count(*), 0)", "price_hourly")
    + " UNION ALL "
    + row("row_count", "supplier_hourly", "*", "abs(count(*) - 60000)", "supplier_hourly")
)
def check_row_count(b: Bindings) -> DataFrame:
    return quality.all_checks(
        [
            quality.check_hour_coverage(b.load_hourly, "load_hourly"),
            quality.check_hour_coverage(b.load_hourly, "load_1994", window=("1994-01-01", "1995-01-01")),
            quality.check_row_count(b.price_hourly, "price_hourly", 100_000),
            quality.check_row_count(b.supplier_hourly, "supplier_hourly", 60_000, exact=True),
        ]
    )


@query(
    row(
        "annual_total",
        "supplier_hourly",
        "load_kw",
        "count(*) FILTER (abs(total - 500000) / 500000 * 100 >= 5)",
        "(SELECT sum(load_kw) AS total FROM supplier_hourly GROUP BY asset_id, year(ts_local)) AS totals",
    )
)
def check_annual_total(b: Bindings) -> DataFrame:
    return quality.check_annual_total(b.supplier_hourly, "supplier_hourly", "load_kw", 500_000.0)


@query(
    " UNION ALL ".join(
        row("raw_bounds", "weather_hourly", c, f"count(*) FILTER ({c} < {lo} OR {c} > {hi})", "weather_hourly")
        for c, lo, hi in (("ghi_w_m2", 0, 100), ("cloud_pct", 1, 3), ("temp_c", -50, 60))
    )
    + " UNION ALL "
    + row("raw_bounds", "pv_hourly", "pv_power_kw", "count(*) FILTER (pv_power_kw > 120)", "pv_hourly")
)
def check_bounds_raw(b: Bindings) -> DataFrame:
    weather = {"ghi_w_m2": (0, 100), "cloud_pct": (1, 3), "temp_c": (-50, 60)}
    return quality.all_checks(
        [
            quality.check_bounds_raw(b.weather_hourly, "weather_hourly", weather),
            quality.check_bounds_raw(b.pv_hourly, "pv_hourly", {"pv_power_kw": (None, 120)}),
        ]
    )


@query(
    """
SELECT count(*) FILTER (p.price_lag_24h IS NULL) AS null_lag_24h, count(*) FILTER (p.price_lag_168h IS NULL) AS null_lag_168h
FROM price_hourly f LEFT JOIN price_features p ON f.asset_id = p.asset_id AND f.ts_utc = p.ts_utc
"""
)
def check_lag_alignment(b: Bindings) -> DataFrame:
    rows = b.price_hourly.select("asset_id", "ts_utc")
    return evaluation.check_lag_alignment(evaluation.attach_baselines(rows, b.price_features, "price"))


@query(
    row(
        "split_bounds",
        "price_features",
        "ts_utc",
        "count(*) FILTER (lo < first_month OR hi > last_month)",
        """(SELECT split, min(m) AS lo, max(m) AS hi, CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 48 ELSE 54 END
  AS first_month, CASE split WHEN 'train' THEN 47 WHEN 'validation' THEN 53 ELSE 59 END AS last_month
  FROM price_split GROUP BY 1) AS seen""",
    )
)
def check_split_bounds(b: Bindings) -> DataFrame:
    return quality.check_split_bounds(b.price_split, "price_features")


@query(
    row(
        "split_total",
        "price_features",
        "*",
        "greatest(count(*) - (SELECT count(*) FROM price_features WHERE price_lag_168h IS NOT NULL), 0)",
        "price_split",
    )
)
def check_split_total(b: Bindings) -> DataFrame:
    source = b.price_mart.dropna(subset=list(PRICE_LAGS))
    return quality.check_split_total(b.price_split, source, "price_features")


@query(
    """
SELECT asset_id, ts_utc FROM (SELECT asset_id, ts_utc, o_orderstatus AS split FROM order_rows) AS s
GROUP BY 1, 2 HAVING count(DISTINCT split) > 1
"""
)
def split_overlap(b: Bindings) -> DataFrame:
    """The order status stands in for the split, so that keys do overlap."""
    return quality.split_overlap(b.order_series.select("asset_id", "ts_utc", F.col("o_orderstatus").alias("split")))


@query(
    "SELECT 'error' AS severity, CAST(2 AS BIGINT) AS n_checks, CAST((SELECT count(*) FILTER (bad > 0) FROM ("
    "SELECT count(*) FILTER (load_kw > 300) AS bad FROM load_hourly "
    "UNION ALL SELECT count(*) FILTER (load_kw IS NULL) FROM load_hourly) AS t) AS BIGINT) AS n_failed "
    "UNION ALL SELECT 'warn', CAST(1 AS BIGINT), CAST((SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM "
    + REPEATED.format("load_raw")
    + ") AS BIGINT)"
)
def check_summary(b: Bindings) -> DataFrame:
    reports = [
        quality.check_range(b.load_hourly, "load_hourly", {"load_kw": (0, 300)}),
        quality.check_not_null(b.load_hourly, "load_hourly", ["load_kw"]),
        quality.check_known_duplicates(b.load_raw, "load_hourly", ["asset_id", "ts_utc"], ["load_hourly"]),
    ]
    return quality.passed(quality.all_checks(reports))
