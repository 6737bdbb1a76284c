"""Splits, forecast tables, error metrics, model training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.operators import evaluation, forecasting, rollups
from sunledger.plans.bindings import Bindings
from sunledger.plans.queries.ingest import metrics_sql, price_and_pv_metrics
from sunledger.plans.registry import query, rounded
from sunledger.session import scratch_path

VERSION = "gbt_v1"


@query("SELECT asset_id, ts_utc, price_eur_mwh, split FROM price_split")
def chronological_split(b: Bindings) -> DataFrame:
    return b.price_split.select("asset_id", "ts_utc", "price_eur_mwh", "split")


@query(
    """
SELECT asset_id, ts_utc, ts_local, target, round(y_pred, 3) AS y_pred, y_true, model_version FROM pv_blend
"""
)
def forecast_rows(b: Bindings) -> DataFrame:
    return rounded(b.pv_blend, 3)


@query(
    """
SELECT asset_id, ts_utc, ts_local, target, round(y_pred, 3) AS y_pred, y_true, model_version
FROM (SELECT * FROM price_blend UNION ALL SELECT * FROM pv_blend) AS stacked
"""
)
def stack_forecasts(b: Bindings) -> DataFrame:
    return rounded(b.forecasts, 3)


@query("SELECT target, count(*) AS n FROM (SELECT target FROM price_blend UNION ALL SELECT target FROM pv_blend) AS s GROUP BY 1")
def count_by_target(b: Bindings) -> DataFrame:
    return rollups.count_by(b.forecasts, "target").orderBy("target")


@query(
    """
SELECT target, min(model_version) AS model_version
FROM (SELECT target, model_version FROM price_blend UNION ALL SELECT target, model_version FROM pv_blend) AS s GROUP BY 1
"""
)
def first_label(b: Bindings) -> DataFrame:
    return b.forecasts.groupBy("target").agg(F.min("model_version").alias("model_version"))


@query(
    """
SELECT round(avg(abs(y_true - y_pred)), 4) AS mae,
  round(avg(abs((y_true - y_pred) / CASE WHEN y_true = 0 THEN 1 ELSE y_true END)) * 100, 4) AS mape,
  round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 4) AS rmse FROM pv_blend
"""
)
def error_metrics(b: Bindings) -> DataFrame:
    """Many actual values are zero, which count with denominator one."""
    return evaluation.error_metrics(b.pv_blend)


@query(metrics_sql())
def error_metrics_by_split(b: Bindings) -> DataFrame:
    return price_and_pv_metrics(b)


@query(
    f"""
SELECT target, max(CASE WHEN model = 'model' THEN mae END) AS model_mae,
  max(CASE WHEN model = 'seasonal_naive_168h' THEN mae END) AS baseline_mae,
  round((1 - max(CASE WHEN model = 'model' THEN mae END)
    / max(CASE WHEN model = 'seasonal_naive_168h' THEN mae END)) * 100, 1) AS lift_pct
FROM ({metrics_sql()}) AS m WHERE split = 'overall' GROUP BY 1
"""
)
def forecast_lift(b: Bindings) -> DataFrame:
    return evaluation.forecast_lift(price_and_pv_metrics(b), over="seasonal_naive_168h")


@query(
    """
SELECT CAST(extract(hour FROM ts_local) AS INTEGER) AS hour_of_day, round(avg(abs(y_pred - y_true)), 6) AS mae
FROM price_blend GROUP BY 1
"""
)
def mae_by_hour(b: Bindings) -> DataFrame:
    return rounded(evaluation.mae_by_hour(b.forecasts, "price_eur_mwh"), 6)


GATE_SQL = """
SELECT round(m, 4) AS model_mae, round(s, 4) AS baseline_mae, round(s * {factor}::DOUBLE, 4) AS limit_mae,
  m {op} s * {factor}::DOUBLE AS accepted FROM (
  SELECT avg(abs({target} - guess)) AS m, avg(abs({target} - {baseline})) AS s FROM (
    SELECT *, {prefix}_lag_24h * 0.5::DOUBLE + {prefix}_lag_168h * 0.5::DOUBLE AS guess FROM {split}
    WHERE split = 'test') AS t) AS e
"""


def _with_blend(split: DataFrame, prefix: str) -> DataFrame:
    guess = F.col(f"{prefix}_lag_24h") * F.lit(0.5) + F.col(f"{prefix}_lag_168h") * F.lit(0.5)
    return split.where(F.col("split") == "test").withColumn("y_pred", guess)


@query(
    GATE_SQL.format(
        factor=0.85, op="<=", target="price_eur_mwh", baseline="price_lag_168h", prefix="price", split="price_split"
    )
)
def acceptance_gate(b: Bindings) -> DataFrame:
    return rounded(forecasting.price_gate(_with_blend(b.price_split, "price")), 4)


@query(
    GATE_SQL.format(
        factor=1.0, op="<", target="pv_power_kw", baseline="pv_lag_24h", prefix="pv", split="pv_split"
    )
)
def acceptance_gate_pv(b: Bindings) -> DataFrame:
    return rounded(forecasting.pv_gate(_with_blend(b.pv_split, "pv")), 4)


# ---- trained models: rows only, boosted trees have no SQL counterpart
_BUNDLES: dict[tuple[str, str, str], str] = {}


def bundle(b: Bindings, target: str) -> str:
    """Path of the trained bundle; trained and saved once per application and folder."""
    key = (b.spark.sparkContext.applicationId, b.folder, target)
    if key not in _BUNDLES:
        path = scratch_path(b.spark, f"bundle-{target}")
        if target == "price_eur_mwh":
            model = forecasting.train_price(b.price_split_stored, VERSION)
        else:
            model = forecasting.train_pv(b.pv_split_stored, VERSION)
        forecasting.save_bundle(model, b.spark, path)
        _BUNDLES[key] = path
    return _BUNDLES[key]


@query()
def train_price(b: Bindings) -> DataFrame:
    """Train, score the test window, and return the gate row."""
    model = forecasting.load_bundle(b.spark, bundle(b, "price_eur_mwh"))
    return rounded(forecasting.price_gate(forecasting.score_test_window(b.price_split_stored, model)), 4)


@query()
def train_pv(b: Bindings) -> DataFrame:
    model = forecasting.load_bundle(b.spark, bundle(b, "pv_power_kw"))
    return rounded(forecasting.pv_gate(forecasting.score_test_window(b.pv_split_stored, model)), 4)


# Two small ensembles, declared: fixed values on the scale of the test tables.
PRICE_TREES = (
    (1.0, ("price_lag_24h", 150_000.0, ("price_lag_168h", 100_000.0, 120_000.0, 138_000.0), ("hour_of_day", 11.5, 161_000.0, 176_500.0))),
    (0.25, ("price_lag_1h", 180_000.0, ("cloud_pct", 1.5, -4_000.0, 2_500.0), ("is_weekend", 0.5, 9_000.0, 12_000.0))),
    (0.25, ("load_forecast_mw", 90_000.0, ("is_holiday", 0.5, -1_500.0, 500.0), 3_250.0)),
)
PV_TREES = (
    (1.0, ("pv_lag_24h", 1_000.0, ("pv_lag_168h", 1_000.0, -500.0, 12_000.0), ("hour_of_day", 5.5, 15_000.0, ("ghi_w_m2", 30_000.0, 22_000.0, 31_000.0)))),
    (0.5, ("pv_lag_1h", 25_000.0, ("day_of_year", 182.5, -2_000.0, 1_000.0), 4_000.0)),
)
DECLARED = (("price_eur_mwh", PRICE_TREES, False), ("pv_power_kw", PV_TREES, True))


def declared_sql() -> str:
    """Forecast rows of the test window, scored by the ensembles' CASE expressions; PV is not negative."""
    parts = []
    for (target, trees, nonnegative), split in zip(DECLARED, ("price_split", "pv_split")):
        numbers = ", ".join(f"{c}::DOUBLE AS {c}" for c in forecasting.features_of(trees))
        score = forecasting.ensemble_sql(trees)
        score = f"greatest({score}, 0)" if nonnegative else score
        parts.append(
            f"SELECT asset_id, ts_utc, ts_local, '{target}' AS target, round({score}, 3) AS y_pred, y_true, 'declared' AS model_version"
            f" FROM (SELECT asset_id, ts_utc, ts_local, {target} AS y_true, {numbers} FROM {split} WHERE split = 'test') AS t"
        )
    return " UNION ALL ".join(parts)


@query(declared_sql())
def score_test_window(b: Bindings) -> DataFrame:
    """Forecast rows of both targets by declared ensembles, which Spark ML scores as it does trained ones."""
    parts = []
    for (target, trees, nonnegative), split in zip(DECLARED, (b.price_split, b.pv_split)):
        model = forecasting.declared_forecaster(trees, target, "declared", nonnegative)
        parts.append(forecasting.forecast_rows(forecasting.score_test_window(split, model), model.target, model.version))
    return rounded(forecasting.stack_forecasts(*parts), 3)


@query()
def score_trained(b: Bindings) -> DataFrame:
    """Forecast rows of both trained models."""
    models = [forecasting.load_bundle(b.spark, bundle(b, target)) for target in ("price_eur_mwh", "pv_power_kw")]
    return forecasting.stack_forecasts(
        *[
            forecasting.forecast_rows(forecasting.score_test_window(split, model), model.target, model.version)
            for split, model in zip((b.price_split_stored, b.pv_split_stored), models)
        ]
    )


@query(
    """
SELECT 'price_eur_mwh' AS target, 'gbt_v1' AS model_version, false AS nonnegative, [
  'price_lag_1h', 'price_lag_24h', 'price_lag_168h', 'hour_of_day', 'day_of_week', 'is_weekend', 'is_holiday', 'ghi_w_m2',
  'temp_c', 'cloud_pct', 'wind_ms', 'load_forecast_mw', 'solar_share_lag24h', 'hydro_share_lag24h',
  'nuclear_share_lag24h', 'total_gen_mw_lag24h'] AS features
"""
)
def model_bundle(b: Bindings) -> DataFrame:
    """What is stored with a saved model."""
    return b.spark.read.schema(forecasting.BUNDLE_SCHEMA).json(f"{bundle(b, 'price_eur_mwh')}/about")
