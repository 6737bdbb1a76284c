"""Forecast evaluation: baselines attached, error metrics by model and hour band, comparison views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.timeops import hour_of_day, in_hours
from sunledger.settings import PRICE_PEAK_HOURS, PV_DAY_HOURS

SERIES_KEY = ["asset_id", "ts_utc"]
MODELS = {"model": "y_pred", "persistence_24h": "lag_24h", "seasonal_naive_168h": "lag_168h"}

# Hour bands and labels per target; the second label is the complement.
HOUR_BANDS = {
    "price_eur_mwh": (PRICE_PEAK_HOURS, "peak_8_19h", "offpeak"),
    "pv_power_kw": (PV_DAY_HOURS, "daytime_6_20h", "nighttime"),
}


def filter_target(forecasts: DataFrame, target: str) -> DataFrame:
    return forecasts.where(F.col("target") == F.lit(target))


def filter_local_date_range(rows: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Rows whose local day lies in the inclusive range, written as a half-open range on the stored column so
    that it is pushed to the scan."""
    start = F.lit(str(first)).cast("date").cast("timestamp_ntz")
    stop = F.date_add(F.lit(str(last)).cast("date"), 1).cast("timestamp_ntz")
    years = (int(str(first)[:4]) - 1, int(str(last)[:4]) + 1)  # a local day may lie in the next or last UTC year
    return _of_years(rows.where((F.col("ts_local") >= start) & (F.col("ts_local") < stop)), *years)


def filter_ts_range(rows: DataFrame, first: datetime | str, last: datetime | str) -> DataFrame:
    """Rows whose instant lies in the inclusive range."""
    inside = F.col("ts_utc").between(F.lit(str(first)).cast("timestamp"), F.lit(str(last)).cast("timestamp"))
    return _of_years(rows.where(inside), int(str(first)[:4]), int(str(last)[:4]))


def _of_years(rows: DataFrame, first: int | Column, last: int | Column) -> DataFrame:
    """Stored hourly tables are partitioned by the UTC `year`: a bound on it prunes their files."""
    return rows.where(F.col("year").between(first, last)) if "year" in rows.columns else rows


def _around(features: DataFrame, forecasts: DataFrame) -> DataFrame:
    """The feature rows within the forecasts' first and last hour, as a scalar subquery."""
    hours = forecasts.select(F.struct(F.min("ts_utc").alias("first"), F.max("ts_utc").alias("last"))).scalar()
    first, last = hours.getField("first"), hours.getField("last")
    return _of_years(features.where(F.col("ts_utc").between(first, last)), F.year(first), F.year(last))


def forecast_vs(
    forecasts: DataFrame, features: DataFrame, target: str, baseline: str, name: str, ordered: bool = True
) -> DataFrame:
    """Forecast, actual value and one naive baseline per hour. The target filter is applied before the join."""
    forecasts = filter_target(forecasts, target)
    base = _around(features, forecasts).select(*SERIES_KEY, F.col(baseline).alias(name))
    view = (
        forecasts.select(*SERIES_KEY, "ts_local", F.col("y_pred").alias("forecast"), F.col("y_true").alias("actual"))
        .join(base, SERIES_KEY, "left")
    )
    return view.orderBy("ts_utc", "asset_id") if ordered else view


def forecast_vs_seasonal(forecasts: DataFrame, price_features: DataFrame, ordered: bool = True) -> DataFrame:
    return forecast_vs(forecasts, price_features, "price_eur_mwh", "price_lag_168h", "seasonal_naive", ordered)


def forecast_vs_persistence(forecasts: DataFrame, pv_features: DataFrame, ordered: bool = True) -> DataFrame:
    return forecast_vs(forecasts, pv_features, "pv_power_kw", "pv_lag_24h", "persistence", ordered)


def attach_baselines(forecasts: DataFrame, features: DataFrame, prefix: str) -> DataFrame:
    """Forecast rows with both naive predictions and the local hour of the feature row."""
    base = _around(features, forecasts).select(
        *SERIES_KEY,
        F.col(f"{prefix}_lag_24h").alias("lag_24h"),
        F.col(f"{prefix}_lag_168h").alias("lag_168h"),
        "hour_of_day",
    )
    return forecasts.join(base, SERIES_KEY, "left")


def check_lag_alignment(attached: DataFrame) -> DataFrame:
    """How many forecast rows found no baseline (a warning, not a failure)."""
    return attached.agg(
        F.count_if(F.col("lag_24h").isNull()).alias("null_lag_24h"),
        F.count_if(F.col("lag_168h").isNull()).alias("null_lag_168h"),
    )


def _errors(actual: Column, predicted: Column, among: Column | None = None) -> dict[str, Column]:
    """MAE, MAPE (a zero actual counts with denominator 1) and RMSE of the rows in `among`."""
    miss = actual - predicted
    if among is not None:
        miss = F.when(among, miss)
    scale = F.when(actual == 0, F.lit(1.0)).otherwise(F.abs(actual))
    return {
        "mae": F.round(F.avg(F.abs(miss)), 4),
        "mape": F.round(F.avg(F.abs(miss) / scale) * 100, 4),
        "rmse": F.round(F.sqrt(F.avg(miss * miss)), 4),
    }


def error_metrics(
    rows: DataFrame, actual: str = "y_true", predicted: str = "y_pred", by: Sequence[str] = ()
) -> DataFrame:
    errors = _errors(F.col(actual), F.col(predicted))
    return rows.groupBy(*by).agg(*[e.alias(n) for n, e in errors.items()])


def error_metrics_by_split(
    attached: DataFrame, target: str, models: Mapping[str, str] | None = None
) -> DataFrame:
    """Metrics of each model overall, inside the hour band and outside it: (target, version, split, model).

    All figures come from one aggregate with conditional means; rows are not multiplied by model or split.
    """
    models = dict(models or MODELS)
    band, inside_label, outside_label = HOUR_BANDS[target]
    inside = F.coalesce(in_hours("hour_of_day", band), F.lit(False))
    splits = {"overall": None, inside_label: inside, outside_label: ~inside}
    figures, entries = [], []
    for split, among in splits.items():
        for model, column in models.items():
            errors = _errors(F.col("y_true"), F.col(column), among)
            names = {metric: f"{split}__{model}__{metric}" for metric in errors}
            figures += [errors[m].alias(n) for m, n in names.items()]
            entries.append(
                F.struct(
                    F.lit(split).alias("split"),
                    F.lit(model).alias("model"),
                    *[F.col(n).alias(m) for m, n in names.items()],
                )
            )
    one_row = filter_target(attached, target).agg(F.min("model_version").alias("model_version"), *figures)
    return one_row.where(F.col("model_version").isNotNull()).select(
        F.lit(target).alias("target"), "model_version", F.explode(F.array(*entries)).alias("e")
    ).select("target", "model_version", "e.*")


def forecast_lift(metrics: DataFrame, over: str, split: str = "overall") -> DataFrame:
    """How much better (%) the model's MAE is than that of the baseline `over`."""
    mae = lambda model: F.max(F.when(F.col("model") == model, F.col("mae")))
    pair = metrics.where(F.col("split") == split).groupBy("target").agg(
        mae("model").alias("model_mae"), mae(over).alias("baseline_mae")
    )
    lift = (F.lit(1.0) - F.try_divide("model_mae", "baseline_mae")) * 100
    return pair.withColumn("lift_pct", F.round(lift, 1))


def mae_by_hour(forecasts: DataFrame, target: str, ordered: bool = True) -> DataFrame:
    """Mean absolute error by local hour of one target."""
    table = filter_target(forecasts, target).groupBy(hour_of_day("ts_local").alias("hour_of_day")).agg(
        F.avg(F.abs(F.col("y_pred") - F.col("y_true"))).alias("mae")
    )
    return table.orderBy("hour_of_day") if ordered else table

