"""Feature tables for the two forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.timeops import day_of_week, day_of_year, hour_of_day, is_weekend, local_date
from sunledger.operators.series import HOUR_KEY, hour_key, in_ranges, lag_in_ranges, lag_rows, range_cuts
from sunledger.settings import LAGS, ROWS_PER_TASK

SERIES_KEY = list(HOUR_KEY)
WEATHER = ("ghi_w_m2", "temp_c", "cloud_pct", "wind_ms")
MIX = ("solar_share", "hydro_share", "nuclear_share", "total_gen_mw")
PRICE_LAGS = tuple(f"price_lag_{n}h" for n in LAGS)
PV_LAGS = tuple(f"pv_lag_{n}h" for n in LAGS)
MIX_LAGS = tuple(f"{c}_lag24h" for c in MIX)

PRICE_FEATURE_COLUMNS = (
    *SERIES_KEY,
    "ts_local",
    "price_eur_mwh",
    "price_eur_kwh",
    *PRICE_LAGS,
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_holiday",
    *WEATHER,
    "load_forecast_mw",
    *MIX_LAGS,
)
PV_FEATURE_COLUMNS = (
    *SERIES_KEY,
    "ts_local",
    "pv_power_kw",
    *PV_LAGS,
    "hour_of_day",
    "day_of_year",
    "day_of_week",
    *WEATHER,
)


def holiday_join(series: DataFrame, holidays: DataFrame) -> DataFrame:
    """Add `is_holiday` for the local date. Making the dimension distinct keeps the series from fanning out when
    two holidays share a date; distinct dates are bounded by the calendar, so they are always broadcast."""
    days = holidays.select(F.col("holiday_date")).distinct()
    joined = series.join(F.broadcast(days), local_date("ts_local") == F.col("holiday_date"), "left")
    return joined.withColumn("is_holiday", F.col("holiday_date").isNotNull()).drop("holiday_date")


def _joined(series: DataFrame, side: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join on the hour; frames of `partitioned_by_range` and of `sources.bucketed` join on their range as well, which
    the hour decides."""
    key = hour_key(series, side)
    return series.join(side.select(*key, *columns), key, "left")


def pv_weather_join(pv: DataFrame, weather: DataFrame) -> DataFrame:
    return _joined(pv, weather, WEATHER)


def price_enrich_join(
    prices: DataFrame, weather: DataFrame, load_forecast: DataFrame, genmix: DataFrame
) -> DataFrame:
    """Price rows with weather, load forecast and generation mix of the same hour: three left joins on one key,
    so the price side is shuffled once."""
    return _joined(_joined(_joined(prices, weather, WEATHER), load_forecast, ["load_forecast_mw"]), genmix, MIX)


def partitioned_by_range(frames: Sequence[DataFrame], rows_per_task: int = ROWS_PER_TASK) -> list[DataFrame]:
    """The frames of a join that a lag window follows, each partitioned by series and time range, with the first frame's
    cuts; the others' `_cuts` go.

    Joined on (asset_id, ts_utc) as they are, the wide result must be shuffled again for the window. Partitioned by series
    and range, the narrow inputs are shuffled once, and joins and window reuse that partitioning; a range is as much as a
    task should hold, so it works for series of any length. It pays for large stored tables; small sides are better left
    to a broadcast.
    """
    cuts = range_cuts(frames[0], ["asset_id"], "ts_utc", rows_per_task)
    placed = [in_ranges(df, cuts, ["asset_id"], "ts_utc").repartition("asset_id", "_range") for df in frames]
    return [placed[0], *[df.drop("_cuts") for df in placed[1:]]]


def lag_after_join(
    enriched: DataFrame,
    lag: int = 24,
    columns: Sequence[str] = MIX,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Lag joined columns over the price rows (not over the mix table's own rows)."""
    lags = {f"{c}_lag{lag}h": (c, lag) for c in columns}
    return lag_rows(enriched, lags, rows_per_task=rows_per_task)


def _lag_features(sides: Sequence[DataFrame], join, lags, rows_per_task: int, together: bool) -> DataFrame:
    """Lags over the joined sides. The cuts come from the first side alone, whose rows a left join keeps one to one; if its
    rows are stored with their ranges, those are taken."""
    if "_range" in sides[0].columns:
        return lag_rows(join(*sides), lags)
    if together:
        return lag_in_ranges(join(*partitioned_by_range(sides, rows_per_task)), lags)
    cuts = range_cuts(sides[0], ["asset_id"], "ts_utc", rows_per_task)
    return lag_in_ranges(in_ranges(join(*sides), cuts), lags)


def pv_features(
    pv: DataFrame,
    weather: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    together: bool = False,
) -> DataFrame:
    """PV target with lags, calendar and weather; `together`: see `partitioned_by_range`."""
    base = pv.select(*hour_key(pv), "ts_local", "pv_power_kw")
    sides = [base, weather.select(*hour_key(pv, weather), *WEATHER)]
    lags = {name: ("pv_power_kw", n) for name, n in zip(PV_LAGS, LAGS)}
    lagged = _lag_features(sides, pv_weather_join, lags, rows_per_task, together)
    return lagged.withColumns(
        {
            "hour_of_day": hour_of_day("ts_local"),
            "day_of_year": day_of_year("ts_local"),
            "day_of_week": day_of_week("ts_local"),
        }
    ).select(*PV_FEATURE_COLUMNS)


def price_features(
    prices: DataFrame,
    holidays: DataFrame,
    weather: DataFrame,
    load_forecast: DataFrame,
    genmix: DataFrame,
    day_ahead_safe: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    together: bool = False,
) -> DataFrame:
    """Price target with lags, calendar, holiday flag, weather, load forecast and the mix of 24 rows earlier.

    The staged inputs are unique per (asset, hour), so the joins keep the price rows one to one and the price
    lags can share the window of the mix lags.
    `day_ahead_safe` leaves out the one-hour price lag, which is not known a day ahead; `together`: see `partitioned_by_range`.
    """
    base = prices.select(*hour_key(prices), "ts_local", "price_eur_mwh", "price_eur_kwh")
    sides = [
        base,
        weather.select(*hour_key(prices, weather), *WEATHER),
        load_forecast.select(*hour_key(prices, load_forecast), "load_forecast_mw"),
        genmix.select(*hour_key(prices, genmix), *MIX),
    ]
    lags = {name: ("price_eur_mwh", n) for name, n in zip(PRICE_LAGS, LAGS)}
    lags |= {name: (c, 24) for name, c in zip(MIX_LAGS, MIX)}
    lagged = _lag_features(sides, price_enrich_join, lags, rows_per_task, together)
    dated = lagged.withColumns({"hour_of_day": hour_of_day("ts_local"), "day_of_week": day_of_week("ts_local")})
    flagged = holiday_join(dated.withColumn("is_weekend", is_weekend("day_of_week")), holidays)
    columns = [c for c in PRICE_FEATURE_COLUMNS if not (day_ahead_safe and c == "price_lag_1h")]
    return flagged.select(*columns)


def feature_columns(df: DataFrame, target: str, leaking: Sequence[str] = ("price_eur_kwh",)) -> list[str]:
    """Model inputs: everything but identifiers, the target and columns that restate it."""
    left_out = {"asset_id", "ts_utc", "ts_local", "split", target, *leaking}
    return [c for c in df.columns if c not in left_out]
