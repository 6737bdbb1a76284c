"""KPI marts and series rollups. All are partial/final aggregates, so a hot asset collapses before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.scalars import per_thousand, ratio, safe_ratio
from sunledger.functions.timeops import floor_hour, hour_of_day, local_date, month_start, season
from sunledger.operators.balance import TARIFF_COLUMNS
from sunledger.operators.medians import agg_with_median
from sunledger.operators.sizing import join_dimension

ENERGY = {
    "total_pv_kwh": "pv_power_kw",
    "total_load_kwh": "load_kw",
    "self_consumption_kwh": "direct_self_consumption_kw",
    "surplus_kwh": "surplus_kw",
    "deficit_kwh": "deficit_kw",
}


def exact_sum(column: str, digits: int) -> Column:
    """Sum of figures already rounded to `digits` decimals, added as decimals: the result does not depend on the
    order of the rows, so rounding it again is reproducible."""
    return F.sum(F.col(column).cast(f"decimal(18,{digits})"))


def kpi_daily(facts: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Daily KPIs per asset, local day and tariff; kW over one hour is kWh. With `assets`, hours without tariffs are summed
    first and the tariffs joined to the days, of which there are fewer."""
    keys = ["asset_id", local_date("ts_local").alias("date")]
    energies = [F.sum(c).alias(name) for name, c in ENERGY.items()]
    if assets is None:
        sums = facts.groupBy(*keys, *TARIFF_COLUMNS).agg(*energies)
    else:
        sums = join_dimension(facts.groupBy(*keys).agg(*energies), assets.select("asset_id", *TARIFF_COLUMNS), "asset_id")
    kept = F.col("self_consumption_kwh")
    return sums.select(
        "asset_id",
        "date",
        *ENERGY,
        safe_ratio(kept, "total_pv_kwh").alias("self_consumption_ratio"),
        safe_ratio(kept, "total_load_kwh").alias("autarky_ratio"),
        F.round(per_thousand(kept * F.col("grid_carbon_g_per_kwh")), 3).alias("co2_avoided_kg"),
        F.round(kept * (F.col("retail_chf_per_kwh") - F.col("feed_in_chf_per_kwh")), 2).alias("chf_saved"),
    )


def kpi_monthly(daily: DataFrame) -> DataFrame:
    """Monthly KPIs from the daily mart: ratios are volume-weighted and NULL on an empty denominator; CO2 and
    money add up the rounded daily figures."""
    sums = daily.groupBy("asset_id", month_start("date").alias("month")).agg(
        *[F.sum(c).alias(c) for c in ENERGY],
        F.round(exact_sum("co2_avoided_kg", 3), 2).cast("double").alias("co2_avoided_kg"),
        exact_sum("chf_saved", 2).cast("double").alias("chf_saved"),
    )
    return sums.select(
        "asset_id",
        "month",
        *ENERGY,
        ratio("self_consumption_kwh", "total_pv_kwh").alias("self_consumption_ratio"),
        ratio("self_consumption_kwh", "total_load_kwh").alias("autarky_ratio"),
        "co2_avoided_kg",
        "chf_saved",
    )


def kpi_overview(monthly: DataFrame, n_years: float = 5) -> DataFrame:
    """Headline figures: unweighted means of the monthly ratios, CO2 in tonnes, money per year."""
    return monthly.agg(
        F.avg("self_consumption_ratio").alias("avg_sc_ratio"),
        F.avg("autarky_ratio").alias("avg_autarky"),
        per_thousand(F.sum("co2_avoided_kg")).alias("total_co2_t"),
        (F.sum("chf_saved") / F.lit(float(n_years))).alias("avg_chf_yr"),
    )


def filter_years(monthly: DataFrame, years: Sequence[int] = (), month: str = "month") -> DataFrame:
    """Rows of the chosen years; no choice means all."""
    return monthly.where(F.year(month).isin(*years)) if years else monthly


def kpi_monthly_report(monthly: DataFrame, years: Sequence[int] = (), ordered: bool = True) -> DataFrame:
    """Report view of the monthly mart: flows in MWh, ratios in percent."""
    report = filter_years(monthly, years).select(
        "asset_id",
        "month",
        per_thousand("self_consumption_kwh").alias("self_consumed_mwh"),
        per_thousand("deficit_kwh").alias("grid_import_mwh"),
        per_thousand("surplus_kwh").alias("exported_mwh"),
        (F.col("self_consumption_ratio") * 100).alias("self_consumption_pct"),
        (F.col("autarky_ratio") * 100).alias("autarky_pct"),
        "co2_avoided_kg",
        "chf_saved",
    )
    return report.orderBy("month", "asset_id") if ordered else report


def resample_hourly(series: DataFrame, value: str, ts: str = "ts_local", by: Sequence[str] = ("asset_id",)) -> DataFrame:
    """Sub-hourly power to the hourly mean."""
    return series.groupBy(*by, floor_hour(ts).cast(series.schema[ts].dataType).alias(ts)).agg(
        F.avg(value).alias(value)
    )


def daily_mean(series: DataFrame, value: str, ts: str = "ts_local", by: Sequence[str] = ("asset_id",)) -> DataFrame:
    return series.groupBy(*by, local_date(ts).alias("date")).agg(F.avg(value).alias(f"mean_{value}"))


def monthly_energy(series: DataFrame, value: str, ts: str = "ts_local", by: Sequence[str] = ("asset_id",)) -> DataFrame:
    """Monthly energy in MWh of a kW series."""
    return series.groupBy(*by, month_start(ts).alias("month")).agg(per_thousand(F.sum(value)).alias("energy_mwh"))


def annual_total(
    series: DataFrame,
    value: str,
    ts: str = "ts_local",
    by: Sequence[str] = ("asset_id",),
    target_kwh: float | None = None,
) -> DataFrame:
    """Yearly energy, with its deviation (%) from a target when one is given."""
    totals = series.groupBy(*by, F.year(ts).alias("year")).agg(F.sum(value).alias("total_kwh"))
    if target_kwh is None:
        return totals
    deviation = (F.col("total_kwh") - F.lit(target_kwh)) / F.lit(target_kwh) * 100
    return totals.withColumn("deviation_pct", deviation)


def scale_to_annual_total(
    series: DataFrame, value: str, target_kwh: float, ts: str = "ts_local", by: Sequence[str] = ("asset_id",)
) -> DataFrame:
    """Scale each (series, year) so that it sums to the target.

    The totals are aggregated and joined back rather than taken over a window: a window would bring a whole
    (series, year) into one task; the totals have a row per series and year, which adaptive execution broadcasts when
    they are few. Keys are compared as structs, in which a NULL equals a NULL, so rows without asset or time stay.
    """
    dated = series.withColumn("_k", F.struct(*by, F.year(ts).alias("_year")))
    totals = dated.groupBy("_k").agg(F.sum(value).alias("_total"))
    scaled = F.col(value) * F.lit(float(target_kwh)) / F.col("_total")
    return dated.join(totals, "_k").withColumn(value, scaled).select(*series.columns)


def hourly_shape_median(series: DataFrame, value: str, ts: str = "ts_local") -> DataFrame:
    """Median by local hour, winter against summer."""
    rows = series.select(season(ts).alias("season"), hour_of_day(ts).alias("hour"), value).where(
        F.col("season").isNotNull()
    )
    return agg_with_median(rows, ["season", "hour"], value, f"median_{value}")


def series_summary(
    series: DataFrame,
    value: str,
    ts: str = "ts_utc",
    by: Sequence[str] = ("asset_id",),
) -> DataFrame:
    """Period, min, max, mean and exact median of a series."""
    others = [
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count(value).alias("n"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
    ]
    return agg_with_median(series, by, value, "median_value", others)


def summary_by_type(long: DataFrame, value: str = "generation_mw", label: str = "gen_type") -> DataFrame:
    return long.groupBy(label).agg(
        F.avg(value).alias("mean_mw"), F.max(value).alias("max_mw"), F.count(value).alias("n_rows")
    )


def concat_years(frames: Mapping[int | None, DataFrame]) -> DataFrame:
    """One frame of several, one for each year, matched by column name; a column that some years lack is null there. `year`
    says which frame a row is from."""
    dated = [rows.withColumn("year", F.lit(year).cast("long")) for year, rows in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dated)


def distinct_series(long: DataFrame, ts: str = "ts_utc", label: str = "gen_type") -> DataFrame:
    """Distinct timestamps, labels and years of a long table.

    Timestamps are made distinct on their own (a shuffle on the timestamp itself); years follow from them.
    """
    stamps = long.select(F.col(ts).alias("t")).distinct()
    labels = long.select(F.col(label).alias("t")).distinct()
    rows = lambda df, what: df.select(F.lit(what).alias("kind"), F.col("t").cast("string").alias("entry"))
    years = stamps.select(F.year("t").alias("t")).distinct()
    counted = rows(stamps, "timestamp").groupBy("kind").agg(F.count("entry").cast("string").alias("entry"))
    return counted.unionByName(rows(labels, "label")).unionByName(rows(years, "year"))


def count_by(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
