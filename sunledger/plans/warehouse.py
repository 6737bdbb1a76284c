"""The whole path over stored tables: raw CSV -> staged series -> features and facts -> KPI marts -> forecasts.

Raw, intermediate and mart tables are Parquet folders. Staging stays lazy, or is stored in buckets that many rebuilds join
and lag without a shuffle (`store_staged`). Hourly tables are partitioned by year
and sorted by (asset, hour) inside each file, so date and asset filters skip files and row groups.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.operators import balance, economics, evaluation, features, forecasting, quality, rollups, staging
from sunledger.session import pin_session
from sunledger.settings import ACCEPTED_RANGES, NOT_NULL, RAW_BOUNDS, ROWS_PER_TASK, UNIQUE_KEYS, ZONE
from sunledger.sources.bucketed import bucket_count, read_bucketed, stage_bucketed
from sunledger.sources.schemas import RAW_TABLES
from sunledger.sources.sinks import read_metrics, write_metrics
from sunledger.sources.tables import SOURCE, read_raw_table, replace_table, restore_table, scan_ordered, stage_table


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str, zone: str = ZONE):
        self.spark = pin_session(spark)
        self.folder = folder.rstrip("/")
        self.zone = zone

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def register(self, names: Sequence[str]) -> None:
        """Temp views by table name, for SQL."""
        for name in names:
            self.table(name).createOrReplaceTempView(name)

    def _store(self, name: str, df: DataFrame) -> int:
        """Write a table beside the old one, check nulls and ranges by figures observed in that pass, and publish it."""
        figures = quality.column_figures(NOT_NULL.get(name, ()), ACCEPTED_RANGES.get(name))
        audit = lambda staged: self._must_pass(quality.report_figures(self.spark, staged.figures, name))
        if "ts_utc" not in df.columns:
            return replace_table(df, self.path(name), figures=figures, audit=audit)
        dated = df.withColumn("year", F.year("ts_utc"))
        return replace_table(dated, self.path(name), ["year"], ["asset_id", "ts_utc"], figures, audit)

    # ---- raw
    def load_raw(
        self,
        csv_folder: str,
        tables: Sequence[str] = tuple(RAW_TABLES),
        window: tuple[str, str] | None = None,
        annual_kwh: float | None = None,
    ) -> dict[str, int]:
        """Replace the raw tables by their CSV files and return the row counts. A null in a required column, an
        unexpected repeated key, a series that lacks hours of `window` (start, end), a file whose series are not in the order
        of time, or a year's load off `annual_kwh` fails the load. Without a window, series are held against the hours
        between the first and last of the table.

        All files are written beside the stored tables and checked there; only then do they take their places. A load that
        fails leaves every table as it was. Nulls, bounds and row counts come with the write.
        """
        staged = {}
        try:
            for name in tables:
                entry, path = RAW_TABLES[name], self.path(f"raw/{name}")
                restore_table(self.spark, path)
                frame = read_raw_table(self.spark, csv_folder, name, with_source=True)
                figures = quality.column_figures(entry.required, RAW_BOUNDS[name])
                if "ts_utc" in frame.columns:
                    figures.append(quality.clock_figure(self.zone))
                staged[name] = stage_table(frame, path, figures=figures)
            frames = {name: s.read() for name, s in staged.items()}
            reports = [quality.report_figures(self.spark, s.figures, name, "raw_bounds") for name, s in staged.items()]
            for name, frame in frames.items():
                reports += self._raw_checks(name, frame, window, annual_kwh)
                severity = "error" if RAW_TABLES[name].ordered else "warn"
                reports.append(quality.check_source_order(frame, name, RAW_TABLES[name].key[-1], severity=severity))
            self._must_pass(quality.all_checks(reports))
            for s in staged.values():
                s.publish()
        finally:
            for s in staged.values():
                s.discard()
        return {name: s.figures["n_rows"] for name, s in staged.items()}

    def raw(self, name: str) -> DataFrame:
        """A raw table without the columns that say where its rows came from."""
        return self.table(f"raw/{name}").drop(*SOURCE)

    def _raw_checks(self, name: str, frame: DataFrame, window: tuple[str, str] | None, annual_kwh: float | None) -> list[DataFrame]:
        known = [t.name for t in RAW_TABLES.values() if t.duplicates_known]
        checks = [quality.check_keys(frame, name, RAW_TABLES[name].key, known, window)]
        if annual_kwh is not None and name == "load_hourly":
            checks.append(quality.check_annual_total(frame, name, "load_kw", annual_kwh))
        return checks

    def raw_report(
        self,
        tables: Sequence[str] = tuple(RAW_TABLES),
        window: tuple[str, str] | None = None,
        annual_kwh: float | None = None,
    ) -> DataFrame:
        """The checks of a load, of the stored tables: two scans of each, one for its columns and one for its keys."""
        reports = []
        for name in tables:
            frame = self.raw(name)
            reports.append(quality.check_columns(frame, name, RAW_TABLES[name].required, RAW_BOUNDS[name], "raw_bounds"))
            if "ts_utc" in frame.columns:
                reports.append(quality.check_local_time(frame, name, self.zone))
            reports += self._raw_checks(name, frame, window, annual_kwh)
        return quality.all_checks(reports)

    @staticmethod
    def _must_pass(report: DataFrame) -> None:
        failed = report.where((F.col("severity") == "error") & (F.col("bad_rows") > 0))
        rows = failed.limit(20).collect()
        if rows:
            raise ValueError(f"{failed.count()} checks failed, the first: " + "; ".join(f"{r.table_name}.{r.column_name}: {r.check_name} {r.bad_rows}" for r in rows))

    # ---- staging (lazy)
    def staged(self) -> dict[str, DataFrame]:
        raw = self.raw
        return {
            "stg_pvgis_hourly": staging.stg_pv(raw("pvgis_hourly"), self.zone),
            "stg_load_hourly": staging.dedupe_avg(raw("load_hourly")),
            "stg_entsoe_prices": staging.stg_prices(raw("entsoe_prices")),
            "stg_openmeteo_hourly": staging.stg_weather(raw("openmeteo_hourly")),
            "stg_entsoe_load_forecast": staging.stg_load_forecast(raw("entsoe_load_forecast")),
            "stg_entsoe_genmix": staging.genmix_pivot(raw("entsoe_genmix")),
        }

    def store_staged(self, rows_per_bucket: int = ROWS_PER_TASK, unit: str = "year") -> dict[str, int]:
        """Store the staged series in buckets by (asset, period), checked by figures of the pass that writes, and return
        their rows. All have the same number of buckets, taken from the largest raw table; all are written and checked before
        the first takes its place."""
        frames, staged = self.staged(), {}
        buckets = bucket_count(max(self.raw(name).count() for name in RAW_TABLES), rows_per_bucket)
        try:
            for name, df in frames.items():
                figures = quality.column_figures(NOT_NULL[name], ACCEPTED_RANGES.get(name))
                restore_table(self.spark, self.path(f"staged/{name}"))
                staged[name] = stage_bucketed(df, self.path(f"staged/{name}"), buckets, unit=unit, figures=figures)
            self._must_pass(quality.all_checks([quality.report_figures(self.spark, s.figures, name) for name, s in staged.items()]))
            for s in staged.values():
                s.publish()
        finally:
            for s in staged.values():
                s.discard()
        return {name: s.figures["n_rows"] for name, s in staged.items()}

    def stored_series(self) -> dict[str, DataFrame]:
        return {name: read_bucketed(self.spark, self.path(f"staged/{name}")) for name in self.staged()}

    # ---- intermediate tables and marts
    def build(self, assets: DataFrame, holidays: DataFrame, from_stored: bool = False) -> dict[str, int]:
        """Write the tables that others read, each from the stored one before it; `from_stored`: the first from the buckets of
        `store_staged`, which must be newer than the raw tables."""
        stg = self.stored_series() if from_stored else self.staged()
        rows = {}
        rows["int_hourly_energy_balance"] = self._store(
            "int_hourly_energy_balance",
            balance.energy_balance(stg["stg_pvgis_hourly"], stg["stg_load_hourly"]),
        )
        rows["fct_asset_performance"] = self._store(
            "fct_asset_performance", balance.asset_facts(self.table("int_hourly_energy_balance"), assets, assets.count())
        )
        rows["mrt_zev_kpis_daily"] = self._store(
            "mrt_zev_kpis_daily", rollups.kpi_daily(self.table("fct_asset_performance"))
        )
        rows["mrt_zev_kpis_monthly"] = self._store(
            "mrt_zev_kpis_monthly", rollups.kpi_monthly(self.table("mrt_zev_kpis_daily"))
        )
        rows["fct_hourly_market"] = self._store(
            "fct_hourly_market",
            features.price_features(
                stg["stg_entsoe_prices"],
                holidays,
                stg["stg_openmeteo_hourly"],
                stg["stg_entsoe_load_forecast"],
                stg["stg_entsoe_genmix"],
                together=True,
            ),
        )
        rows["fct_pv_features"] = self._store(
            "fct_pv_features",
            features.pv_features(stg["stg_pvgis_hourly"], stg["stg_openmeteo_hourly"], together=True),
        )
        return rows

    def build_battery(self, dispatch: DataFrame) -> dict[str, int]:
        """Battery marts from a dispatch table, which must have no nulls, no values out of range and one row for each
        (asset, hour, capacity)."""
        staged, name = staging.stg_battery(dispatch, self.zone), "stg_battery_simulations"
        key = ["asset_id", "ts_utc", "battery_capacity_kwh"]
        self._must_pass(
            quality.check_columns(staged, name, NOT_NULL[name], ACCEPTED_RANGES[name]).unionByName(quality.check_unique(staged, name, key))
        )
        rows = {"fct_asset_performance_battery": self._store(
            "fct_asset_performance_battery", economics.border_flows(self.table("fct_asset_performance"), staged)
        )}
        rows["mrt_zev_kpis_battery_daily"] = self._store(
            "mrt_zev_kpis_battery_daily", economics.battery_daily(self.table("fct_asset_performance_battery"))
        )
        rows["mrt_zev_kpis_battery_monthly"] = self._store(
            "mrt_zev_kpis_battery_monthly", economics.battery_monthly(self.table("mrt_zev_kpis_battery_daily"))
        )
        return rows

    def report(self, tables: dict[str, DataFrame]) -> DataFrame:
        """Not-null, unique and range checks of staged or stored tables."""
        reports = []
        for name, df in tables.items():
            reports.append(quality.check_columns(df, name, NOT_NULL[name], ACCEPTED_RANGES.get(name)))
            if name in UNIQUE_KEYS:
                reports.append(quality.check_unique(df, name, UNIQUE_KEYS[name]))
        return quality.all_checks(reports)

    # ---- forecasts
    def splits(self, by: Sequence[str] = ()) -> dict[str, DataFrame]:
        """The labelled marts; with `by`, each series counts its months from its own first one."""
        price = scan_ordered(self.table("fct_hourly_market").drop("year"), features.PRICE_LAGS)
        pv = scan_ordered(self.table("fct_pv_features").drop("year"), features.PV_LAGS)
        return {
            "price_eur_mwh": forecasting.chronological_split(price, by=by),
            "pv_power_kw": forecasting.chronological_split(pv, by=by),
        }

    def split_report(self, splits: dict[str, DataFrame]) -> DataFrame:
        """Splits keep to their months, share no hour and have no more rows than their mart."""
        reports = []
        for (target, split), mart in zip(splits.items(), ("fct_hourly_market", "fct_pv_features")):
            reports += [
                quality.check_split_bounds(split, target),
                quality.check_split_overlap(split, target),
                quality.check_split_total(split, self.table(mart), target),
            ]
        return quality.all_checks(reports)

    def train(self, **options) -> dict[str, bool]:
        """Train both models; each is saved only if it passes its gate."""
        splits = self.splits()
        self._must_pass(self.split_report(splits))
        saved = {}
        for target, fit, gate in (
            ("price_eur_mwh", forecasting.train_price, forecasting.price_gate),
            ("pv_power_kw", forecasting.train_pv, forecasting.pv_gate),
        ):
            model = fit(splits[target], **options)
            verdict = gate(forecasting.score_test_window(splits[target], model))
            saved[target] = forecasting.save_if_accepted(model, verdict, self.spark, self.path(f"models/{target}"))
        return saved

    def predict(self) -> int:
        """Score the test window with the saved models and replace the forecast table."""
        parts = []
        for target, split in self.splits().items():
            model = forecasting.load_bundle(self.spark, self.path(f"models/{target}"))
            scored = forecasting.score_test_window(split, model)
            parts.append(forecasting.forecast_rows(scored, model.target, model.version))
        return replace_table(forecasting.stack_forecasts(*parts), self.path("fct_forecasts"), partition_by=["target"])

    def evaluate(self) -> DataFrame:
        """Score the stored forecasts against both baselines, store the metrics and return them with their lift."""
        forecasts = self.table("fct_forecasts")
        parts = []
        for target, mart, prefix in (
            ("price_eur_mwh", "fct_hourly_market", "price"),
            ("pv_power_kw", "fct_pv_features", "pv"),
        ):
            one = evaluation.filter_target(forecasts, target)
            attached = evaluation.attach_baselines(one, self.table(mart), prefix)
            unmatched = evaluation.check_lag_alignment(attached).first()
            if any(unmatched):
                warnings.warn(f"{target}: forecast rows without a baseline: {unmatched.asDict()}", stacklevel=2)
            parts.append(evaluation.error_metrics_by_split(attached, target))
        write_metrics(parts[0].unionByName(parts[1]), self.path("metrics"))
        return read_metrics(self.spark, self.path("metrics"))
