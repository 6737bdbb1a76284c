"""The test tables read as energy series. Each method is a lazy view; FIXTURES.md describes the mapping, and
`oracle_text.py` holds the same definitions as SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions.timeops import utc_to_local
from sunledger.operators.balance import asset_facts, energy_balance, split_flows
from sunledger.operators.calendar_dim import holidays_of_years
from sunledger.operators.economics import border_flows
from sunledger.operators.features import PRICE_LAGS, PV_LAGS, price_features, pv_features
from sunledger.operators.forecasting import chronological_split, forecast_rows, stack_forecasts
from sunledger.operators.staging import genmix_pivot
from sunledger.session import pin_session, scratch_path
from sunledger.settings import BATTERY_CAPACITIES_KWH
from sunledger.sources.bucketed import bucket_count, read_bucketed, stage_bucketed
from sunledger.sources.tables import scan_ordered

# Event types as generation types; view/signup stand for PV, the other three for load.
GEN_TYPES = {
    "view": "solar",
    "click": "hydro_reservoir",
    "signup": "hydro_run_of_river",
    "purchase": "nuclear",
    "error": "fossil_gas",
}
ORDER_GEN_TYPES = {"O": "solar", "F": "hydro_reservoir", "P": "nuclear"}
BLEND_VERSION = "blend_v1"


def _plus_hours(day: str, hours: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(F.col(day).cast("timestamp")) + hours * 3600)


def _label(c: str, mapping: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(F.col(c) == k, F.lit(v)) for k, v in mapping.items()])


class Bindings:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_session(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- events: sparse hourly series of five assets
    @cached_property
    def event_rows(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            (F.col("user_id") % 5).cast("int").alias("asset_id"),
            F.col("ts").alias("stamp"),
            F.date_trunc("hour", "ts").alias("ts_utc"),
            "event_type",
            "value",
        )

    def _hourly(self, types: tuple[str, ...], name: str) -> DataFrame:
        sums = self.event_rows.where(F.col("event_type").isin(*types)).groupBy("asset_id", "ts_utc").agg(
            F.round(F.sum("value"), 2).alias(name)
        )
        return sums.select("asset_id", "ts_utc", utc_to_local("ts_utc").alias("ts_local"), name)

    @cached_property
    def pv_hourly(self) -> DataFrame:
        return self._hourly(("view", "signup"), "pv_power_kw")

    @cached_property
    def load_hourly(self) -> DataFrame:
        return self._hourly(("click", "purchase", "error"), "load_kw")

    @cached_property
    def load_raw(self) -> DataFrame:
        """Several rows per (asset, hour)."""
        return self.event_rows.where(F.col("event_type").isin("click", "purchase", "error")).select(
            "asset_id", "ts_utc", utc_to_local("ts_utc").alias("ts_local"), F.col("value").alias("load_kw")
        )

    @cached_property
    def weather_hourly(self) -> DataFrame:
        grouped = self.event_rows.groupBy("asset_id", "ts_utc").agg(
            F.max("value").alias("ghi_w_m2"),
            F.min("value").alias("temp_c"),
            (F.count(F.lit(1)) % 101).cast("int").alias("cloud_pct"),
            F.round(F.max("value") - F.min("value"), 2).alias("wind_ms"),
        )
        return grouped.withColumn("ts_local", utc_to_local("ts_utc"))

    @cached_property
    def genmix_long(self) -> DataFrame:
        return self.event_rows.select(
            "asset_id",
            "ts_utc",
            utc_to_local("ts_utc").alias("ts_local"),
            _label("event_type", GEN_TYPES).alias("gen_type"),
            F.col("value").alias("generation_mw"),
        )

    @cached_property
    def wide_mix(self) -> DataFrame:
        return self.genmix_long.groupBy("asset_id", "ts_utc").pivot("gen_type", list(GEN_TYPES.values())).agg(
            F.round(F.sum("generation_mw"), 2)
        )

    @cached_property
    def dim_asset(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.table("region").select(
            key.alias("asset_id"),
            (F.lit(0.2013577) + F.lit(0.02) * key).alias("retail_chf_per_kwh"),
            F.lit(0.0812343).alias("feed_in_chf_per_kwh"),
            (F.lit(30.1234567) + F.lit(10.0) * key).alias("grid_carbon_g_per_kwh"),
        )

    @cached_property
    def balance(self) -> DataFrame:
        return energy_balance(self.pv_hourly, self.load_hourly)

    @cached_property
    def facts(self) -> DataFrame:
        return asset_facts(self.balance, self.dim_asset)

    @cached_property
    def dispatch(self) -> DataFrame:
        """A stand-in for the external dispatch table: every capacity takes a share off both grid flows."""
        capacity = F.explode(F.array(*[F.lit(float(c)) for c in BATTERY_CAPACITIES_KWH]))
        rows = self.balance.select("asset_id", "ts_utc", "surplus_kw", "deficit_kw", capacity.alias("battery_capacity_kwh"))
        left = F.lit(1.0) - F.col("battery_capacity_kwh") / F.lit(1000.0)
        return rows.select(
            "asset_id",
            "ts_utc",
            "battery_capacity_kwh",
            (F.col("deficit_kw") * left).alias("grid_import_kw"),
            (F.col("surplus_kw") * left).alias("grid_export_kw"),
        )

    @cached_property
    def battery_flows(self) -> DataFrame:
        return border_flows(self.facts, self.dispatch)

    # ---- lineitem: the large hourly binding, one asset per supplier
    @cached_property
    def supplier_rows(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").cast("string").alias("asset_id"),
            _plus_hours("l_shipdate", F.col("l_partkey") % 24).alias("ts_utc"),
            "l_extendedprice",
            "l_returnflag",
            "l_linestatus",
            "l_quantity",
            "l_discount",
        )

    @cached_property
    def supplier_hourly(self) -> DataFrame:
        power = lambda flag: F.round(F.sum(F.when(flag, F.col("l_extendedprice")).otherwise(F.lit(0.0))), 2)
        is_pv = F.col("l_returnflag") == "N"
        sums = self.supplier_rows.groupBy("asset_id", "ts_utc").agg(
            power(is_pv).alias("pv_power_kw"), power(~is_pv).alias("load_kw")
        )
        return sums.withColumn("ts_local", utc_to_local("ts_utc"))

    @cached_property
    def supplier_weather(self) -> DataFrame:
        grouped = self.supplier_rows.where(F.col("l_linestatus") == "F").groupBy("asset_id", "ts_utc").agg(
            F.max("l_extendedprice").alias("ghi_w_m2"),
            F.min("l_quantity").alias("temp_c"),
            (F.count(F.lit(1)) % 101).cast("int").alias("cloud_pct"),
            F.max("l_discount").alias("wind_ms"),
        )
        return grouped.withColumn("ts_local", utc_to_local("ts_utc"))

    @cached_property
    def supplier_assets(self) -> DataFrame:
        """Tariffs by the supplier's region stand in for the asset dimension."""
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        site = self.table("supplier").select(F.col("s_suppkey").cast("string").alias("asset_id"), F.col("s_nationkey").alias("n_nationkey"))
        tariffs = self.dim_asset.withColumnRenamed("asset_id", "n_regionkey")
        return site.join(nation, "n_nationkey").join(tariffs, "n_regionkey")

    @cached_property
    def supplier_facts(self) -> DataFrame:
        """Fleet-wide facts."""
        return asset_facts(split_flows(self.supplier_hourly), self.supplier_assets)

    # ---- orders: an hourly price series per priority, over more than six years and several DST changes
    @cached_property
    def order_rows(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey",
            F.col("o_orderpriority").alias("asset_id"),
            _plus_hours("o_orderdate", F.col("o_orderkey") % 24).cast("timestamp_ntz").alias("wall"),
            "o_orderstatus",
            "o_totalprice",
        )

    @cached_property
    def order_series(self) -> DataFrame:
        return self.order_rows.withColumn("ts_utc", F.col("wall").cast("timestamp"))

    @cached_property
    def price_hourly(self) -> DataFrame:
        sums = self.order_series.groupBy("asset_id", "ts_utc").agg(F.round(F.sum("o_totalprice"), 2).alias("price_eur_mwh"))
        return sums.select(
            "asset_id",
            "ts_utc",
            utc_to_local("ts_utc").alias("ts_local"),
            "price_eur_mwh",
            (F.col("price_eur_mwh") / F.lit(1000.0)).alias("price_eur_kwh"),
        )

    @cached_property
    def price_weather(self) -> DataFrame:
        grouped = self.order_series.where(F.col("o_orderstatus") == "O").groupBy("asset_id", "ts_utc").agg(
            F.max("o_totalprice").alias("ghi_w_m2"),
            F.min("o_totalprice").alias("temp_c"),
            (F.count(F.lit(1)) % 101).cast("int").alias("cloud_pct"),
            F.count(F.lit(1)).cast("double").alias("wind_ms"),
        )
        return grouped.withColumn("ts_local", utc_to_local("ts_utc"))

    @cached_property
    def price_load_forecast(self) -> DataFrame:
        sums = self.order_series.where(F.col("o_orderstatus") == "F").groupBy("asset_id", "ts_utc").agg(
            F.round(F.sum("o_totalprice"), 2).alias("load_forecast_mw")
        )
        return sums.withColumn("ts_local", utc_to_local("ts_utc"))

    @cached_property
    def price_genmix(self) -> DataFrame:
        long = self.order_series.select(
            "asset_id",
            "ts_utc",
            utc_to_local("ts_utc").alias("ts_local"),
            _label("o_orderstatus", ORDER_GEN_TYPES).alias("gen_type"),
            F.col("o_totalprice").alias("generation_mw"),
        )
        return genmix_pivot(long)

    @cached_property
    def holidays(self) -> DataFrame:
        return holidays_of_years(self.table("orders").select(F.year("o_orderdate").alias("year")))

    @cached_property
    def price_features(self) -> DataFrame:
        return price_features(
            self.price_hourly,
            self.holidays,
            self.price_weather,
            self.price_load_forecast,
            self.price_genmix,
        )

    @cached_property
    def pv_features(self) -> DataFrame:
        return pv_features(self.supplier_hourly, self.supplier_weather)

    # The feature tables as stored marts, for the metrics, which read them several times. All else is lazy.
    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def bucketed(self, *frames: DataFrame, rows_per_bucket: int = 10_000) -> list[DataFrame]:
        """The series stored in as many buckets as the first one's rows ask for."""
        buckets, stored = bucket_count(frames[0].count(), rows_per_bucket), []
        for df in frames:
            staged = stage_bucketed(df, scratch_path(self.spark, "series"), buckets)
            staged.publish()
            stored.append(read_bucketed(self.spark, staged.path))
        return stored

    @cached_property
    def price_mart(self) -> DataFrame:
        return self._stored(self.price_features, "price-features")

    @cached_property
    def pv_mart(self) -> DataFrame:
        return self._stored(self.pv_features, "pv-features")

    @cached_property
    def price_split(self) -> DataFrame:
        return chronological_split(scan_ordered(self.price_features, PRICE_LAGS))

    @cached_property
    def pv_split(self) -> DataFrame:
        return chronological_split(scan_ordered(self.pv_features, PV_LAGS))

    # The split rows as stored tables, for the trained models: a fit passes over them several times, and scoring once more.
    @cached_property
    def price_split_stored(self) -> DataFrame:
        return self._stored(self.price_split, "price-split")

    @cached_property
    def pv_split_stored(self) -> DataFrame:
        return self._stored(self.pv_split, "pv-split")

    def blend(self, split: DataFrame, target: str, prefix: str) -> DataFrame:
        """A fixed blend of both naive forecasts over the test window, standing in for a trained model."""
        test = split.where(F.col("split") == "test")
        guess = F.col(f"{prefix}_lag_24h") * F.lit(0.5) + F.col(f"{prefix}_lag_168h") * F.lit(0.5)
        return forecast_rows(test.withColumn("y_pred", guess), target, BLEND_VERSION)

    @cached_property
    def price_blend(self) -> DataFrame:
        return self.blend(self.price_split, "price_eur_mwh", "price")

    @cached_property
    def pv_blend(self) -> DataFrame:
        return self.blend(self.pv_split, "pv_power_kw", "pv")

    @cached_property
    def forecasts(self) -> DataFrame:
        return stack_forecasts(self.price_blend, self.pv_blend)
