"""Parsers for API replies and wide tables that are already landed as files or columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.scalars import normalize_label, per_thousand
from sunledger.functions.timeops import utc_to_local
from sunledger.settings import ZONE
from sunledger.sources.schemas import PV_RECORD_TIME, PV_REPLY, WEATHER_REPLY


def explode_records(
    replies: DataFrame,
    body: str = "body",
    keep: Sequence[str] = ("asset_id",),
    literals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """PV replies (JSON text with `outputs.hourly[]`) to one row per record.

    `keep` names reply-level columns to carry along; `literals` adds site columns (lat, lon, peak power).
    """
    record = (
        replies.select(*keep, F.from_json(F.col(body), PV_REPLY).alias("reply"))
        .select(*keep, F.explode("reply.outputs.hourly").alias("r"))
    )
    site = [value.alias(name) for name, value in (literals or {}).items()]
    return record.select(
        *keep,
        *site,
        F.to_timestamp_ntz(F.col("r.time"), F.lit(PV_RECORD_TIME)).alias("ts_local"),
        per_thousand(F.col("r.P")).alias("pv_power_kw"),
        F.col("r.P").alias("pv_power_w"),
        F.col("r")["G(i)"].alias("irradiance_w_m2"),
        F.col("r.H_sun").alias("sun_height_deg"),
        F.col("r.T2m").alias("temp_2m_c"),
        F.col("r.WS10m").alias("wind_speed_m_s"),
        F.col("r.Int").alias("reconstruction_flag"),
    )


def explode_parallel_arrays(
    replies: DataFrame, body: str = "body", keep: Sequence[str] = ("asset_id",), zone: str = ZONE
) -> DataFrame:
    """Weather replies (JSON text with a struct of equally long arrays) to one row per hour."""
    hourly = replies.select(*keep, F.from_json(F.col(body), WEATHER_REPLY)["hourly"].alias("h"))
    zipped = F.arrays_zip(
        F.col("h.time").alias("time"),
        F.col("h.shortwave_radiation").alias("ghi"),
        F.col("h.temperature_2m").alias("temp"),
        F.col("h.cloud_cover").alias("cloud"),
        F.col("h.wind_speed_10m").alias("wind"),
    )
    rows = hourly.select(*keep, F.explode(zipped).alias("r"))
    return (
        rows.withColumn("ts_utc", F.to_timestamp(F.col("r.time")))
        .select(
            *keep,
            "ts_utc",
            utc_to_local("ts_utc", zone).alias("ts_local"),
            F.col("r.ghi").alias("ghi_w_m2"),
            F.col("r.temp").alias("temp_c"),
            F.col("r.cloud").cast("int").alias("cloud_pct"),
            F.col("r.wind").alias("wind_ms"),
        )
    )


def select_generation_columns(wide: DataFrame, ids: Sequence[str], separator: str = "|") -> DataFrame:
    """Keep the generation columns of a two-level header written as 'type|kind'; consumption is dropped."""
    kept = []
    for name in wide.columns:
        if name in ids:
            continue
        kind = name.split(separator, 1)[1] if separator in name else ""
        if "consumption" not in kind.lower():
            kept.append(F.col(f"`{name}`").alias(name.split(separator, 1)[0]))
    return wide.select(*ids, *kept)


def melt_wide(
    wide: DataFrame,
    ids: Sequence[str] = ("asset_id", "ts_utc"),
    label: str = "gen_type",
    value: str = "generation_mw",
) -> DataFrame:
    """One row per (ids, column) with a value; labels are normalized."""
    columns = [F.col(f"`{c}`") for c in wide.columns if c not in ids]
    long = wide.unpivot([F.col(c) for c in ids], columns, label, value)
    return long.dropna(subset=[value]).withColumn(label, normalize_label(label))


def first_value_column(reply: DataFrame, ids: Sequence[str], name: str) -> DataFrame:
    """Ids plus the first value column of a reply, whatever it is called."""
    value = next(c for c in reply.columns if c not in ids)
    return reply.select(*ids, F.col(f"`{value}`").alias(name))


def parse_price_series(series: DataFrame, value: str = "value", zone: str = ZONE) -> DataFrame:
    """(asset_id, ts_utc, value) to the raw price columns."""
    return series.select(
        "asset_id",
        F.col("ts_utc").cast("timestamp").alias("ts_utc"),
        utc_to_local("ts_utc", zone).alias("ts_local"),
        F.col(value).cast("double").alias("price_eur_mwh"),
        per_thousand(F.col(value).cast("double")).alias("price_eur_kwh"),
    )


def parse_load_forecast(reply: DataFrame, zone: str = ZONE) -> DataFrame:
    """(asset_id, ts_utc, one or more value columns) to the raw load-forecast columns."""
    first = first_value_column(reply, ("asset_id", "ts_utc"), "load_forecast_mw")
    return first.select(
        "asset_id",
        F.col("ts_utc").cast("timestamp").alias("ts_utc"),
        utc_to_local("ts_utc", zone).alias("ts_local"),
        F.col("load_forecast_mw").cast("double").alias("load_forecast_mw"),
    )


def parse_generation_mix(
    wide: DataFrame, ids: Sequence[str] = ("asset_id", "ts_utc"), zone: str = ZONE
) -> DataFrame:
    """Wide generation reply to the raw long table."""
    long = melt_wide(select_generation_columns(wide, ids), ids)
    return long.select(
        "asset_id",
        F.col("ts_utc").cast("timestamp").alias("ts_utc"),
        utc_to_local("ts_utc", zone).alias("ts_local"),
        "gen_type",
        F.col("generation_mw").cast("double").alias("generation_mw"),
    )
