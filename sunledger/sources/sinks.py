"""CSV sinks and the JSON metrics document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions.scalars import fixed_decimals

METRICS_SCHEMA = (
    "target STRING, model_version STRING, split STRING, model STRING, mae DOUBLE, mape DOUBLE, rmse DOUBLE"
)

# Decimals kept per raw table when it is written as CSV.
CSV_DECIMALS = {"entsoe_prices": 4, "entsoe_load_forecast": 1, "entsoe_genmix": 1, "load_hourly": 3}


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, values as they are; one part file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_csv_rounded(df: DataFrame, path: str, digits: int | Mapping[str, int]) -> None:
    """Header CSV with every floating column (or the named ones) at a fixed number of decimals."""
    if isinstance(digits, int):
        digits = {f.name: digits for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    write_csv(df.withColumns({c: fixed_decimals(c, n) for c, n in digits.items()}), path)


def write_raw_csv(df: DataFrame, table: str, path: str) -> None:
    """A raw table as header CSV with the decimals kept for it; tables without such a figure as they are."""
    if table in CSV_DECIMALS:
        write_csv_rounded(df, path, CSV_DECIMALS[table])
    else:
        write_csv(df, path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics rows (target, split, model, mae, mape, rmse) as JSON lines. One file: the table has a row per
    (target, split, model), whatever the size of the data behind it."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Stored metrics with each model's MAE lift (%) over the two naive models of the same split."""
    metrics = spark.read.schema(METRICS_SCHEMA).json(path)
    naive = metrics.groupBy("target", "split").agg(
        F.max(F.when(F.col("model") == "persistence_24h", F.col("mae"))).alias("persistence_mae"),
        F.max(F.when(F.col("model") == "seasonal_naive_168h", F.col("mae"))).alias("seasonal_mae"),
    )
    lift = lambda base: F.round((F.lit(1.0) - F.try_divide(F.col("mae"), F.col(base))) * 100, 4)
    return (
        metrics.join(naive, ["target", "split"])
        .withColumn("lift_vs_persistence_pct", lift("persistence_mae"))
        .withColumn("lift_vs_seasonal_pct", lift("seasonal_mae"))
        .drop("persistence_mae", "seasonal_mae")
    )
