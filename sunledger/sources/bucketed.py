"""Stored series in buckets of (series, period of time): joins and lags of a rebuild read them without a shuffle."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.settings import ROWS_PER_TASK
from sunledger.sources.tables import Staged, stage_table

# The row's period in its series; lags and joins take it as the time range of `operators.series.in_ranges`.
PERIOD = "_range"
BUCKETS = "buckets"


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_TASK) -> int:
    """Buckets for the largest of the tables that are joined: a power of two, so tables of a smaller one still fit."""
    return 1 << math.ceil(math.log2(max(1.0, rows / rows_per_bucket)))


def period(ts: str = "ts_utc", unit: str = "year") -> Column:
    """Number of the row's period: its year, or the months since year 0 for series of finer grain. A row without an instant
    comes first, as it does in the order of time."""
    numbers = {"year": F.year(ts), "month": F.year(ts) * 12 + F.month(ts)}
    return F.coalesce(numbers[unit], F.lit(0))


def stage_bucketed(
    df: DataFrame,
    path: str,
    buckets: int,
    key: str = "asset_id",
    ts: str = "ts_utc",
    unit: str = "year",
    figures: Sequence[Column] = (),
) -> Staged:
    """Write a series table beside `path`, in `buckets` files by (key, period), each sorted by key, period and instant.

    A hot series is spread over its periods, so no bucket holds more of it than a period beside its share. The one shuffle
    is that of the write. The number of buckets is stored in the files' own schema; a table without rows has none.
    """
    told, about = df.withColumn(PERIOD, period(ts, unit)), df.schema[key].metadata
    staged = stage_table(
        told.withMetadata(key, {**about, BUCKETS: buckets}), path, sort_by=[key, PERIOD, ts], figures=figures, buckets=(buckets, [key, PERIOD])
    )
    if not staged.figures["n_rows"]:  # no bucket was written, and with it no schema
        staged.discard()
        told.limit(0).withMetadata(key, {**about, BUCKETS: 0}).write.parquet(staged.beside)
    return staged


def read_bucketed(spark: SparkSession, path: str, key: str = "asset_id") -> DataFrame:
    """A table of `stage_bucketed`, with its column `_range`. Where the session's catalog is needed to tell Spark of the
    buckets, the name is taken out again at once; the files are untouched."""
    plain = spark.read.parquet(path)
    schema, buckets = plain.schema, plain.schema[key].metadata.get(BUCKETS)
    if buckets is None:
        raise ValueError(f"{path} has no buckets by {key}")
    if buckets == 0:
        return plain
    name, columns = f"bucketed_{uuid.uuid4().hex}", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`, `{PERIOD}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
