"""Data-quality checks. Each returns rows (check_name, table_name, column_name, bad_rows, severity); a check
passes when `bad_rows` is 0. `passed` turns a set of them into one verdict row per severity."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger.functions.timeops import month_index, utc_to_local
from sunledger.operators.series import ordering_check_blocks
from sunledger.settings import (
    ANNUAL_TOLERANCE_PCT,
    MIN_HOUR_SHARE,
    TEST_MONTHS,
    TRAIN_MONTHS,
    VALIDATION_MONTHS,
    ZONE,
)
from sunledger.sources.tables import SOURCE

REPORT_SCHEMA = "check_name STRING, table_name STRING, column_name STRING, bad_rows LONG, severity STRING"


def _report(one_row: DataFrame, check: str, table: str, counts: Mapping[str, str], severity: str) -> DataFrame:
    """Turn a single aggregate row into one report row per named count."""
    entries = [
        F.struct(F.lit(column).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("bad_rows"))
        for column, c in counts.items()
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        "e.column_name",
        "e.bad_rows",
        F.lit(severity).alias("severity"),
    )


def _count_bad(df: DataFrame, conditions: Mapping[str, Column]) -> tuple[DataFrame, dict[str, str]]:
    """All conditions in one scan and one aggregate."""
    names = {column: f"bad_{i}" for i, column in enumerate(conditions)}
    row = df.agg(*[F.count_if(conditions[column]).alias(n) for column, n in names.items()])
    return row, names


def _outside(column: str, low: float | None, high: float | None) -> Column:
    below = F.col(column) < F.lit(low) if low is not None else F.lit(False)
    above = F.col(column) > F.lit(high) if high is not None else F.lit(False)
    return below | above


Ranges = Mapping[str, tuple[float | None, float | None]]


def column_figures(required: Sequence[str], ranges: Ranges | None = None) -> list[Column]:
    """Aggregates from which `report_figures` tells nulls in required columns and values out of range. They may be observed
    while a table is written (`stage_table`), so the checks cost no scan."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in required]
    return nulls + [F.count_if(_outside(c, *limits)).alias(f"outside {c}") for c, limits in (ranges or {}).items()]


def clock_figure(zone: str = ZONE) -> Column:
    """Rows whose wall clock is not that of their instant: merging rows of one instant keeps only one of its clocks."""
    return F.count_if(F.col("ts_local").cast("timestamp_ntz") != utc_to_local(F.col("ts_utc").cast("timestamp"), zone)).alias("clock ts_local")


def report_figures(
    spark: SparkSession, figures: Mapping[str, object], table: str, range_check: str = "accepted_range", expected: int | None = None, share: float = MIN_HOUR_SHARE
) -> DataFrame:
    """Report rows of the figures of `column_figures`; with `expected`, also whether `n_rows` falls short of its share."""
    checks = {"null": ("not_null", "error"), "outside": (range_check, "error"), "clock": ("local_time", "warn")}
    rows = [(checks[kind][0], table, column, bad, checks[kind][1]) for kind, column, bad in ((*n.split(" ", 1), v) for n, v in figures.items() if " " in n)]
    if expected is not None:
        rows.append(("row_count", table, "*", max(0, math.ceil(expected * share) - figures["n_rows"]), "error"))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def check_columns(df: DataFrame, table: str, required: Sequence[str], ranges: Ranges | None = None, range_check: str = "accepted_range") -> DataFrame:
    """`check_not_null` and `check_range` of a table in one scan."""
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *column_figures(required, ranges))
    counted = [("not_null", c, f"null {c}") for c in required] + [(range_check, c, f"outside {c}") for c in ranges or {}]
    entries = [
        F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"`{n}`").alias("bad_rows"))
        for check, c, n in counted
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*", F.lit("error").alias("severity"))


def check_local_time(df: DataFrame, table: str, zone: str = ZONE) -> DataFrame:
    """`clock_figure` as a report row, a warning."""
    return _report(df.agg(clock_figure(zone)), "local_time", table, {"ts_local": "`clock ts_local`"}, "warn")


def check_keys(
    df: DataFrame,
    table: str,
    key: Sequence[str],
    known: Sequence[str] = (),
    window: tuple[str, str] | None = None,
    share: float = MIN_HOUR_SHARE,
) -> DataFrame:
    """`check_known_duplicates` and `check_hour_coverage` of a key (series columns, then the timestamp) in one scan and one
    shuffle, by series and hour: an hour's repeated keys are counted where its rows meet."""
    *by, ts = key
    hours = df.select(*key, F.date_trunc("hour", ts).alias("_hour")).repartition(*by, "_hour")
    keys = hours.groupBy(*by, "_hour", ts).agg(F.count(F.lit(1)).alias("_n"))
    seen = keys.groupBy(*by, "_hour").agg(F.count_if(F.col("_n") > 1).alias("_repeated"))
    short, repeated = _short_series(seen, by, share, window, F.sum("_repeated").alias("_repeated"))
    severity = "warn" if table in known else "error"
    return _report(repeated, "unique", table, {", ".join(key): "bad"}, severity).unionByName(_report(short, "row_count", table, {ts: "bad"}, "error"))


def _short_series(
    hours: DataFrame, by: Sequence[str], share: float, window: tuple[str, str] | None, *others: Column
) -> tuple[DataFrame, DataFrame]:
    """From distinct (series, _hour): one row `bad`, the hours that series lack; and one row with the sum of the first of
    `others`, if any. The expected hours come from the same per-series table, not from another scan."""
    if window is None:
        inside = F.col("_hour").isNotNull()
    else:
        start, end = (F.lit(bound).cast("timestamp") for bound in window)
        inside = (F.col("_hour") >= start) & (F.col("_hour") < end)
    series = hours.groupBy(*by).agg(F.count_if(inside).alias("n"), F.min("_hour").alias("lo"), F.max("_hour").alias("hi"), *others)
    if window is None:
        whole = series.select((F.unix_seconds(F.max("hi").cast("timestamp")) - F.unix_seconds(F.min("lo").cast("timestamp"))) / 3600 + 1).scalar()
    else:
        whole = (F.unix_seconds(end) - F.unix_seconds(start)) / 3600
    wanted = F.ceil(whole * F.lit(float(share)))
    short = series.agg(F.count(F.lit(1)).alias("series"), F.sum(F.greatest(wanted - F.col("n"), F.lit(0))).alias("short"))
    bad = F.when(F.col("series") == 0, wanted).otherwise(F.col("short")).alias("bad")
    return short.select(bad), series.agg(F.sum("_repeated").alias("bad")) if others else short


def check_source_order(
    rows: DataFrame, table: str, ts: str, keys: Sequence[str] = ("asset_id",), source: Sequence[str] = SOURCE, severity: str = "error"
) -> DataFrame:
    """Rows of a file with an earlier timestamp than the row of their series before them, by the source positions that
    were read with them: a report row for each file that has any, or one with zero."""
    steps = ordering_check_blocks(rows, ts, keys, source)
    files = steps.groupBy(source[0]).agg(F.sum("n_backward").alias("bad_rows")).where("bad_rows > 0")
    name = F.concat(F.lit(f"{ts} in "), F.element_at(F.split(source[0], "/"), -1)).alias("column_name")
    unsorted = files.select(name, "bad_rows")
    none = rows.sparkSession.createDataFrame([(ts, 0)], "column_name string, bad_rows long")
    return unsorted.unionByName(none).select(
        F.lit("source_order").alias("check_name"), F.lit(table).alias("table_name"), "column_name", "bad_rows", F.lit(severity).alias("severity")
    )


def check_not_null(df: DataFrame, table: str, columns: Sequence[str], severity: str = "error") -> DataFrame:
    row, names = _count_bad(df, {c: F.col(c).isNull() for c in columns})
    return _report(row, "not_null", table, names, severity)


def check_range(
    df: DataFrame,
    table: str,
    ranges: Mapping[str, tuple[float | None, float | None]],
    check: str = "accepted_range",
    severity: str = "error",
) -> DataFrame:
    """Values outside inclusive limits; an open side is None, nulls are not judged."""

    row, names = _count_bad(df, {c: _outside(c, *limits) for c, limits in ranges.items()})
    return _report(row, check, table, names, severity)


def check_bounds_raw(df: DataFrame, table: str, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Unit-error bounds of a raw series."""
    return check_range(df, table, bounds, check="raw_bounds")


def check_unique(df: DataFrame, table: str, key: Sequence[str], severity: str = "error") -> DataFrame:
    """Number of keys that occur more than once."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("bad"))
    return _report(repeated, "unique", table, {", ".join(key): "bad"}, severity)


def check_known_duplicates(df: DataFrame, table: str, key: Sequence[str], known: Sequence[str]) -> DataFrame:
    """`check_unique`, only a warning for tables where repeated keys are expected."""
    return check_unique(df, table, key, "warn" if table in known else "error")


def check_row_count(
    df: DataFrame,
    table: str,
    expected: int,
    share: float = MIN_HOUR_SHARE,
    distinct: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Rows (or distinct values of a column) short of `share` x expected; with `exact`, any difference."""
    if distinct is None:
        counted = df.agg(F.count(F.lit(1)).alias("n"))
    else:
        counted = df.select(distinct).distinct().agg(F.count(distinct).alias("n"))
    if exact:
        bad = F.abs(F.col("n") - F.lit(expected))
    else:
        bad = F.greatest(F.ceil(F.lit(float(expected)) * F.lit(float(share))) - F.col("n"), F.lit(0))
    return _report(counted.select(bad.alias("bad")), "row_count", table, {distinct or "*": "bad"}, "error")


def check_hour_coverage(
    df: DataFrame,
    table: str,
    ts: str = "ts_utc",
    share: float = MIN_HOUR_SHARE,
    by: Sequence[str] = ("asset_id",),
    window: tuple[str, str] | None = None,
) -> DataFrame:
    """Distinct hours that each series lacks of `share` x the hours of `window` (its end excluded), summed over the
    series; without a window, of the hours between the first and last of all series. An empty table lacks them all."""
    hours = df.select(*by, F.date_trunc("hour", ts).alias("_hour")).distinct()
    return _report(_short_series(hours, by, share, window)[0], "row_count", table, {ts: "bad"}, "error")


def check_annual_total(
    df: DataFrame,
    table: str,
    value: str,
    target: float,
    ts: str = "ts_local",
    by: Sequence[str] = ("asset_id",),
    tolerance_pct: float = ANNUAL_TOLERANCE_PCT,
) -> DataFrame:
    """Number of (series, year) totals that miss the target by the tolerance or more."""
    totals = df.groupBy(*by, F.year(ts).alias("year")).agg(F.sum(value).alias("total"))
    off = F.abs(F.col("total") - F.lit(float(target))) / F.lit(float(target)) * 100 >= F.lit(float(tolerance_pct))
    return _report(totals.agg(F.count_if(off).alias("bad")), "annual_total", table, {value: "bad"}, "error")


def check_split_bounds(
    split: DataFrame,
    table: str,
    ts: str = "ts_utc",
    months: Sequence[int] = (TRAIN_MONTHS, VALIDATION_MONTHS, TEST_MONTHS),
    by: Sequence[str] = (),
) -> DataFrame:
    """Splits (of each series of `by`, if any) that leave their calendar months. `split` is the labelled frame of
    `chronological_split`."""
    labels = ("train", "validation", "test")
    month = month_index(ts)
    seen = split.groupBy(*by, "split").agg(F.min(month).alias("lo"), F.max(month).alias("hi"))
    if by:
        origin = F.min("lo").over(Window.partitionBy(*by))
    else:
        origin = split.select(F.min(month)).scalar()
    starts = [sum(months[:i]) for i in range(len(months))]
    low = F.coalesce(*[F.when(F.col("split") == n, F.lit(s)) for n, s in zip(labels, starts)])
    length = F.coalesce(*[F.when(F.col("split") == n, F.lit(m)) for n, m in zip(labels, months)])
    bad = (F.col("lo") - origin < low) | (F.col("hi") - origin >= low + length)
    return _report(
        seen.select(bad.alias("off")).agg(F.count_if("off").alias("bad")), "split_bounds", table, {ts: "bad"}, "error"
    )


def check_split_total(split: DataFrame, source: DataFrame, table: str) -> DataFrame:
    """Rows in the splits beyond those of the source."""
    total = source.select(F.count(F.lit(1))).scalar()
    kept = split.agg(F.count(F.lit(1)).alias("n")).select(F.greatest(F.col("n") - total, F.lit(0)).alias("bad"))
    return _report(kept, "split_total", table, {"*": "bad"}, "error")


def split_overlap(split: DataFrame, key: Sequence[str] = ("asset_id", "ts_utc")) -> DataFrame:
    """Keys that occur in more than one split: one aggregate instead of pairwise intersections."""
    labels = split.groupBy(*key).agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    return labels.where(F.col("lo") != F.col("hi")).select(*key)


def check_split_overlap(split: DataFrame, table: str, key: Sequence[str] = ("asset_id", "ts_utc")) -> DataFrame:
    """Number of keys that occur in more than one split."""
    shared = split_overlap(split, key).agg(F.count(F.lit(1)).alias("bad"))
    return _report(shared, "split_overlap", table, {", ".join(key): "bad"}, "error")


def all_checks(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)


def passed(report: DataFrame) -> DataFrame:
    """Per severity: checks run and checks failed."""
    return report.groupBy("severity").agg(
        F.count(F.lit(1)).alias("n_checks"), F.count_if(F.col("bad_rows") > 0).alias("n_failed")
    )
