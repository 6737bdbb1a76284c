"""Ordered-series operators: row lags, time lags, naive baselines, ordering check, missing hours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.scalars import passed_cuts
from sunledger.settings import LAGS, ROWS_PER_TASK

KEYS = ("asset_id",)
HOUR_KEY = ("asset_id", "ts_utc")
# Sampled rows between two cuts of a long series: ranges vary by a sixth of their size.
SAMPLES_PER_RANGE = 32


def hour_key(*sides: DataFrame) -> list[str]:
    """What frames of hours are joined on. If all of them carry `_range`, the hour's time range, it belongs to the key: it
    changes no row, and sides that are partitioned or bucketed by (series, range) are joined where they are."""
    ranged = all("_range" in side.columns for side in sides)
    return [*HOUR_KEY, "_range"] if ranged else list(HOUR_KEY)


def lag_rows(
    df: DataFrame,
    lags: Mapping[str, tuple[str, int]],
    keys: Sequence[str] = KEYS,
    ts: str = "ts_utc",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add `name = column n rows earlier in the series` for each `name: (column, n)`. Runs no job.

    Rows are partitioned by series and time range, so no series is one task; see `in_ranges` and `lag_in_ranges`. Rows of
    one instant are ordered by their values, so the answer is one whatever the partitions. Stored rows that carry their
    `_range` (`sources.bucketed`) keep it as their range, and only the seams between ranges are shuffled.
    """
    if "_range" in df.columns:
        return lag_in_ranges(df.withColumn("_cuts", F.lit(1)), lags, keys, ts)
    return lag_in_ranges(in_ranges(df, range_cuts(df, keys, ts, rows_per_task), keys, ts), lags, keys, ts)


def range_cuts(df: DataFrame, keys: Sequence[str], ts: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(_k, _at) of every series long enough to be cut: the key as a struct, in which a NULL equals a NULL, and the sorted
    instants (microseconds) at which its ranges begin, about `rows_per_task` of its rows apart.

    A sample chosen by a hash of key and instant, so every evaluation sees the same cuts; it reads only these two columns.
    There is one cut for every `rows_per_task` rows at most, so the table is small at any size of `df`: ten billion rows
    have 2,000.
    """
    chosen = F.pmod(F.xxhash64(*keys, ts), F.lit(rows_per_task)) < SAMPLES_PER_RANGE
    stamps = df.where(chosen).groupBy(F.struct(*keys).alias("_k")).agg(F.sort_array(F.collect_list(_stamp(ts))).alias("_s"))
    nth = F.sequence(F.lit(1), F.floor(F.size("_s") / SAMPLES_PER_RANGE).cast("int") - 1)
    long = stamps.where(F.size("_s") >= 2 * SAMPLES_PER_RANGE)
    return long.select("_k", F.array_distinct(F.transform(nth, lambda i: F.get("_s", i * SAMPLES_PER_RANGE))).alias("_at"))


def _stamp(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def in_ranges(df: DataFrame, cuts: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts_utc") -> DataFrame:
    """Add `_range`, the row's time range in its series, and `_cuts`, how many ranges follow the series' first. Where no
    series is long enough for a cut, adaptive execution drops the join and everything that only cut series need."""
    told = df.withColumns({"_k": F.struct(*keys), "_s": _stamp(ts)}).join(F.broadcast(cuts), "_k", "left")
    passed = F.when(F.col("_at").isNotNull(), passed_cuts("_at", "_s")).otherwise(F.lit(0))
    return told.select(*df.columns, passed.alias("_range"), F.coalesce(F.size("_at"), F.lit(0)).alias("_cuts"))


def lag_in_ranges(placed: DataFrame, lags: Mapping[str, tuple[str, int]], keys: Sequence[str] = KEYS, ts: str = "ts_utc") -> DataFrame:
    """Row lags of a frame of `in_ranges`: one shuffle and one sort for all lags, by series and time range.

    Inside a range the window settles every row that has `depth` rows before it there, and all rows of a first range.
    The first `depth` rows of each later range need rows from before its border: only the first and the last `depth` rows
    of the ranges of cut series travel on, to a second window per series.
    """
    columns = [c for c in placed.columns if c not in ("_range", "_cuts")]
    depth = max(n for _, n in lags.values())
    hashed = [c for c in columns if placed.schema[c].dataType.typeName() != "map"]
    order = [F.col(ts), F.xxhash64(*hashed)]
    # `_cuts` is the same for a whole series. As a key it lets the filter on it below reach the input of the second branch.
    in_range = Window.partitionBy(*keys, "_range", "_cuts").orderBy(*order)
    lag_over = lambda window: {name: F.lag(c, n).over(window) for name, (c, n) in lags.items()}
    numbered = placed.withColumns(
        {"_row": F.row_number().over(in_range), "_is_tail": F.lead(F.lit(1), depth).over(in_range).isNull(), **lag_over(in_range)}
    )
    is_head = (F.col("_range") > 0) & (F.col("_row") <= depth)
    settled = numbered.where(~is_head)
    along = Window.partitionBy(*keys).orderBy(*order)
    edges = numbered.where("_cuts > 0").where(is_head | F.col("_is_tail")).withColumns(lag_over(along))
    return settled.unionByName(edges.where(is_head)).select(*columns, *lags)


def lag_features(
    series: DataFrame,
    value: str,
    prefix: str,
    lags: Sequence[int] = LAGS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Row lags of one value: `<prefix>_lag_<n>h`."""
    named = {f"{prefix}_lag_{n}h": (value, n) for n in lags}
    return lag_rows(series, named, rows_per_task=rows_per_task)


def lag_by_time(
    series: DataFrame,
    value: str,
    prefix: str,
    lags: Sequence[int] = LAGS,
    keys: Sequence[str] = KEYS,
    ts: str = "ts_utc",
    unit: str = "HOURS",
) -> DataFrame:
    """Value exactly n hours (or other `unit`) earlier, NULL if that instant is absent; differs from the row lag
    after a gap. Equi-joins on the unique (series, instant): all share one partitioning, none is skewed."""
    on = [*keys, ts]
    result = series
    for n in lags:
        earlier = series.select(
            *keys, (F.col(ts) + F.expr(f"INTERVAL {n} {unit}")).alias(ts), F.col(value).alias(f"{prefix}_lag_{n}h")
        )
        result = result.join(earlier, on, "left")
    return result


def naive_forecast(series: DataFrame, value: str, lag: int, name: str = "y_pred") -> DataFrame:
    """Predict the value `lag` rows earlier: 24 is persistence, 168 seasonal-naive."""
    return lag_rows(series, {name: (value, lag)})


def persistence(series: DataFrame, value: str, lag: int = 24) -> DataFrame:
    return naive_forecast(series, value, lag)


def seasonal_naive(series: DataFrame, value: str, lag: int = 168) -> DataFrame:
    return naive_forecast(series, value, lag)


def baseline_frame(series: DataFrame, target: str, keys: Sequence[str] = KEYS, ts: str = "ts_utc") -> DataFrame:
    """Actual value and both naive predictions; warm-up rows are left out."""
    both = {"y_pred_persistence": (target, 24), "y_pred_seasonal_naive": (target, 168)}
    lagged = lag_rows(series.select(*keys, ts, target), both, keys, ts)
    return lagged.withColumnRenamed(target, "y_true").dropna(subset=list(both))


def ordering_check(
    rows: DataFrame,
    sequence: str,
    ts: str = "ts_utc",
    keys: Sequence[str] = KEYS,
    chunk: int = 1_000_000,
) -> DataFrame:
    """Per series: how many rows, in source order, have an earlier timestamp than the row before.

    A DataFrame has no row order, so the source position is a column. Steps inside a chunk of positions are
    checked per (series, chunk); steps between chunks need only each chunk's first and last timestamp.
    """
    placed = rows.withColumn("_chunk", F.floor(F.col(sequence) / chunk))
    return _backward_steps(placed, keys, ts, "_chunk", sequence)


def ordering_check_blocks(
    rows: DataFrame, ts: str = "ts_utc", keys: Sequence[str] = KEYS, source: Sequence[str] = ("source_file", "source_block", "source_row")
) -> DataFrame:
    """`ordering_check` per (file, series) of rows that carry their file, block and row: a file's blocks are its chunks."""
    file, block, row = source
    return _backward_steps(rows, [file, *keys], ts, block, row)


def _backward_steps(rows: DataFrame, keys: Sequence[str], ts: str, chunk: str, sequence: str) -> DataFrame:
    inside = Window.partitionBy(*keys, chunk).orderBy(sequence)
    steps = rows.select(*keys, chunk, sequence, ts, (F.col(ts) < F.lag(ts).over(inside)).cast("int").alias("_back"))
    chunks = steps.groupBy(*keys, chunk).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("_back"), F.lit(0)).alias("_inside"),
        F.min_by(ts, sequence).alias("_first"),
        F.max_by(ts, sequence).alias("_last"),
    )
    across = Window.partitionBy(*keys).orderBy(chunk)
    seams = chunks.withColumn("_seam", F.coalesce((F.col("_first") < F.lag("_last").over(across)).cast("int"), F.lit(0)))
    return seams.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum(F.col("_inside") + F.col("_seam")).alias("n_backward")
    )


def missing_hours(
    series: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts_utc", window: tuple[str, str] | None = None
) -> DataFrame:
    """Hours of `window` (its end excluded) that a series lacks; without one, hours absent between its first and last.

    Gaps between islands: each present hour is put next to its successor, and only hours between the two are made. With a
    window, each series gets its two ends as rows, so gaps at its borders are found alike; series without any row in
    the window lack it all. Long series are cut as for lags; gaps longer than a month are made month by month.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    present = series.select(*keys, F.date_trunc("hour", ts).alias("_hour"), F.lit(False).alias("_end")).where(F.col("_hour").isNotNull())
    if window is not None:
        start, end = (F.lit(bound).cast("timestamp") for bound in window)
        ends = series.select(*keys).distinct().select(*keys, F.explode(F.array(start - hour, end)).alias("_hour"), F.lit(True).alias("_end"))
        present = present.where((F.col("_hour") >= start) & (F.col("_hour") < end)).unionByName(ends)
    followed = lag_rows(present, {"_before": ("_hour", 1)}, keys, "_hour")
    gaps = followed.where(F.col("_hour") > F.col("_before") + hour).select(*keys, (F.col("_before") + hour).alias("_from"), (F.col("_hour") - hour).alias("_to"))
    month = F.expr("INTERVAL 1 MONTH")
    parts = gaps.select(*keys, "_from", "_to", F.explode(F.sequence(F.date_trunc("month", "_from"), F.date_trunc("month", "_to"), month)).alias("_month"))
    last = F.least(F.col("_to"), F.col("_month") + month - hour)
    return parts.select(*keys, F.explode(F.sequence(F.greatest("_from", "_month"), last, hour)).alias(ts))
