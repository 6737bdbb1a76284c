"""Exact medians, also of groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.scalars import passed_cuts

# Distinct values of one group that a task should hold.
VALUES_PER_TASK = 1_000_000
# Of the values of a group, chosen by their hash, so many stand for VALUES_PER_TASK.
SAMPLES = 32


def agg_with_median(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    name: str,
    others: Sequence[Column] = (),
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Interpolated median of `value` per group as a double, next to other aggregates. Runs no job.

    The built-in median keeps the distinct values of a group in memory: one pass and the best plan while every group is
    small. Groups with more values, which `value_cuts` tells, go through `selected`, with the same answer. Groups with a NULL
    key, groups of NULLs only, and one row for an empty input without keys are kept. Where no group is large, adaptive
    execution drops the second way.
    """
    told = _with_cuts(df, by, value, values_per_task)
    small, large = told.where("_at IS NULL"), told.where("_at IS NOT NULL")
    median = F.median(F.col(value).cast("double")).alias(name)
    medians = selected(large, value, name)
    if not by:
        one = F.lit(1).alias("_one")
        known = small.groupBy("_k").agg(median).unionByName(medians).agg(F.max(name).alias(name))
        return df.agg(*others, one).join(known.select("*", one), "_one").drop("_one") if others else known
    if others:
        medians = large.groupBy("_k").agg(*others).join(medians, "_k")
    return small.groupBy("_k").agg(*others, median).unionByName(medians).select("_k.*", "*").drop("_k")


def value_cuts(df: DataFrame, by: Sequence[str], value: str, values_per_task: int = VALUES_PER_TASK) -> DataFrame:
    """(_k, _at) of the groups with more than about twice `values_per_task` distinct values: the key as a struct, in which a
    NULL equals a NULL, and sorted values about half as many apart.

    The values come from a fixed share of all hashes, so every evaluation sees the same cuts. There are two cuts for every
    `values_per_task` rows at most: the table is small at any size of `df`.
    """
    chosen = F.pmod(F.xxhash64(F.col(value).cast("double")), F.lit(values_per_task)) < SAMPLES
    values = df.where(chosen & F.col(value).isNotNull()).groupBy(_key(by).alias("_k")).agg(F.sort_array(F.collect_set(F.col(value).cast("double"))).alias("_s"))
    apart = SAMPLES // 2
    nth = F.sequence(F.lit(1), F.floor(F.size("_s") / apart).cast("int"))
    return values.where(F.size("_s") >= 2 * SAMPLES).select("_k", F.transform(nth, lambda i: F.get("_s", i * apart - 1)).alias("_at"))


def _key(by: Sequence[str]) -> Column:
    return F.struct(*by) if by else F.struct(F.lit(1))


def _with_cuts(df: DataFrame, by: Sequence[str], value: str, values_per_task: int) -> DataFrame:
    return df.withColumn("_k", _key(by)).join(F.broadcast(value_cuts(df, by, value, values_per_task)), "_k", "left")


def selected_median(df: DataFrame, by: Sequence[str], value: str, name: str, values_per_task: int = VALUES_PER_TASK) -> DataFrame:
    """Median per group, all groups by distributed selection; see `selected`. Groups of NULLs only have none."""
    medians = selected(_with_cuts(df, by, value, values_per_task), value, name)
    return medians.select("_k.*", name) if by else medians.select(name)


def selected(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(_k, name): the median of each group of rows with `_k` and `_at`, its cuts (null: none), for groups of any size.

    1. The cuts divide a group's values into bins. Counting the bins is exact (partial aggregation, then a row for each bin),
       so the bins of the two middle ranks are known for certain, whatever the cuts are; what lies below is a number.
    2. Only the values of those bins are left. Equal ones are counted, by a shuffle on (group, value), and ranked.

    So no task holds a group, and a hot value is one row for each task that has read it.
    """
    bin_ = F.when(F.col("_at").isNotNull(), passed_cuts("_at", "_v")).otherwise(F.lit(0))
    known = rows.select("_k", "_at", F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    binned = known.select("_k", "_v", bin_.alias("_bin"))
    whole = Window.partitionBy("_k")
    bins = _ranked(binned.groupBy("_k", "_bin").agg(F.count(F.lit(1)).alias("_n")), "_bin").withColumn("_total", F.sum("_n").over(whole))
    # Ranks, from zero, of the two middle values.
    bins = bins.withColumns({"_low": F.expr("(_total - 1) div 2"), "_high": F.expr("_total div 2")})
    of = lambda rank: (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))
    middle = bins.groupBy("_k").agg(
        F.min(F.when(of("_low"), F.col("_bin"))).alias("_first"),
        F.min(F.when(of("_high"), F.col("_bin"))).alias("_last"),
        F.min(F.when(of("_low"), F.col("_start"))).alias("_less"),
        F.first("_low").alias("_low"),
        F.first("_high").alias("_high"),
    )
    left = binned.join(middle, "_k").where(F.col("_bin").between(F.col("_first"), F.col("_last")))
    ranks = ["_k", "_less", "_low", "_high"]
    counted = _ranked(left.groupBy(*ranks, "_v").agg(F.count(F.lit(1)).alias("_n")), "_v")
    at = lambda rank: F.max(F.when((F.col("_less") + F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_less") + F.col("_end")), F.col("_v")))
    return counted.groupBy("_k").agg(((at("_low") + at("_high")) / F.lit(2.0)).alias(name))


def _ranked(counted: DataFrame, order: str) -> DataFrame:
    """Add `_start` and `_end`: the ranks of a group's entries with `_n` rows each, in an order."""
    running = Window.partitionBy("_k").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("_end", F.sum("_n").over(running)).withColumn("_start", F.col("_end") - F.col("_n"))
