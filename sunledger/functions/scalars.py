"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunledger.functions.timeops import col


def ratio(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """part/whole, rounded; NULL when the whole is zero."""
    return F.round(F.try_divide(col(part), col(whole)), digits)


def safe_ratio(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """part/whole, rounded; 0 when the whole is zero."""
    return F.round(F.coalesce(F.try_divide(col(part), col(whole)), F.lit(0.0)), digits)


def safe_share(part: Column | str, total: Column | str) -> Column:
    """part/total where the total is positive, else 0."""
    return F.when(col(total) > 0, col(part) / col(total)).otherwise(F.lit(0.0))


def at_least_zero(value: Column | str) -> Column:
    """Floor at zero: dispatch noise, and PV predictions."""
    return F.greatest(col(value), F.lit(0.0))


def normalize_label(label: Column | str) -> Column:
    """'Fossil Gas ' -> 'fossil_gas'."""
    words = F.regexp_replace(F.lower(F.trim(col(label))), "[^a-z0-9]+", "_")
    return F.trim(words, F.lit("_"))


def per_thousand(value: Column | str) -> Column:
    """W to kW, kWh to MWh, EUR/MWh to EUR/kWh, kg to t."""
    return col(value) / F.lit(1000.0)


def has_prefix(label: Column | str, prefix: str) -> Column:
    return col(label).startswith(prefix)


def fixed_decimals(value: Column | str, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded like C's `%.nf`: to the nearest of the binary value, an exact
    tie to even. Spark's own formatting rounds the shortest decimal text half up, which differs for 0.35 or 1.25.

    The product with the scale is rounded itself; its error, from splitting the value into two short halves, tells
    on which side of a seeming tie the value lies. Missing values and NaN are NULL.
    """
    x, scale = col(value).cast("double"), F.lit(10.0**digits)
    product = x * scale
    high = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
    error = (high * scale - product) + (x - high) * scale
    seems_tie = F.abs(product - F.rint(product)) == F.lit(0.5)
    whole = (
        F.when(seems_tie & (error > 0), F.ceil(product).cast("double"))
        .when(seems_tie & (error < 0), F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )
    return F.when(x.isNotNull() & ~F.isnan(x), F.format_string(f"%.{digits}f", whole / scale))


def passed_cuts(cuts: str, value: str) -> Column:
    """How many entries of the sorted array column `cuts` are at most `value`, by halving."""
    entry = f"get({cuts}, n + shiftleft(1, b) - 1) <= {value}"
    step = f"CASE WHEN n + shiftleft(1, b) <= size({cuts}) AND {entry} THEN n + shiftleft(1, b) ELSE n END"
    return F.expr(f"aggregate(sequence(length(bin(size({cuts}))) - 1, 0, -1), 0, (n, b) -> {step})")
