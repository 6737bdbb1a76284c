"""Registry of named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.plans.bindings import Bindings
from sunledger.plans.oracle_text import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register `f(bindings)`; `sql` may name any binding of `oracle_text`. Without SQL only the rows are checked."""

    def register(f: Callable[[Bindings], DataFrame]):
        key = name or f.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(Bindings(spark, folder))

        run.__name__ = key
        run.__doc__ = f.__doc__
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = oracle(sql)
        return f

    return register


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """All double columns rounded: the order of a sum differs between engines and runs."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def rounds(columns: str, digits: int) -> str:
    """'a b' -> 'round(a, n) AS a, round(b, n) AS b'."""
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())
