"""Table readers and the whole-table replacing writer."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.sources.schemas import BATTERY_SCHEMA, RAW_TABLES, RawTable


# Where a raw row came from: file, offset of the block in the file, and a number that grows in a block from row to row.
SOURCE = ("source_file", "source_block", "source_row")


def read_raw_csv(spark: SparkSession, path: str, schema: str | T.StructType, with_source: bool = False) -> DataFrame:
    """Header CSV with declared types: one pass, no inference; a malformed row fails the read. `with_source` adds the
    columns SOURCE, which put the rows of a file in their order."""
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if not with_source:
        return rows
    places = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return rows.select("*", *[place.alias(name) for name, place in zip(SOURCE, places)])


def read_raw_table(spark: SparkSession, folder: str, table: str | RawTable, with_source: bool = False) -> DataFrame:
    """A catalog table from its CSV file (or folder of part files) under `folder`."""
    entry = RAW_TABLES[table] if isinstance(table, str) else table
    return read_raw_csv(spark, f"{folder.rstrip('/')}/{entry.file}", entry.schema, with_source)


def read_battery(spark: SparkSession, path: str) -> DataFrame:
    """Battery dispatch results from CSV, as `staging.stg_battery` takes them."""
    return read_raw_csv(spark, path, BATTERY_SCHEMA)


def raw_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, required column): rows and nulls, in one pass per table."""
    reports = []
    for name, df in tables.items():
        required = RAW_TABLES[name].required
        counts = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
        )
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.col(f"null_{c}").alias("n_nulls")) for c in required
        ]
        reports.append(
            counts.select(F.lit(name).alias("table_name"), "n_rows", F.explode(F.array(*entries)).alias("e"))
            .select("table_name", "e.column_name", "n_rows", "e.n_nulls")
        )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


@dataclass(frozen=True)
class Staged:
    """A table written beside the one it may replace, with the figures observed while it was written."""

    spark: SparkSession
    path: str
    beside: str
    figures: Mapping[str, object]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.beside)

    def publish(self) -> None:
        """Puts the table in place: the old one is renamed away, the new one takes its name, then the old one goes.

        Renames are single steps on file systems like HDFS. If the second fails, the first is undone; a process that dies
        between them leaves the old table to `restore_table`. On object stores, where a rename copies, the time without a
        table is that of the copy.
        """
        fs, old = _file_system(self.spark, self.path), f"{self.path}{_OLD}{uuid.uuid4().hex}"
        had_one = fs.exists(_hadoop(self.spark, self.path))
        if had_one and not fs.rename(_hadoop(self.spark, self.path), _hadoop(self.spark, old)):
            raise OSError(f"cannot move {self.path} away")
        if not fs.rename(_hadoop(self.spark, self.beside), _hadoop(self.spark, self.path)):
            if had_one:
                fs.rename(_hadoop(self.spark, old), _hadoop(self.spark, self.path))
            raise OSError(f"cannot publish {self.path}")
        if had_one:
            fs.delete(_hadoop(self.spark, old), True)
        self.spark.catalog.refreshByPath(self.path)

    def discard(self) -> None:
        _file_system(self.spark, self.beside).delete(_hadoop(self.spark, self.beside), True)


_OLD, _NEXT = "__old_", "__next_"


def _hadoop(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def stage_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    figures: Sequence[Column] = (),
    buckets: tuple[int, Sequence[str]] | None = None,
) -> Staged:
    """Write `df` as Parquet beside `path`; whatever is at `path` stays. `figures` are aggregates (with names) that the one
    pass of the write observes; `n_rows` always is. They are taken in the stage that writes, whose tasks count once, also
    when executors are lost.

    With `partition_by`, rows are first rebalanced by those columns: a folder is written by few tasks instead of
    by every task, and adaptive execution splits a folder that is too large for one. With `buckets` (number, columns), each
    bucket is one file.
    """
    out, beside = df, f"{path}{_NEXT}{uuid.uuid4().hex}"
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if buckets:
        out = out.repartition(buckets[0], *buckets[1])
    elif sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    seen = Observation(f"write of {path}")
    writer = out.observe(seen, F.count(F.lit(1)).alias("n_rows"), *figures).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        if buckets:
            # Only a table of the catalog can be written in buckets; its name goes, the files stay.
            name = f"staged_{uuid.uuid4().hex}"
            writer.bucketBy(buckets[0], *buckets[1]).sortBy(*sort_by).option("path", beside).saveAsTable(name)
            df.sparkSession.sql(f"DROP TABLE {name}")
        else:
            writer.parquet(beside)
    except BaseException:
        Staged(df.sparkSession, path, beside, {}).discard()
        raise
    return Staged(df.sparkSession, path, beside, dict(seen.get))


def restore_table(spark: SparkSession, path: str) -> bool:
    """Puts the old table back if a process died while it published a new one; whether there was one to put back."""
    fs = _file_system(spark, path)
    if fs.exists(_hadoop(spark, path)):
        return False
    left = fs.globStatus(_hadoop(spark, f"{path}{_OLD}*"))
    return bool(left) and fs.rename(left[0].getPath(), _hadoop(spark, path))


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    figures: Sequence[Column] = (),
    audit: Callable[[Staged], None] | None = None,
) -> int:
    """Replace the Parquet table at `path` and return the row count: write beside it, audit, publish. An `audit` that
    raises, like a write that fails, leaves the old table as it was."""
    restore_table(df.sparkSession, path)
    staged = stage_table(df, path, partition_by, sort_by, figures)
    try:
        if audit is not None:
            audit(staged)
        staged.publish()
    except BaseException:
        staged.discard()
        raise
    return staged.figures["n_rows"]


def read_year_folders(spark: SparkSession, path: str, column: str = "year") -> dict[int | None, DataFrame]:
    """The folders `<column>=<year>` under a table's path as frames by year, each with the columns its own files have. Years
    come from the folders' names (rows without one are under None); no data is read for them."""
    found = _file_system(spark, path).globStatus(_hadoop(spark, f"{path.rstrip('/')}/{column}=*"))
    years = {}
    for status in found or ():
        name = status.getPath().getName().partition("=")[2]
        years[int(name) if name.lstrip("-").isdigit() else None] = spark.read.parquet(status.getPath().toString())
    return dict(sorted(years.items(), key=lambda y: (y[0] is None, y[0] or 0)))


def scan_ordered(
    features: DataFrame,
    lag_columns: Sequence[str],
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Feature rows whose lags are all known; sorted only when an order is asked for."""
    rows = features.dropna(subset=list(lag_columns))
    if columns is not None:
        rows = rows.select(*columns)
    return rows.orderBy(*order_by) if order_by else rows
