"""Small helpers the operators share: text patterns, row identity, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.session import scratch_path

# Words between ASCII white space, unchanged.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A table of at most this many rows of a few short fields may be broadcast.
BROADCAST_ROWS = 100_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the folder all executors share and read back: lineage ends here, and a lost executor costs
    no recomputation. The files go when the session ends, or earlier by `discard`: a long session holds the intermediate
    tables of all its queries until then."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    delete_on_exit(spark, path)
    read = spark.read.schema(df.schema).parquet(path)
    read.stored_at = path
    return read


def discard(table: DataFrame) -> None:
    """Deletes the files of a `stored` table that nothing will read any more."""
    spark = table.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def identified(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """`doc_id`, the named columns and `_twin`, a hash of the text. (doc_id, _twin) names a row wherever results must
    find their text again: rows that share both hold the same text, so they share every result as well."""
    return docs.select("doc_id", *columns, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_twin"))


def same_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be null; the left side's key columns stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"_r_{k}"])
        on = one if on is None else on & one
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that clashes with none of the frame's."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
