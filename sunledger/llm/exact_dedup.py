"""Exact dedup against a persistent index of digests, bucketed and sorted by digest."""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import delete_on_exit, fresh_name, same_rows, stored
from sunledger.session import scratch_path

# A new index has a bucket for so many digests of its first batch, and so many at least; a bucket is merged by one task.
ROWS_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 32
# After so many appends, each of which adds a file to every bucket, or with so many times the rows, buckets are made anew.
MOST_APPENDS = 16
CROWDED = 4


def text_digest():
    """SHA-256 of the UTF-8 text, as 32 bytes; null counts as the empty text."""
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


class DigestIndex:
    """digest -> keep_id in a Parquet table that is bucketed and sorted by digest.

    `location` persists: a later session opens the same folder and goes on. A file there says how many buckets the index
    has; opening it with another number is refused, as rows would be sought in the wrong buckets. A batch is reduced to
    one row per digest, merged with the index by a sort-merge anti-join (the index side needs no shuffle, only each
    bucket's files sorted together), and what is new is appended. Several appends leave several files in a bucket;
    `compact` rewrites them as one, by itself now and then.

    One writer at a time: two that append at once would both keep a text that is new to both. `close` takes the table's
    name out of the session's catalog; the files stay.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int | None = None):
        self.spark, self.location, self.asked = spark, location.rstrip("/"), buckets
        self.name, self.about = None, self._read_about()
        if self.about is not None:
            if buckets is not None and buckets != self.about["buckets"]:
                raise ValueError(f"the index at {location} has {self.about['buckets']} buckets, not {buckets}; compact() changes that")
            self._name_table()

    def _about_path(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/index.json")

    def _file_system(self):
        return self._about_path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read_about(self) -> dict | None:
        if not self._file_system().exists(self._about_path()):
            return None
        return json.loads(self.spark.read.text(f"{self.location}/index.json").first()[0])

    def _write_about(self) -> None:
        out = self._file_system().create(self._about_path(), True)
        out.writeBytes(json.dumps(self.about))
        out.close()

    def _folder(self) -> str:
        return f"{self.location}/v{self.about['version']}"

    def _name_table(self) -> None:
        self.name = f"digest_index_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.about['buckets']} BUCKETS LOCATION '{self._folder()}'"
        )

    def _append(self, rows: DataFrame) -> None:
        n = self.about["buckets"]
        rows.select("digest", "keep_id").repartition(n, "digest").write.bucketBy(n, "digest").sortBy("digest").mode("append").saveAsTable(self.name)

    def entries(self) -> DataFrame:
        if self.name is None:
            return self.spark.createDataFrame([], "digest BINARY, keep_id BIGINT")
        return self.spark.table(self.name)

    def close(self) -> None:
        if self.name is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            self.name = None

    def compact(self, buckets: int | None = None) -> None:
        """Write every bucket as one file, in as many buckets as the rows need (or as asked), then remove the old files.
        Frames that read the index before are not to be used afterwards."""
        old, folder = self.entries(), self._folder()
        need = math.ceil(self.about["rows"] / ROWS_PER_BUCKET)
        self.close()
        self.about = {**self.about, "version": self.about["version"] + 1, "buckets": buckets or max(self.about["buckets"], need), "appends": 1}
        self._name_table()
        self._append(old)
        self._write_about()
        self._file_system().delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder), True)

    def _ready(self, digests: int) -> None:
        """The index made for a first batch of so many digests, or compacted if that is due."""
        if self.about is None:
            buckets = self.asked or max(LEAST_BUCKETS, math.ceil(digests / ROWS_PER_BUCKET))
            self.about = {"version": 1, "buckets": buckets, "rows": 0, "appends": 0}
            self._name_table()
            self._write_about()
        elif self.about["appends"] >= MOST_APPENDS or self.about["rows"] > CROWDED * ROWS_PER_BUCKET * self.about["buckets"]:
            self.compact()

    def add(self, docs: DataFrame) -> DataFrame:
        """Index a batch; one row per row of it: doc_id, digest, keep_id, group_size, kept.

        Of equal texts within a batch the largest doc_id stays; a text of an earlier batch stays where it was, so the
        whole group of the new batch is dropped. group_size counts the batch's rows of that text. Rows that repeat both
        doc_id and text: one of them stays. A null doc_id counts as smaller than any other. An empty batch gives no
        rows and adds nothing to the index. doc_id must be an integer: the index keeps it as a long.
        """
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
        by_id = stored(rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n")), "digests")
        self._ready(by_id.count())
        groups = by_id.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
        fresh = groups.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")
        known = groups.drop("keep_id").join(self.entries().hint("merge"), "digest")
        owners = stored(
            fresh.select("digest", "keep_id", "group_size", F.lit(True).alias("new")).unionByName(
                known.select("digest", "keep_id", "group_size", F.lit(False).alias("new"))
            ),
            "digest-owners",
        )
        added = owners.where("new").count()
        if added:
            self._append(owners.where("new"))
            self.about = {**self.about, "rows": self.about["rows"] + added, "appends": self.about["appends"] + 1}
            self._write_about()
        # A hot digest is a long run of by_id; both sides shuffle here, so adaptive execution can split the run.
        copies = by_id.join(owners.hint("merge"), "digest").withColumn("copy", F.explode(F.expr("sequence(1L, n)")))
        stays = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
        return copies.select("doc_id", "digest", "keep_id", "group_size", stays.alias("kept"))


def open_index(spark: SparkSession) -> DigestIndex:
    """A new index in the shared folder, for one run over a whole table; it goes when the session ends."""
    location = scratch_path(spark, "digest-index")
    delete_on_exit(spark, location)
    return DigestIndex(spark, location)


def dedup_exact(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with all their columns; see `DigestIndex.add`."""
    digest = fresh_name(docs, "_digest")
    stays = index.add(docs).where("kept").select("doc_id", F.col("digest").alias(digest))
    kept = same_rows(docs.withColumn(digest, text_digest()), stays, ["doc_id", digest], "left_semi")
    return kept.dropDuplicates(["doc_id", digest]).select(*docs.columns)
