"""Exact deduplication against a persistent digest index.

The index is a Parquet table with one row per distinct text, bucketed and
sorted by the SHA-256 digest of the normalised text.  A batch is reduced to one
row per digest (partial aggregation first, so thousands of copies cost one row
per task), sort-merge anti-joined with the index, and the digests that are new
are appended.  The bucketed side of the anti-join is never shuffled.

Defined results
* null text counts as empty; texts are equal when identical after lower-casing A-Z;
* within a batch the row with the largest ``doc_id`` stays; null ids lose against any id;
* a text that an earlier batch brought stays with that batch's row: no row of
  the new batch is kept;
* a batch that is appended again under its name (after a failure, say) adds only what is missing and is labelled as before;
* rows that repeat both id and text are labelled alike; ``kept_rows`` returns one of them;
* an empty batch leaves the index as it is; extra columns are passed through untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlife.llm.common import ascii_lower, free_name, shuffle_partitions

INDEX_COLUMNS = ("digest", "keep_id", "group_size", "batch")


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


class DigestIndex:
    """A digest index at ``path`` (a shared folder); created when absent, reopened otherwise.

    ``buckets`` fixes the layout when the index is created, so that it should
    follow the size the index will reach, not that of the first batch.  The number is kept
    in a folder beside the index and read when it is opened again; another one is refused,
    since digests placed by one number are not found by another.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        beside = f"{path.rstrip('/')}-layout"
        spark.createDataFrame([], "buckets int").write.mode("append").json(beside)
        kept = spark.read.schema("buckets int").json(beside).first()
        self.buckets = kept["buckets"] if kept else buckets or shuffle_partitions(spark)
        if buckets not in (None, self.buckets):
            raise ValueError(f"{path} has {self.buckets} buckets and cannot be opened with {buckets}")
        if not kept:
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.mode("append").json(beside)
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def close(self) -> None:
        """Forget the session's catalogue name; the index stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str | None = None) -> str:
        """Add the batch's new digests; returns the batch's name in the index."""
        name = name or uuid.uuid4().hex
        groups = (batch.select(text_digest(F.col(text_col)).alias("digest"),
                               F.col(id_col).cast("bigint").alias("keep_id"))
                  .groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
        # Written as an outer join: the optimiser moves an anti-join below the
        # aggregation, which would shuffle every copy instead of one row per digest.
        known = self.rows().select(F.col("digest").alias("known"))
        fresh = (groups.repartition(self.buckets, "digest")
                 .join(known.hint("merge"), F.col("digest") == F.col("known"), "left")
                 .where(F.col("known").isNull()).drop("known").withColumn("batch", F.lit(name)))
        (fresh.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.path).saveAsTable(self.table))
        return name

    def label(self, batch: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Every row of an appended batch: id, keep_id, group_size, kept, text_sha256.

        The index is read here as plain files: with both sides of the join
        shuffled, adaptive execution splits a digest that holds many rows.
        """
        index = (self.spark.read.schema("digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING")
                 .parquet(self.path).withColumnRenamed("digest", "text_sha256"))
        docs = batch.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("text_sha256"))
        kept = (F.col("batch") == name) & F.col("id").eqNullSafe(F.col("keep_id"))
        return (docs.join(index.hint("merge"), "text_sha256")
                .select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256"))

    def kept_rows(self, batch: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The batch's rows that stay, one per new text, with the batch's own columns."""
        digest, stays = free_name(batch.columns, "digest"), free_name(batch.columns, "stays_id")
        index = (self.spark.read.schema("digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING")
                 .parquet(self.path).where(F.col("batch") == name)
                 .select(F.col("digest").alias(digest + "_ix"), F.col("keep_id").alias(stays)))
        docs = batch.withColumn(digest, text_digest(F.col(text_col)))
        kept = docs.join(index, (F.col(digest) == F.col(digest + "_ix"))
                         & F.col(id_col).cast("bigint").eqNullSafe(F.col(stays)), "left_semi")
        return kept.dropDuplicates([digest, id_col]).drop(digest)
