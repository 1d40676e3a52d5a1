"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

The index is a table with one row per distinct text: (digest, keep_id,
group_size).  A batch is first reduced to one row per digest (partial maxima and counts
before the shuffle, so a text that a third of all rows share is one row per
task) and written.  These rows are sort-merge anti-joined with the index and the
unseen digests appended; then they meet the index once more for the rows to keep.  The
index is bucketed and sorted by digest and has at least as many buckets as a
shuffle has partitions, so in both joins only the batch's distinct digests move.  Last, the
documents get the answer of their digest.

Defined cases: null text counts as empty; of equal texts in a batch the row with the
largest ``doc_id`` stays (a null id only if there is no other), and one row only if rows are
repeated whole; rows that share a doc_id with different texts are documents of their own;
what the index already holds keeps its first ``keep_id``, so of a later batch no row stays, unless its
last doc_id is that very one (a batch that is done again keeps the same rows); very long texts are hashed whole and leave their row as 64 characters; an empty table gives an empty result and adds nothing
to the index; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .common import ascii_lower, materialise

#: Bytes of a row of the index, and of a bucket at most.
ROW_BYTES, BUCKET_BYTES = 100, 128 << 20


def digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes after lower-casing A-Z."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def buckets_for(spark: SparkSession, texts: int) -> int:
    """Buckets of an index that is to hold ``texts`` digests: a bucket fits a task, and no join moves the index."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-texts * ROW_BYTES // BUCKET_BYTES))


class DigestIndex:
    """A bucketed, sorted, append-only table of the digests seen so far.

    ``path`` must lie in a folder that all executors share.  ``buckets`` is fixed for good: by default for
    ``expected`` texts (``buckets_for``).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, name: str | None = None, expected: int = 0):
        self.spark, self.path, self.buckets = spark, path, buckets or buckets_for(spark, expected)
        self.name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT, group_size BIGINT) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def seen(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)       # others may have appended
        return self.spark.table(self.name)

    def unseen(self, reduced: DataFrame) -> DataFrame:
        """The rows of ``reduced``, one per digest, that the index lacks."""
        return reduced.join(self.seen().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, reduced: DataFrame) -> DataFrame:
        """Add the unseen digests; returns them as written (a retried append re-reads the batch)."""
        fresh = materialise(self.unseen(reduced).select("digest", "keep_id", "group_size"), "digest-batch")
        (fresh.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))
        return fresh

    def answer(self, reduced: DataFrame) -> DataFrame:
        """(digest, keep_id, group_size, keep_row): what the index says of the batch's digests; ``keep_row`` is null
        where the row that stays is of an earlier batch."""
        batch = reduced.select("digest", F.col("keep_id").alias("_own"), "keep_row")
        known = batch.join(self.seen().hint("merge"), "digest")
        return known.select("digest", "keep_id", "group_size",
                            F.when(F.col("_own").eqNullSafe(F.col("keep_id")), F.col("keep_row")).alias("keep_row"))

    def drop(self) -> None:
        """Forget the table; its files are those of ``path``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def reduce_batch(digests: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_row, group_size): one row per digest of (digest, doc_id, row) rows."""
    last = F.max(F.struct("doc_id", "row")).alias("last")            # a null id is less than any other
    one = digests.groupBy("digest").agg(last, F.count(F.lit(1)).alias("group_size"))
    return one.select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("keep_row"), "group_size")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Without ``index`` the batch meets an empty one, which goes when it is done."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"),
                       F.monotonically_increasing_id().alias("row"))
    digests = materialise(rows, "digests")               # from here on a row keeps its number
    reduced = materialise(reduce_batch(digests), "digest-groups")
    own = index is None
    index = index or DigestIndex(spark, scratch_path(spark, "digest-index"), expected=reduced.count())
    index.append(reduced)
    told = materialise(index.answer(reduced), "digest-answers")
    if own:
        index.drop()
    found = digests.join(told, "digest")
    return found.select("doc_id", "keep_id", "group_size", F.col("row").eqNullSafe(F.col("keep_row")).alias("kept"),
                        F.col("digest").alias("text_sha256"))
