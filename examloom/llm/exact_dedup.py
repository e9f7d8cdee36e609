"""Exact dedup with a persistent digest index, bucketed and sorted by the digest.

New rows are digested, reduced to one row per digest on the map side, and joined with
the index by a sort-merge anti join; what is left is appended.  The index is bucketed
and sorted by the digest, so it is never shuffled for that.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.llm.common import WHITE, attach, columns, partitions, scratch, staged


def text_digest(text: Column) -> Column:
    """SHA-256 (hex) of the text with every run of white space as one space; null is empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]+", " "), 256)


VERSION = 2   # of the index' form
BATCHES = 3   # in which a table meets the index
INDEX = "digest STRING, keep_id BIGINT, n_rows BIGINT, batch BIGINT"


class DigestIndex:
    """Table (digest, keep_id, n_rows, batch) at `path`; it outlives the session.

    The number of buckets is fixed when the index is made (by default the session's shuffle
    partitions: about one per 100 million digests' share of a task) and stored beside it with the version,
    as reading it by another number would miss digests.  Opening it with other buckets, or
    without that note, is an error.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        note = self._note()
        if note is None:
            if self._exists(self.path):
                raise ValueError(f"{path} holds files but no note of an index")
            note = (VERSION, buckets or partitions(spark))
            spark.createDataFrame([note], "version int, buckets int").coalesce(1).write.parquet(f"{self.path}.note")
        version, self.buckets = note
        if version != VERSION or buckets not in (None, self.buckets):
            raise ValueError(f"the index at {path} has version {version} and {self.buckets} buckets")
        # The whole path names the table: ends of paths may be alike.
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:40]
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.table} ({INDEX}) USING parquet
                      CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS
                      LOCATION '{self.path}'""")

    def _exists(self, path: str) -> bool:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

    def _note(self) -> tuple[int, int] | None:
        if not self._exists(f"{self.path}.note"):
            return None
        return tuple(self.spark.read.schema("version int, buckets int").parquet(f"{self.path}.note").first())

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def batches(self) -> int:
        """Number of the last batch that added digests, 0 for an empty index."""
        return self.rows().agg(F.max("batch")).first()[0] or 0

    def append_new(self, groups: DataFrame, batch: int) -> None:
        """Append the digests that the index lacks.  `groups`: one row per digest."""
        new = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        # All of the result is computed before the append is committed.
        new = staged(new.select("digest", "keep_id", "n_rows", F.lit(batch).cast("long").alias("batch")), "new-digests")
        new.repartition(self.buckets, "digest").sortWithinPartitions("digest") \
            .write.format("parquet").mode("append").bucketBy(self.buckets, "digest") \
            .sortBy("digest").option("path", self.path).saveAsTable(self.table)

    def close(self) -> None:
        """Forget the session's table; the index stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _ranges(rows: DataFrame, batches: int) -> list[Column]:
    """Conditions that deal the rows into batches of about equal size by ascending doc_id, null last."""
    cuts = rows.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    cuts = sorted({int(c) for c in cuts})
    id_ = F.col("doc_id")
    lows, highs = [None, *cuts], [*cuts, None]
    return [F.coalesce((id_ > low) if low is not None else F.lit(True), F.lit(high is None))
            & F.coalesce((id_ <= high) if high is not None else F.lit(True), F.lit(False))
            for low, high in zip(lows, highs)]


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id",
                text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    The rows meet the index in `batches` of ascending ids, so that of equal texts the row with the
    smallest id enters it; later batches find that text known and add nothing.  A text that the
    index knew before this call keeps the row of that time, and none of this one.
    `group_size`: rows of this call with that text.  Null texts count as empty.  Null ids
    are larger than any other; rows with equal id and text cannot be told apart,
    so of those one is kept (`kept` is true for the row numbered first among them).
    Texts of any length become one digest before anything is shuffled; other columns are not read.
    Empty input gives no row and leaves the index as it is.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       text_digest(F.col(f"`{text_col}`")).alias("digest"))
    rows = staged(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("_copies")), "digest-rows")
    before = index.batches()
    for batch, part in enumerate(_ranges(rows, batches), before + 1):
        index.append_new(rows.filter(part).groupBy("digest").agg(
            F.min("doc_id").alias("keep_id"), F.sum("_copies").alias("n_rows")), batch)
    totals = rows.groupBy("digest").agg(F.sum("_copies").alias("n_rows"), F.count("*").alias("_n"))
    verdict = staged(totals.join(index.rows().drop("n_rows").hint("merge"), "digest").select(
        "digest", "n_rows", "_n", "keep_id", (F.col("batch") <= before).alias("_old")), "digest-verdicts")
    out = attach(rows, verdict, "digest", "_n")
    first = ~F.col("_old") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select(
        "doc_id", "keep_id", F.col("n_rows").alias("group_size"), first.alias("_first"),
        F.col("digest").alias("text_sha256"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"),
    ).select("doc_id", "keep_id", "group_size",
             (F.col("_first") & (F.col("_copy") == 1)).alias("kept"), "text_sha256")


def new_index(spark: SparkSession, name: str = "digest-index") -> DigestIndex:
    return DigestIndex(spark, scratch(spark, name))


def keep_first(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows with equal id and equal text are reduced to one, whichever of them it is.
    """
    def key(doc_id, digest):
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), digest)

    kept = deduplicate(docs, index).filter("kept").select(
        key(F.col("doc_id"), F.col("text_sha256")).alias("__key"))
    rows = docs.withColumn("__key", key(docs["doc_id"], text_digest(docs["text"])))
    # The join leaves the rows dealt and sorted by the key; dropping repeats needs no shuffle.
    return rows.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


SQL = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id, text_sha256, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size
  FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g'))
               AS text_sha256 FROM documents)
  WINDOW w AS (PARTITION BY text_sha256))"""
