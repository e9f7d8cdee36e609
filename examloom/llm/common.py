"""Helpers the operators share: staged tables, joins that stand hot keys, numbering."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

WHITE = r"\x20\x09-\x0D"  # white space of the contracts
_STAGED: list[str] = []
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # of the tables `staged` returned
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch(spark: SparkSession, name: str) -> str:
    """New path in the folder the cluster shares.

    That is `spark.checkpoint.dir`; where it is unset (tests), the warehouse, which
    executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    _STAGED.append(f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _STAGED[-1]


@contextmanager
def staging(spark: SparkSession):
    """Tables that operators stage inside the block are removed at its end: write the results in it."""
    before = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[before:]:
            _delete(spark, path)
        del _STAGED[before:]


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives
    lost executors, and later readers fetch only their columns."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def unstage(table: DataFrame) -> None:
    """Remove a table that `staged` returned and that no later step reads."""
    path = _PATHS.pop(table)
    _delete(table.sparkSession, path)
    _STAGED.remove(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """Tasks in Python that start inside the block get at most so many rows at once: less memory
    for long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if int(before) <= 0 or int(before) > most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """The named columns cast to their types; whatever else the table holds is left out,
    so that no column of the caller can clash with one of an operator."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in wanted.items()])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def attach(left: DataFrame, groups: DataFrame, key: str, rows: str) -> DataFrame:
    """Inner join of rows with the one row of `groups` that has their key.

    `rows` is the column of `groups` with the number of left rows of that key.  A key is
    hot when it holds more than 1/P of all rows (P: shuffle partitions).  By arithmetic
    fewer than P keys are hot, so those go out by broadcast and their rows stay where
    they are; the others are joined by a shuffle with less than an average task per key.
    Where no key is hot, which the counts show, one plain join does.
    `groups` should be staged; `rows` is dropped from the result if it starts with `_`.
    """
    p = partitions(left.sparkSession)
    total, most = groups.agg(F.sum(rows), F.max(rows)).first()  # two numbers
    if (most or 0) * p <= (total or 0):
        joined = left.join(groups, key)
    else:
        is_hot = F.col(rows) * F.lit(p) > F.lit(total)
        hot = F.broadcast(groups.filter(is_hot))
        joined = left.join(hot, key).unionByName(
            left.join(hot.select(key), key, "left_anti").join(groups.filter(~is_hot), key))
    return joined.drop(rows) if rows.startswith("_") else joined


def running(df: DataFrame, group: list[str], order: str, weight: Column, out: str,
            buckets: int, ties: list[str] | None = None) -> DataFrame:
    """Sum of `weight` over the earlier rows of the group, in ascending `order`.

    For groups of any size: `order` is a hash (long) whose top bits cut a group
    into `buckets` ranges (rounded up to a power of two).  Sums per range are combined before their shuffle and added up in a window
    of `buckets` rows a group; the rows themselves meet in windows of one range.  Rows
    of one hash value share their sum; with `ties` they are told apart by those columns,
    and rows equal in them too are taken in any order.
    """
    bits = max(0, (buckets - 1).bit_length())
    bucket = F.shiftright(order, 64 - bits) if bits else F.lit(0).cast("long")
    rows = df.withColumn("_bucket", bucket) \
        .withColumn("_weight", weight.cast("long"))
    sums = rows.groupBy(*group, "_bucket").agg(F.sum("_weight").alias("_sum"))
    before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = W.partitionBy(*group, "_bucket")
    inside = inside.orderBy(order).rangeBetween(W.unboundedPreceding, -1) if ties is None else \
        inside.orderBy(order, *ties).rowsBetween(W.unboundedPreceding, -1)
    same = F.lit(True)
    for name in [*group, "_bucket"]:
        same = same & F.col(f"r.{name}").eqNullSafe(F.col(f"s.{name}"))
    joined = rows.alias("r").join(sums.alias("s"), same).select(
        *[F.col(f"r.{c}") for c in rows.columns], F.col("s._before"))
    return joined.withColumn(out, F.col("_before") + F.coalesce(F.sum("_weight").over(inside), F.lit(0))) \
        .drop("_bucket", "_weight", "_before")


def unsigned32(value: Column) -> Column:
    return value.bitwiseAND(F.lit(0xFFFFFFFF))


def blocks(texts, limit: int):
    """(start, stop) of runs of an Arrow text column with about `limit` bytes, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def flat_bytes(texts):
    """(all bytes, ends) of an Arrow text column without nulls; text i is bytes ends[i]:ends[i + 1]."""
    import numpy as np
    import pyarrow as pa

    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, ends - ends[0]


def identified(docs: DataFrame, last: int) -> DataFrame:
    """id, text, text_key, doc_id of documents: null texts empty, null ids `last`.

    The key tells documents of one id apart; where all ids differ it is 0 and takes no room.
    """
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("`doc_id`").cast("long"), F.lit(last)).alias("id"),
                       text.alias("text"), F.col("`doc_id`").cast("long").alias("doc_id"))
    repeated = rows.groupBy("id").count().filter("count > 1").limit(1).count()
    return rows.select("id", "text", (F.xxhash64("text") if repeated else F.lit(0).cast("long")).alias("text_key"), "doc_id")
