"""Joins of questions with one-row-per-id tables of replies or scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """key, groups: the values that hold more than 1/P of the rows (P: shuffle partitions).

    Fewer than P values can, by arithmetic.  `groups` is the number of average tasks
    their rows would fill.  Nothing runs before the result is used.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    total = df.agg(F.count("*")).scalar()
    filled = F.col("_rows") * tasks / total
    return counts.filter(F.col(key).isNotNull() & (filled > 1)).select(
        key, F.ceil(filled).cast("long").alias("groups"))


def join_by_id(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Left join with a table that has one row per key.

    The rows of a hot key are dealt one by one into groups of about an average task,
    and its right row is repeated per group; rows without a key, which match nothing, are
    dealt over all tasks.  The right side grows by fewer than 2P rows.  The key column
    of `left` is read a second time to count it, so stage costly inputs first.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, key).withColumnRenamed("groups", "_groups"))
    groups = F.when(F.col(key).isNull(), tasks).otherwise(F.coalesce("_groups", F.lit(1)))
    salted = left.join(hot, key, "left").withColumn(
        "_salt", F.monotonically_increasing_id() % groups).drop("_groups")
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_groups", F.lit(1)) - 1)
    repeated = right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_groups")
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")
