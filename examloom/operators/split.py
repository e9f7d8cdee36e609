"""Exact, seeded train / evaluation split.

Rows are ordered by md5(seed:id) and the first ceil(share * n) go to evaluation.
Sorting or numbering the whole table for that would be wasteful: only the key at
the cut matters.  It is found by counting rows per key prefix and looking closer
at the one prefix the cut falls into, three hex digits at a time.  Every pass
reads the id column only and shuffles at most 4096 counters per task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.fixed_values import EVAL_SHARE, SEED

PREFIX_LENGTHS = (3, 6, 32)  # hex digits of the md5 key looked at per pass
COPIES_AT_ONCE = 1_000       # identical rows written from one array


@dataclass(frozen=True)
class Cut:
    """Key the cut falls on, rows with that key, and how many of them to take."""

    key: str
    rows: int
    take: int

    @property
    def is_clean(self) -> bool:
        return self.take == self.rows


def split_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _cut(keys: DataFrame, take: int) -> Cut:
    """Where the `take`-th smallest key of the single column `k` lies.

    The running total sees one row per distinct key: at most 4096 prefixes, or
    the keys left under a six-digit prefix (one in 16.7 million of all keys).
    """
    counted = keys.groupBy("k").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    row = (counted.withColumn("upto", upto).filter(F.col("upto") >= take)
           .orderBy("k").limit(1).first())
    return Cut(row["k"], row["rows"], take - (row["upto"] - row["rows"]))


def find_cut(keys: DataFrame, take: int) -> Cut:
    """Cut behind the `take` smallest values of the hex key column `k`."""
    cut = Cut("", 0, take)
    for length in PREFIX_LENGTHS:
        under = keys.filter(F.startswith("k", F.lit(cut.key))) if cut.key else keys
        cut = _cut(under.select(F.substring("k", 1, length).alias("k")), cut.take)
    return cut


def _deal_copies(copies: DataFrame, take: int) -> DataFrame:
    """`take` of a set of identical rows to evaluation, the others to training.

    Identical rows are counted per input partition instead of numbered one by one, and
    written out again in runs of COPIES_AT_ONCE, dealt over the tasks.
    """
    columns = copies.columns
    slots = copies.withColumn("_slot", F.spark_partition_id())
    counted = slots.groupBy("_slot", *columns).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(
        Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.greatest(F.lit(0), F.least(F.col("_rows"), F.lit(take) - F.col("_before")))
    taken = counted.withColumn("_before", before).withColumn("_take", wanted)
    zero = F.lit(0).cast("bigint")
    runs = taken.withColumn("_first", F.explode(F.sequence(
        zero, F.col("_rows") - 1, F.lit(COPIES_AT_ONCE).cast("bigint")))).repartition("_slot", "_first")
    repeated = runs.withColumn("_n", F.explode(F.sequence(
        F.col("_first"), F.least("_rows", F.col("_first") + COPIES_AT_ONCE) - 1)))
    return repeated.select(*columns, (F.col("_n") < F.col("_take")).alias("is_eval"))


def assign_split(df: DataFrame, id_col: str = "id", test_size: float = EVAL_SHARE,
                 seed: int = SEED) -> DataFrame:
    """Add `is_eval`: true for exactly ceil(test_size * n) rows.

    The result depends on ids and seed, not on row order or partitioning.  Rows
    that share the id at the cut are ordered by content; rows equal in every
    column are interchangeable and only their number counts.  `df` is read
    several times, so hand in a stored table rather than a long plan.
    """
    take = math.ceil(test_size * df.count())
    if take == 0:
        return df.withColumn("is_eval", F.lit(False))
    key = split_key(id_col, seed)
    cut = find_cut(df.select(key.alias("k")), take)
    if cut.is_clean:
        return df.withColumn("is_eval", key <= cut.key)

    content = F.lpad(F.hex(F.xxhash64(*df.columns)), 16, "0")
    same_id = df.filter(key == cut.key)
    inner = find_cut(same_id.select(content.alias("k")), cut.take)
    if inner.is_clean:
        return df.withColumn(
            "is_eval", (key < cut.key) | ((key == cut.key) & (content <= inner.key)))

    on_cut = (key == cut.key) & (content == inner.key)
    others = df.filter(~on_cut).withColumn(
        "is_eval", (key < cut.key) | ((key == cut.key) & (content < inner.key)))
    return others.unionByName(_deal_copies(df.filter(on_cut), inner.take))


def train_eval_split(df: DataFrame, id_col: str = "id", test_size: float = EVAL_SHARE,
                     seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, evaluation) tables."""
    assigned = assign_split(df, id_col, test_size, seed)
    return (assigned.filter(~F.col("is_eval")).drop("is_eval"),
            assigned.filter(F.col("is_eval")).drop("is_eval"))
