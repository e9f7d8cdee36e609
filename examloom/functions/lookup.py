"""Look values up in a small table from inside array expressions.

A broadcast join needs the array exploded and the row put together again, which
costs a shuffle.  A table whose size is capped by construction (a vocabulary of
at most `size` terms) can instead travel as one scalar value.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class LookupIndex:
    """A small table as one scalar value array<map<key, value>>.

    Spark searches a map from front to back; hash buckets of about eight entries
    keep each look-up short.  `entries` must hold at most `size` rows with unique
    keys.  Look-ups go through a named column, because a subquery may not stand
    inside a lambda; the optimizer then moves the subquery to that one place.  Use
    it in a single expression: a second use would copy the index into every row.
    """

    def __init__(self, entries: DataFrame, key: str, value: str, size: int):
        self.buckets = max(1, size // 8)
        # One empty row per bucket, so that a bucket's number is its position.
        empty = entries.sparkSession.range(self.buckets).select(F.col("id").alias("bucket"))
        filled = entries.select(
            self._bucket(F.col(key)).cast("bigint").alias("bucket"),
            F.struct(F.col(key).alias("key"), F.col(value).alias("value")).alias("entry"),
        ).unionByName(empty, allowMissingColumns=True)
        by_bucket = filled.groupBy("bucket").agg(F.collect_list("entry").alias("entries"))
        in_order = by_bucket.agg(
            F.sort_array(F.collect_list(F.struct("bucket", "entries"))).alias("b"))
        self._scalar = in_order.select(
            F.transform("b", lambda x: F.map_from_entries(x["entries"]))).scalar()

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_index", self._scalar)

    def look_up(self, key: Column) -> Column:
        """Value stored for `key`, null if it is not in the index."""
        return F.try_element_at(F.get(F.col("_index"), self._bucket(key)), key)
