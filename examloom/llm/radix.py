"""Distributed LSD radix sort: rows get their rank by stable counting-sort passes over key digits.

The rows lie in blocks of consecutive places.  A pass counts a digit's values per block, turns
the counts into global prefix offsets (all smaller digit values, then the same value in earlier
blocks, then the rows before in the block) and moves each row to the place so found.  Passes go
from the least digit of the last key to the greatest of the first; a pass keeps the order of those
before it, so after the last one a row's place is its rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from examloom.llm.common import staged

DIGIT_BITS = 11
BLOCK_BITS = 16  # rows of a block: the most that one task sorts together
SIGN = -(1 << 63)


def _digits(key: Column, least: int, greatest: int) -> list[Column]:
    """Digits of an ascending key, least first, as few as its span needs."""
    span = greatest - least
    if span < 1 << 63:
        code = key - F.lit(least)
    else:  # as an unsigned number
        code = key.bitwiseXOR(F.lit(SIGN))
    return [F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")
            for at in range(0, span.bit_length(), DIGIT_BITS)]


def _pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One stable counting sort: the rows with their new places."""
    rows = rows.withColumn("_digit", digit).withColumn("_block", F.shiftright("_place", BLOCK_BITS))
    counts = rows.groupBy("_digit", "_block").agg(F.count("*").alias("_n"))
    # Offsets: over digit values (a table of fixed size), then over the blocks of one value.
    values = counts.groupBy("_digit").agg(F.sum("_n").alias("_n")).select("_digit", F.coalesce(F.sum("_n").over(
        W.orderBy("_digit").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_smaller"))
    blocks = counts.select("_digit", "_block", F.coalesce(F.sum("_n").over(
        W.partitionBy("_digit").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    offsets = blocks.join(F.broadcast(values), "_digit").select(
        "_digit", "_block", (F.col("_smaller") + F.col("_earlier")).alias("_offset"))
    local = F.row_number().over(W.partitionBy("_digit", "_block").orderBy("_place")) - 1
    return rows.withColumn("_local", local).join(offsets, ["_digit", "_block"]).withColumn(
        "_place", F.col("_offset") + F.col("_local")).drop("_digit", "_block", "_local", "_offset")


def radix_rank(rows: DataFrame, keys: list[tuple[str, bool]], into: str) -> DataFrame:
    """Add `into`: 0, 1, 2, ... in the order of `keys`, (name of a long column, descending) each.

    Nulls come last.  Rows equal in all keys are in any order.  Keys are looked at once for
    their span: only digits that differ get a pass.  The table is written before the first pass, so
    the places that passes start from stay the same if a task runs again, and after every pass.
    An empty table stays empty.
    """
    spark_rows = staged(rows.withColumn("_place", F.monotonically_increasing_id()), "radix")
    spans = spark_rows.agg(*[x for name, _ in keys for x in (
        F.min(name), F.max(name), F.max(F.col(name).isNull().cast("int")))]).first()
    digits: list[Column] = []
    for i, (name, down) in reversed(list(enumerate(keys))):
        least, greatest, nulls = spans[3 * i:3 * i + 3]
        if least is not None:
            column = F.coalesce(F.col(name), F.lit(least)).cast("long")
            if down:  # the bitwise complement turns the order round
                column, least, greatest = F.bitwise_not(column), ~greatest, ~least
            digits += _digits(column, least, greatest)
        if nulls:
            digits.append(F.col(name).isNull().cast("int"))
    if not digits:  # one key value: the places are not gapless yet
        digits = [F.lit(0)]
    for digit in digits:
        spark_rows = staged(_pass(spark_rows, digit), "radix")
    return spark_rows.withColumnRenamed("_place", into)
