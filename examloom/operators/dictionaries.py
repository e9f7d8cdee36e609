"""Replace the elements of arrays through a table of any size, by block dictionaries.

A broadcast of the table is not bounded, and a join of exploded elements shuffles all of them and
the rows they come back to.  Here each block of rows gives its different elements once, with the
rows' arrays as positions in that list.  Only these lists are joined with the table; the values come
back as one bounded array per block, which meets the first row of the block where it is stored; the
block's other rows follow it there, so no row but that one carries the array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from examloom.sources.tables import clear_path, scratch_path, stage

BLOCK_ROWS = 8192
BLOCK_ELEMENTS = 1 << 20  # of a block of several rows
BLOCK_BYTES = 32 << 20    # of a block of several pieces, key columns included
PIECE_ROWS = 512          # rows in Python at once: a row may hold very many elements
BUCKET_BLOCKS = 4         # of a task that follow each other in one bucket
TASK_BUCKETS = 32         # of one task at most: it has an open file for each
GOLDEN = 0.6180339887498949
# Codes are no repeated values, which a dictionary would shorten; a row group is held for each open file.
BLOCK_FILES = {"compression": "zstd", "parquet.enable.dictionary": "false", "parquet.block.size": str(8 << 20)}
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
PARTITIONS = "spark.sql.shuffle.partitions"
FILE_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
SORTED_GROUPS = "spark.sql.execution.replaceHashWithSortAgg"


def _encode(buckets: list[int], names: list[str]):
    """Rows of keys and an array to rows with codes; the first row of a block has its dictionary."""

    def offsets(lengths: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())

    def sizes_of(arrays: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Runs of the batch's rows that are no larger than a block, one row at least."""
        ends = np.cumsum(sizes_of(batch.column(batch.num_columns - 1)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, base + BLOCK_ELEMENTS, "right"))
            stop = max(start + 1, min(stop, start + BLOCK_ROWS))
            yield batch.slice(start, stop - start)
            start = stop

    def block(parts: list[pa.RecordBatch], bucket: int, number: int) -> Iterator[pa.RecordBatch]:
        arrays = [part.column(part.num_columns - 1) for part in parts]
        all_values = pa.chunked_array([a.flatten() for a in arrays]).combine_chunks().dictionary_encode()
        codes, entries, start = all_values.indices, all_values.dictionary, 0
        counts = pa.array(np.bincount(codes.to_numpy(zero_copy_only=False), minlength=len(entries)), pa.int32())
        for i, (part, array) in enumerate(zip(parts, arrays)):
            n, lengths = part.num_rows, sizes_of(array)
            first = np.zeros(n, np.int64)
            first[0] = 0 if i else len(entries)
            own = codes.slice(start, int(lengths.sum()))
            start += len(own)
            yield pa.RecordBatch.from_arrays([
                *part.columns[:-1], pa.array(np.full(n, bucket, np.int32)), pa.array(np.full(n, number, np.int64)),
                pa.ListArray.from_arrays(offsets(lengths), own, mask=pc.is_null(array)),
                pa.ListArray.from_arrays(offsets(first), entries.slice(0, first[0])),
                pa.ListArray.from_arrays(offsets(first), counts.slice(0, first[0]))], names)

    def encoded(parts: list[pa.RecordBatch], task: int, number: int) -> Iterator[pa.RecordBatch]:
        run = number // BUCKET_BLOCKS % TASK_BUCKETS
        away = int(run * GOLDEN * len(buckets))  # runs of neighbouring tasks spread evenly, however many there are
        return block(parts, buckets[(task + away) % len(buckets)], (task << 32) + number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held, sizes = [], np.zeros(3, np.int64)  # rows, elements, bytes
        most = np.array([BLOCK_ROWS, BLOCK_ELEMENTS, BLOCK_BYTES])
        for batch in batches:
            for piece in pieces(batch):
                size = np.array([piece.num_rows, sizes_of(piece.column(piece.num_columns - 1)).sum(), piece.nbytes])
                if held and (sizes + size > most).any():
                    yield from encoded(held, task, number)
                    held, sizes, number = [], 0, number + 1
                held.append(piece)
                sizes = sizes + size
        if held:
            yield from encoded(held, task, number)

    return work


def _decode(names: list[str], kind: pa.DataType):
    """Rows of keys, block, codes and, in the first row of a block, its values, to keys and arrays of values."""

    def sizes_of(arrays: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, values = None, pa.array([], kind)
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column(batch.num_columns - 3).to_numpy(zero_copy_only=False)
            codes, given = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            starts = [0, *(np.flatnonzero(np.diff(blocks)) + 1), batch.num_rows]
            for start, stop in zip(starts, starts[1:]):
                part = codes.slice(start, stop - start)
                if blocks[start] != current:  # a block without elements has no values
                    current = blocks[start]
                    values = given[int(start)].values if given[int(start)].is_valid else pa.array([], kind)
                found = pc.take(values, part.flatten())  # fails for rows that do not follow their block's first
                ends = np.concatenate([[0], np.cumsum(sizes_of(part))])
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(start, stop - start) for c in batch.columns[:-3]],
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found, mask=pc.is_null(part))], names)

    return work


_LABELS: dict[int, list[int]] = {}


def _bucket_labels(spark: SparkSession, buckets: int) -> list[int]:
    """One number for each bucket, so that tasks can be dealt evenly over them."""
    if buckets not in _LABELS:
        _LABELS[buckets] = _find_labels(spark, buckets)
    return _LABELS[buckets]


def _find_labels(spark: SparkSession, buckets: int) -> list[int]:
    numbers = spark.range(0, buckets * (buckets.bit_length() + 12), 1, 1).select(F.col("id").cast("int").alias("n"))
    found: dict[int, int] = {}
    for r in numbers.select("n", F.pmod(F.hash("n"), F.lit(buckets)).alias("bucket")).collect():
        found.setdefault(r["bucket"], r["n"])
    return sorted(found.values())


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def _few_rows(spark: SparkSession):
    """At once in Python, and in the reader of the blocks."""
    at_once = int(spark.conf.get(ARROW_ROWS))
    with _setting(spark, ARROW_ROWS, str(min(at_once, PIECE_ROWS) if at_once > 0 else PIECE_ROWS)), \
            _setting(spark, READ_ROWS, str(min(int(spark.conf.get(READ_ROWS)), PIECE_ROWS))):
        yield


class BlockDictionaries:
    """The staged rows of `df`: key columns and the array `values`, encoded block by block.

    `values` is evaluated once.  Blocks hold up to BLOCK_ROWS rows (of BLOCK_ELEMENTS and about BLOCK_BYTES
    at most) that follow each other in a task, or one row with a very long array.  The table is bucketed; a block's rows stay together in
    one file, and a task goes on to another bucket after BUCKET_BLOCKS blocks, so that a bucket's values fit a task that joins them.
    Null arrays stay null; arrays must not hold nulls.
    """

    def __init__(self, df: DataFrame, values: Column, *keys: str):
        self.spark, self.keys = df.sparkSession, list(keys)
        self.buckets = buckets = int(self.spark.conf.get(PARTITIONS))
        rows = df.select(*keys, values.alias("_values"))
        kind = rows.schema["_values"].dataType.elementType
        schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_bucket", T.IntegerType()),
                               T.StructField("_block", T.LongType()), T.StructField("_codes", T.ArrayType(T.IntegerType())),
                               T.StructField("_entries", T.ArrayType(kind)),
                               T.StructField("_counts", T.ArrayType(T.IntegerType()))])
        encoded = rows.mapInArrow(_encode(_bucket_labels(self.spark, buckets), schema.names), schema)
        self.table = f"block_dictionaries_{uuid4().hex}"
        # With open files for all its buckets Spark does not sort a task's rows by bucket first: a sort that spills
        # mixes rows of one bucket, which have to stay behind their block's first.
        self.path = scratch_path(self.spark, "blocks")
        with _few_rows(self.spark), _setting(self.spark, FILE_WRITERS, str(min(TASK_BUCKETS, buckets) + 1)):
            encoded.write.bucketBy(buckets, "_bucket").options(**BLOCK_FILES).option("path", self.path) \
                .format("parquet").saveAsTable(self.table)
        self.rows = self.spark.table(self.table)

    def totals(self) -> DataFrame:
        """entry, n: how often each element occurs, from the blocks' counts."""
        return self.rows.select(F.inline(F.arrays_zip(
            F.col("_entries").alias("entry"), F.col("_counts").alias("n")))).groupBy("entry").agg(F.sum("n").alias("n"))

    def replaced(self, table: DataFrame, key: str, value: str, into: str, missing: Column,
                 finish: Callable[[Column], Column] = lambda values: values) -> DataFrame:
        """Staged rows of the keys and `into`: each element as its value in `table`, else `missing`.

        `finish` makes `into` of the array of values, before it is staged.
        A block has an element once, so even one that all blocks hold is a small share of what is
        joined.  The dictionary table is dropped with its files.
        """
        pairs = self.rows.select("_bucket", "_block", F.posexplode("_entries").alias("_at", key))
        valued = pairs.join(table.select(key, F.col(value).alias("_value")), key, "left").select(
            "_bucket", "_block", "_at", F.struct(F.coalesce("_value", missing).alias("v")).alias("_value"))  # nulls stay
        # In order, so that a task holds one block's list at a time.
        of_block = valued.repartition(self.buckets, "_bucket").sortWithinPartitions("_bucket", "_block", "_at").groupBy(
            "_bucket", "_block").agg(F.collect_list("_value").alias("_list")).select(
            "_bucket", "_block", F.col("_list.v").alias("_replacements"))
        kind = of_block.schema["_replacements"].dataType
        # Only a block's first row has entries; it meets the values, and the rows behind it take them from there.
        left, right = self.rows.alias("r"), of_block.hint("shuffle_hash").alias("d")
        joined = left.join(right, (F.col("r._bucket") == F.col("d._bucket")) & (F.col("r._block") == F.col("d._block"))
                           & (F.size("r._entries") > 0), "left").select(
            *[F.col(f"r.`{k}`") for k in self.keys], "r._block", "r._codes", "d._replacements")
        schema = T.StructType([*[self.rows.schema[k] for k in self.keys], T.StructField("_values", kind)])
        decoded = joined.mapInArrow(_decode(schema.names, to_arrow_type(kind.elementType)), schema)
        # The rows are stored by `_bucket`, which is enough for a join by bucket and block.
        with _setting(self.spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"), \
                _setting(self.spark, SORTED_GROUPS, "true"), _setting(self.spark, PARTITIONS, str(self.buckets)), _few_rows(self.spark):
            result = stage(decoded.select(*[F.col(f"`{k}`") for k in self.keys], finish(F.col("_values")).alias(into)), "replaced")
        self.spark.sql(f"DROP TABLE {self.table}")
        clear_path(self.spark, self.path)
        return result
