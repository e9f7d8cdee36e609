"""Large CSV files with line breaks in their fields, read in parallel splits.

A line break ends a record only outside quotes.  Whether a split starts inside quotes depends on
the number of quotes before it in the file, so a first pass counts the quotes of each split, modulo
two, and running sums over a file's splits give the state each one starts in.  The second pass
goes through the lines of a split with that state and joins them to records.  Records that reach over
the end of a split come in pieces; only those are shuffled and put together.  No line of a
finished record is moved, and the text is parsed by Spark's own CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.schemas import EXAM_RAW
from examloom.sources.tables import stage

BROADCAST_SPLITS = 1_000_000  # start states of so many splits at most go to all tasks
PIECES = "file string, at long, kind int, first boolean, text string"
WHOLE, REST, OPEN = 0, 1, 2   # a record; the end of an earlier split's record; one that goes on


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, at (start of the split), value: lines in the order of their split."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def _starts(lines: DataFrame) -> DataFrame:
    """file, at, inside, returns: whether the split starts inside quotes, and whether the file's first
    line, and so all, end in a carriage return and a line feed.  One row per split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "at").agg((F.sum(quotes) % 2).alias("odd"), F.first("value").alias("line"))
    of_file = Window.partitionBy("file")
    before = F.sum("odd").over(of_file.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    returns = F.max((F.col("at") == 0) & F.col("line").endswith("\r")).over(of_file)
    return splits.select("file", "at", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"), returns.alias("returns"))


def _assembler():
    """Task that joins the lines of splits to records and pieces of records."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, kind, inside, first = None, [], WHOLE, False, False
        out: list[tuple] = []

        def close() -> None:
            """The split's end: what is held goes on in the next split."""
            if held:
                out.append((*split, REST if kind == REST else OPEN, first, "\n".join(held)))

        def taken() -> pa.RecordBatch:
            rows = list(zip(*out)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                               ["file", "at", "kind", "first", "text"])
            out.clear()
            return batch

        for batch in batches:
            values = batch.column(2)
            odd = (pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2).astype(bool)
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), values.to_pylist(),
                       batch.column(3).to_pylist(), batch.column(4).to_pylist(), odd.tolist())
            for file, at, value, starts_inside, returns, turns in zip(*columns):
                if returns and value.endswith("\r"):
                    value = value[:-1]
                if (file, at) != split:
                    close()
                    split, held, inside, first = (file, at), [], starts_inside, at == 0
                    kind = REST if inside else WHOLE
                held.append(value)
                inside ^= turns
                if not inside:
                    out.append((file, at, kind, first, "\n".join(held)))
                    held, kind, first = [], WHOLE, False
            if out:
                yield taken()
        close()
        if out:
            yield taken()

    return work


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, first (the file's first record), text of every record of the CSV files at `path`."""
    lines = _lines(spark, path)
    starts = stage(_starts(lines), "split-starts")
    if starts.count() <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    started = lines.join(starts, ["file", "at"]).select("file", "at", "value", "inside", "returns")
    pieces = stage(started.mapInArrow(_assembler(), PIECES), "csv-pieces")
    # A record that goes on, then the rests of the splits after it: few rows of each file.
    number = F.sum((F.col("kind") == OPEN).cast("long")).over(
        Window.partitionBy("file").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0))
    cut = pieces.filter(F.col("kind") != WHOLE).withColumn("record", number)
    joined = cut.groupBy("file", "record").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "kind", "text"))),
                                 lambda p: p["text"]), "\n").alias("text"))
    return pieces.filter(F.col("kind") == WHOLE).select("file", "first", "text").unionByName(
        joined.select("file", "first", "text"))


def read_large_csv(spark: SparkSession, path: str, schema: T.StructType = EXAM_RAW) -> DataFrame:
    """As `read_exam_csv`, but each file is read by as many tasks as it has splits.

    The file is read twice, and its records are staged once as text.  A quote has to stand
    where CSV puts it, around a field or doubled inside one: in files with single quotes inside
    unquoted fields states cannot be told, use `read_exam_csv` for those.  Lines end in a line
    feed; where a file's first line ends in a carriage return as well, those are dropped.  A header that does not match the schema
    is an error.  An empty file gives no rows.
    """
    options = {"quote": '"', "escape": '"', "multiLine": True, "mode": "PERMISSIVE"}
    records = csv_records(spark, path).filter("text <> ''")
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema) + 1)])
    header = F.from_csv("text", names.simpleString()[7:-1].replace(":", " "), options)
    found = F.array_compact(F.array(*[header[f"c{i}"] for i in range(len(schema) + 1)]))
    expected = F.array(*[F.lit(f.name) for f in schema])
    checked = F.when(found == expected, F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit("CSV header does not match the schema: "), F.col("text"))).cast("boolean"))
    rows = records.filter(F.when(F.col("first"), checked).otherwise(F.lit(True)))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(F.from_csv("text", ddl, options).alias("r")).select("r.*")
