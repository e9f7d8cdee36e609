"""Tables in and out."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.functions.literals import python_literal
from examloom.schemas import EXAM_RAW

# Quoted fields hold line breaks, and a quote inside a field is doubled.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"'}
CSV_FILE_ROWS = 5_000  # of a file written: one task reads a whole file


def read_exam_csv(spark: SparkSession, path: str, schema: T.StructType = EXAM_RAW) -> DataFrame:
    """Exam CSV with a header row.

    Fields may contain line breaks, so a file cannot be split: one file is one
    task.  Ship large data as many files and convert it to Parquet once.  A header
    that does not match the schema is an error.
    """
    return spark.read.schema(schema).csv(
        path, multiLine=True, enforceSchema=False, **CSV_FORMAT)


def _as_text(df: DataFrame, nested: str) -> DataFrame:
    def column(field):
        if not isinstance(field.dataType, (T.StructType, T.ArrayType)):
            return F.col(field.name)
        if nested == "json":
            return F.to_json(field.name).alias(field.name)
        text = python_literal(F.col(field.name), field.dataType)
        return F.when(F.col(field.name).isNotNull(), text).alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, nested: str = "python", mode: str = "overwrite") -> None:
    """CSV with a header; lists and structs become Python-literal or JSON text.

    A task writes several files of up to CSV_FILE_ROWS rows, as a file is read by one task.
    """
    _as_text(df, nested).write.mode(mode).option("maxRecordsPerFile", CSV_FILE_ROWS).csv(
        path, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        **CSV_FORMAT)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, nested columns as they are."""
    df.write.mode(mode).parquet(path)


_STAGED: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path in a folder that all executors share.

    That is `spark.checkpoint.dir`; where it is unset, the warehouse, which executors
    share as well.  `clear_staged` removes it.
    """
    folder = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
              or spark.conf.get("spark.sql.warehouse.dir"))
    _STAGED.append(f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _STAGED[-1]


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table once and read it back.

    For results that several outputs are made from: the work before it is not
    repeated, later reads fetch only the columns they need, and a lost executor
    costs a re-read instead of the whole plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_path(spark: SparkSession, path: str) -> None:
    """Remove what was written to a scratch path and is not read any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    _STAGED.remove(path)


def clear_staged(spark: SparkSession, keep: int = 0) -> None:
    """Remove what this process has staged, but for the first `keep` tables."""
    for path in _STAGED[keep:]:
        clear_path(spark, path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are removed at its end: write the results in it."""
    before = len(_STAGED)
    try:
        yield
    finally:
        clear_staged(spark, before)
