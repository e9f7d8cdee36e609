"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same columns and rows, else what differs."""
    relation = con.execute(sql)
    expected_columns = [d[0] for d in relation.description]
    expected = _rows(expected_columns, relation.fetchall())
    actual = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(expected_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} rows differ, e.g. {str(wrong[0])[:600]}"
    return None
