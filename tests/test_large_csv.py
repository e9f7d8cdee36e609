"""The splittable CSV reader against the one that takes a file as a whole."""

import random

import pytest
from pyspark.sql import types as T

from examloom.sources.large_csv import csv_records, read_large_csv
from examloom.sources.tables import read_exam_csv

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "a", "b")])


def field(rng):
    text = "".join(rng.choice(["x", "yz", ",", '"', "\n", "\n\n", "'", " ", "한", '""', ""]) for _ in range(rng.randrange(12)))
    if rng.random() < .3:
        text = text.replace('"', "").replace("\n", "").replace(",", "")
    return text


def quoted(text, rng):
    if any(c in text for c in ',"\n') or rng.random() < .3:
        return '"' + text.replace('"', '""') + '"'
    return text


def write(path, rows, rng, end="\n", last=True):
    lines = ["id,a,b"] + [",".join(quoted(f, rng) for f in r) for r in rows]
    path.write_bytes((end.join(lines) + (end if last else "")).encode())


def both(spark, path, schema=SCHEMA):
    key = lambda r: tuple("" if v is None else v for v in r) + tuple(v is None for v in r)
    return [sorted(map(tuple, f(spark, str(path), schema).collect()), key=key) for f in (read_exam_csv, read_large_csv)]


@pytest.mark.parametrize("size", ["60", "100000"])
@pytest.mark.parametrize("last", [True, False])
def test_equal_to_the_whole_file_reader(spark, conf, tmp_path, size, last):
    conf("spark.sql.files.maxPartitionBytes", size)
    conf("spark.sql.files.openCostInBytes", "1")
    for seed in range(2):
        rng = random.Random(seed)
        folder = tmp_path / f"{seed}"
        folder.mkdir()
        for n in range(2):
            rows = [(f"{n}-{i}", field(rng), field(rng)) for i in range(8)]
            write(folder / f"{n}.csv", rows, rng, last=last)
        whole, split = both(spark, folder)
        assert len(whole) == 16 and split == whole


def test_many_tasks_read_one_file(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "8000")
    conf("spark.sql.files.openCostInBytes", "1")
    rng = random.Random(1)
    write(tmp_path / "a.csv", [(str(i), "long\n" * 20, f"a {i}") for i in range(500)], rng)
    records = csv_records(spark, str(tmp_path))
    assert records.filter("first").count() == 1 and records.count() == 501
    whole, split = both(spark, tmp_path)
    assert split == whole
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5


def test_one_record_over_many_splits(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "90")
    conf("spark.sql.files.openCostInBytes", "1")
    write(tmp_path / "a.csv", [("1", "line\n" * 200, "x"), ("2", "y", 'q"\n"'), ("3", "", "")], random.Random(1))
    whole, split = both(spark, tmp_path)
    assert len(whole) == 3 and split == whole


def test_carriage_returns_and_empty_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,a,b\r\n1,"x\r\ny",z\r\n\r\n2,"",\r\n')
    whole, split = both(spark, tmp_path)
    assert len(split) == 2 and split == whole


def test_header_has_to_match(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,other,b\n1,2,3\n")
    with pytest.raises(Exception, match="header"):
        read_large_csv(spark, str(tmp_path), SCHEMA).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,a,b\n")
    assert read_large_csv(spark, str(tmp_path), SCHEMA).collect() == []
