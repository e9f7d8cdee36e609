"""What reaches the Parquet scan."""

import re

import pytest
from pyspark.sql import functions as F

from examloom.operators import exam as ex
from examloom.operators import features, split
from examloom.plans import augmenting
from examloom.sources import tables
from tests.helpers import plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("classified") / "t")
    df = spark.range(50).select(
        F.concat(F.lit("q"), "id").alias("id"), F.lit("경제").alias("topic"),
        F.lit("필요 없음").alias("prior_knowledge_needed"), F.repeat(F.lit("p "), 200).alias("paragraph"),
        F.lit("Q").alias("question"), F.array(F.lit("x")).alias("choices"), F.lit(1).alias("answer"),
        F.lit("").alias("question_plus"))
    tables.write_table(df, path)
    return spark.read.parquet(path)


def read_columns(df):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", plan(df, "formatted"))]


def test_label_filter_is_pushed_down(stored):
    text = plan(augmenting.select_sources(stored), "formatted")
    assert "EqualTo(prior_knowledge_needed,필요 없음)" in text


def test_columns_are_pruned(stored):
    assert read_columns(ex.filter_min_length(stored).select("id")) == [{"id", "paragraph"}]
    assert read_columns(features.vocabulary(stored, "question")) == [{"question"}]
    assert read_columns(split.assign_split(stored).select("id", "is_eval")) == [{"id"}]


def test_row_work_needs_no_shuffle(stored):
    flat = ex.add_question_length(ex.add_full_question(ex.append_sentinel_choice(stored)))
    assert "Exchange" not in plan(flat)
