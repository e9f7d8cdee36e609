"""TF-IDF, vocabulary and tokens against brute force on a small fixture."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from examloom.operators import features
from tests.helpers import plan

DOCS = [
    "the cat sat on the mat", "the dog ate the cat", "한국어 문장 the 한국어", "", "a b c", None,
    "zebra zebra yak yak", "the cat sat on the mat",
]


@pytest.fixture(scope="module")
def docs(spark):
    # Ids repeat on purpose: every row is a document of its own.
    return spark.createDataFrame(
        [(f"d{n % 7}", t) for n, t in enumerate(DOCS)], "id string, text string").repartition(3)


def tokens(text):
    return re.findall(r"\w{2,}", (text or "").lower())


def ranked(size):
    total = Counter(t for d in DOCS for t in tokens(d))
    return sorted(total, key=lambda t: (-total[t], t))[:size]


def brute_force(size):
    kept = ranked(size)
    found = Counter(t for d in DOCS for t in set(tokens(d)))
    idf = {t: math.log((1 + len(DOCS)) / (1 + found[t])) + 1 for t in kept}
    rows = []
    for n, d in enumerate(DOCS):
        w = {t: c * idf[t] for t, c in Counter(tokens(d)).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        rows += [(f"d{n % 7}", t, round(v / norm, 9)) for t, v in w.items()]
    return sorted(rows)


@pytest.mark.parametrize("size", [3, 1000])
def test_tfidf(docs, size):
    rows = features.tfidf(docs, "id", text="text", max_features=size).collect()
    assert sorted((r["id"], r["term"], round(r["tfidf"], 9)) for r in rows) == brute_force(size)


def test_tfidf_rows_have_length_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = features.add_tfidf(docs, "text").select(F.aggregate(
        "features", F.lit(0.0), lambda a, x: a + x["tfidf"] * x["tfidf"]).alias("s"))
    off = rows.filter((F.abs(F.col("s") - 1) > 1e-9) & (F.col("s") != 0)).count()
    assert off == 0


def test_weighting_neither_joins_nor_copies_the_index(docs):
    text = plan(features.tfidf(docs, "id", text="text"))
    assert "Join" not in text
    assert "AS _index" not in text
    assert "AS _index" not in plan(features.tokenize(docs, "id"))


def test_vocabulary(docs):
    rows = features.vocabulary(docs, "text", 4).collect()
    total = Counter(t for d in DOCS for t in tokens(d))
    found = Counter(t for d in DOCS for t in set(tokens(d)))
    assert [(r["term"], r["cf"], r["df"]) for r in rows] == [
        (t, total[t], found[t]) for t in sorted(ranked(4))]


def test_tokenize(docs):
    order = {t: n + 1 for n, t in enumerate(ranked(5))}
    rows = features.tokenize(docs, "id", "text", max_vocabulary=5).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        if r["text"] is not None:
            assert r["input_ids"] == [order.get(t, 0) for t in tokens(r["text"])]
            assert r["attention_mask"] == [1] * len(r["input_ids"])


def test_tokenize_with_callers_tokenizer(spark):
    def load():
        from tokenizers import Tokenizer, models, pre_tokenizers
        tok = Tokenizer(models.WordLevel({"[UNK]": 0, "the": 1, "cat": 2}, unk_token="[UNK]"))
        tok.pre_tokenizer = pre_tokenizers.Whitespace()
        return lambda texts: [e.ids for e in tok.encode_batch(texts)]

    docs = spark.createDataFrame([("a", "the cat sat"), ("b", ""), ("c", None)], "id string, text string")
    rows = features.tokenize_with(docs, load, "id").orderBy("id").collect()
    assert [(r["input_ids"], r["attention_mask"]) for r in rows] == [
        ([1, 2, 0], [1, 1, 1]), ([], []), ([], [])]


def test_token_count_is_taken_once(docs):
    counted = features.add_token_count(docs).filter("token_count <= 1024")
    assert plan(counted).count("regexp_extract_all") == 1
