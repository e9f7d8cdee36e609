"""The pipeline, stage by stage, against plain definitions."""

import re

import corpus_pipeline
from tests.llm import brute


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    kept, tables = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns
        tables[name] = kept.collect()

    good = {}
    for i, r in given.items():
        counts = brute.quality_counts(r["text"])
        if counts[0] >= 20 and 100 * counts[4] <= 30 * counts[0]:
            good[i] = r["text"]
    assert {r["doc_id"] for r in tables["quality_rules"]} == set(good)  # no host is that bad here

    first = {}
    for i in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", good[i]), i)
    assert {r["doc_id"] for r in tables["exact_dedup"]} == set(first.values())

    near = brute.near_components({i: good[i] for i in first.values()}, 80, 5)
    heads = {i for i, (_, c) in near.items() if i == c}
    assert {r["doc_id"] for r in tables["ngram_jaccard"]} == heads

    mixed = tables["mix_sources"]
    assert {r["doc_id"] for r in mixed} <= heads
    assert all(r["text"] == given[r["doc_id"]]["text"] for r in mixed)
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in final) == sorted(r["doc_id"] for r in mixed)
    assert all(r["exact"] and r["n_tokens"] * 4 == len(r["ids"]) for r in final)
