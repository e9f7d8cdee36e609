"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from examloom.llm import (
    bpe, chat, exact_dedup, extraction, infilling, jaccard, licenses, long_repeats, mixing, quality, resampling, sharding,
    word_repeats,
)
from examloom.llm.registry import query


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_quality_rules", quality.SQL)
def op8(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op9_exact_dedup", exact_dedup.SQL)
def op9(spark, sf_dir):
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"), exact_dedup.new_index(spark))


@query("op7_license_scan", licenses.SQL)
def op7(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op1_mix_sources", mixing.SQL)
def op1(spark, sf_dir):
    return mixing.select(table(spark, sf_dir, "documents"))


@query("op10_chat_format", chat.SQL)
def op10(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)], turns.schema)
    return chat.read_back(chat.format_chats(turns.unionByName(probe)))


@query("op5_byte_bpe")
def op5(spark, sf_dir):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op3_html_extraction")
def op3(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages"))


@query("op4_sharding")
def op4(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op2_ngram_jaccard")
def op2(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"), jaccard.Threshold(85, 4))


@query("op6_long_repeats")
def op6(spark, sf_dir):
    kept = long_repeats.remove(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query("op11_importance_resampling", resampling.SQL)
def op11(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_fill_in_middle", infilling.SQL)
def op12(spark, sf_dir):
    return infilling.digests(table(spark, sf_dir, "documents"))


@query("op13_substring_dedup")
def op13(spark, sf_dir):
    kept = word_repeats.remove(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
