"""Bag-of-words features and tokens.  DataFrame -> DataFrame.

Term counts of a row are taken inside the row; term totals of the corpus are
combined on the map side before they are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.fixed_values import IGNORED, MAX_FEATURES, MODEL_TURN
from examloom.functions.labels import completion_labels
from examloom.functions.lookup import LookupIndex
from examloom.functions.text import let, once, word_counts, words
from examloom.operators.dictionaries import BlockDictionaries
from examloom.sources.tables import stage


def _top_terms(df: DataFrame, text: str, size: int) -> DataFrame:
    """term, cf (occurrences), df (rows) of the most frequent terms; ties by term."""
    # `inline` over the expression: over a column, the optimizer adds a size filter
    # that repeats the work.
    totals = df.select(F.inline(word_counts(words(text)))).groupBy("term").agg(
        F.sum("tf").alias("cf"), F.count("*").alias("df"))
    return totals.orderBy(F.desc("cf"), "term").limit(size)


def vocabulary(df: DataFrame, text: str = "full_question",
               max_features: int = MAX_FEATURES) -> DataFrame:
    """Kept terms in alphabetical order with their totals."""
    return _top_terms(df, text, max_features).orderBy("term")


def _weights(counts: Column, index: LookupIndex) -> Column:
    """array<struct<term, tfidf>> of the indexed terms, scaled to length one."""
    weighted = F.filter(
        F.transform(counts, lambda c: F.struct(
            c["term"].alias("term"), (c["tf"] * index.look_up(c["term"])).alias("w"))),
        lambda c: c["w"].isNotNull())

    def scaled(kept):
        squares = F.aggregate(kept, F.lit(0.0), lambda a, c: a + c["w"] * c["w"])
        return let(F.sqrt(squares), lambda norm: F.transform(kept, lambda c: F.struct(
            c["term"].alias("term"), (c["w"] / norm).alias("tfidf"))))

    return let(weighted, scaled)


def add_tfidf(df: DataFrame, text: str = "full_question", max_features: int = MAX_FEATURES,
              into: str = "features") -> DataFrame:
    """Add the sparse TF-IDF row as array<struct<term, tfidf>>.

    idf = ln((1 + rows) / (1 + rows with the term)) + 1, rows scaled to length
    one over the kept terms.  The vocabulary (at most `max_features` terms) is a
    scalar subquery, so weighting a row needs neither join nor shuffle.
    """
    rows = df.agg(F.count("*").cast("double")).scalar()
    terms = _top_terms(df, text, max_features).select(
        "term", (F.log((F.lit(1.0) + rows) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))
    index = LookupIndex(terms, "term", "idf", max_features)
    weighted = _weights(word_counts(words(text)), index)
    return index.attach(df).select(*df.columns, weighted.alias(into))


def tfidf(df: DataFrame, *keys: str, text: str = "full_question",
          max_features: int = MAX_FEATURES) -> DataFrame:
    """Long form: the key columns, term, tfidf."""
    rows = add_tfidf(df.select(*dict.fromkeys([*keys, text])), text, max_features, "_features")
    # inline_outer: the plain form would bring the size filter back.
    return rows.select(*keys, F.inline_outer("_features")).filter(F.col("term").isNotNull())


# --- tokens -----------------------------------------------------------------------

def add_token_count(df: DataFrame, text: str = "text", into: str = "token_count") -> DataFrame:
    """Add the number of word tokens."""
    return df.select("*", once(F.size(words(text))).alias(into))


def word_ids(df: DataFrame, text: str = "text", max_vocabulary: int | None = None) -> DataFrame:
    """term, token_id of all words: 1 for the most frequent; ties by term.

    A vocabulary limit holds only if the caller sets one.
    """
    totals = df.select(F.explode(words(text)).alias("term")).groupBy("term").agg(F.count("*").alias("cf"))
    return _ranked(totals, max_vocabulary)


def _ranked(totals: DataFrame, max_vocabulary: int | None) -> DataFrame:
    """Ranks of (term, cf): terms are range-partitioned and sorted by rank and staged with their
    place in the range; a range starts behind the counts of the ranges before it."""
    spark, place_bits = totals.sparkSession, 33  # as `monotonically_increasing_id` has it
    ordered = totals.repartitionByRange(F.desc("cf"), F.asc("term")).sortWithinPartitions(F.desc("cf"), "term")
    ranges = stage(ordered.select("term", F.monotonically_increasing_id().alias("_place")), "word-ranks")
    number = F.shiftright("_place", place_bits)
    offsets, before = [], 0
    for r in ranges.groupBy(number.alias("range")).count().orderBy("range").collect():  # one row per range
        offsets.append((r["range"], before))
        before += r["count"]
    starts = F.broadcast(spark.createDataFrame(offsets, "_range long, _before long"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << place_bits) - 1))
    ids = ranges.withColumn("_range", number).join(starts, "_range").select(
        "term", (F.col("_before") + inside + 1).cast("int").alias("token_id"))
    return ids if max_vocabulary is None else ids.filter(F.col("token_id") <= max_vocabulary)


def tokenize(df: DataFrame, *keys: str, text: str = "text", max_vocabulary: int | None = None,
             split: Column | None = None) -> DataFrame:
    """Key columns, input_ids, attention_mask with the built-in word tokenizer; a staged table.

    A token's id is its rank by frequency (1 is the most frequent).  Nothing is
    truncated or padded.  Only if the caller sets `max_vocabulary`, words behind it
    become 0.  Texts are split once (or were before: `split` holds their words); ranks come
    from the counts of the blocks' dictionaries and return to them, so neither texts nor ids are shuffled.
    """
    return tokenize_with_ids(df, *keys, text=text, max_vocabulary=max_vocabulary, split=split)[0]


def tokenize_with_ids(df: DataFrame, *keys: str, text: str = "text", max_vocabulary: int | None = None,
                      split: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(as `tokenize`, the vocabulary: term, token_id), both from staged tables."""
    blocks = BlockDictionaries(df, words(F.col(text)) if split is None else split, *keys)
    totals = blocks.totals().select(F.col("entry").alias("term"), F.col("n").alias("cf"))
    ids = _ranked(totals, max_vocabulary)
    coded = blocks.replaced(ids, "term", "token_id", "input_ids", F.lit(0))
    return coded.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))), ids


def detokenize(df: DataFrame, ids: DataFrame, *keys: str, input_ids: str = "input_ids", pad_id: int = 0,
               into: str = "text") -> DataFrame:
    """Key columns and the text of rows of token ids, words joined by a space; a staged table.

    `ids`: term, token_id.  Ignored labels are padding, and padding is left out, as are ids the
    vocabulary does not hold.  Null ids give a null text.
    """
    held = F.filter(F.col(input_ids), lambda x: x.isNotNull() & (x != pad_id) & (x != IGNORED))
    blocks = BlockDictionaries(df, held, *keys)
    return blocks.replaced(ids, "token_id", "term", into, F.lit(None).cast("string"), lambda terms: F.array_join(terms, " "))


def add_completion_labels(df: DataFrame, ids: DataFrame, marker: list[str] | None = None,
                          input_ids: str = "input_ids", into: str = "labels", pad_id: int | None = None) -> DataFrame:
    """Add training labels: ignored up to the end of the last marker, then the token ids.

    `marker`: its tokens, by default the words that open a model's turn; `ids`: term, token_id.  A
    marker with a token that no text holds stands nowhere.
    """
    wanted = marker or [w.lower() for w in re.findall(r"\w{2,}", MODEL_TURN)]
    found = {r["term"]: r["token_id"] for r in ids.filter(F.col("term").isin(wanted)).collect()}  # of the marker
    return df.withColumn(into, completion_labels(F.col(input_ids), [found.get(w, -1) for w in wanted], pad_id))


def tokenize_with(df: DataFrame, load_tokenizer: Callable[[], Callable[[list[str]], list]],
                  *keys: str, text: str = "text") -> DataFrame:
    """Key columns, input_ids, attention_mask with the caller's tokenizer.

    `load_tokenizer` runs once per Python worker task and returns a function from
    a list of texts to a list of id lists; texts arrive in Arrow batches.
    """
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load_tokenizer()
        for texts in batches:
            yield pd.Series(tokenizer(texts.fillna("").tolist()), index=texts.index, dtype=object)

    ids = F.pandas_udf(encode, "array<int>")(F.col(text))
    coded = df.select(*keys, ids.alias("input_ids"))
    return coded.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
