"""Exact Jaccard join on word shingles, filtered under several global token orders.

Sets that are equal are one from the start.  All orders put rare tokens first; how rare a token is
comes from a table of counts of fixed size, so the table can be sent to every task, and any
table gives a valid order.  Under each order two linked sets share a token among the first
`size - least overlap + 1` of both.  Sets that share one under the first order are found by
a join on the token; they must also share one under the other orders, be of like size, and
differ in few enough bits of a parity map.  What is left is verified on the whole sets.

Large groups of near copies would make all pairs of a token's sets.  So every token's sets are
first compared with one centre only, and what is linked becomes one component: a set with the
largest of its centres, then with those still in other components.  Copies of copies may be linked
with other sets than that centre.  So rounds follow in which each token of several components gets another
centre, by turns out of its largest one and out of all: rows that grow with
the tokens, not with the pairs of a group.  After that, sets
of one token are compared only across components, where the place of the token in both prefixes
and a larger parity map leave few pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm import shingles, sketches
from examloom.llm.common import attach, blocks, partitions, staged, unstage
from examloom.llm.components import components

BLOCK_BYTES = 1 << 20
COUNTERS = 1 << 20        # of the table of counts: 4 MB, whatever the corpus
CANDIDATE_BITS = 1 << 24  # of the map of documents to verify: 2 MB; more documents only fill it
ORDER_SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)  # of the orders after the first
HOT = 1_000               # sets of one token compared by one task with all of that token
MAP_WORDS = 4             # longs of a parity map, looked at where tokens meet
MORE_WORDS = 8            # longs of a second one, for tokens of several components
CENTRE_ROUNDS = 4         # at most so many more centres of a token; what they leave is compared pair by pair
FEW_PAIRS = 64            # pairs not worth a merge of components, as are up to the square root of the sets: they wait
WIDE_FROM = 256           # shingles from which a set has a second one, looked at for each pair
WIDE_SHARE = 32           # shingles per long of it, rounded to powers of two


class Threshold:
    """Linked when 100 * intersection >= percent * union, on `k`-word shingles."""

    def __init__(self, percent: int = 80, k: int = 5):
        self.percent, self.k = percent, k

    def prefix(self, n):
        """Tokens of the prefix of a set of n."""
        return n - (self.percent * n + 99) // 100 + 1

    def like_size(self, n: Column, m: Column) -> Column:
        return (100 * F.least(n, m)) >= (self.percent * F.greatest(n, m))

    def size_step(self) -> float:
        """Logarithm of slightly more than the largest ratio of sizes."""
        return log(100 / self.percent) * 1.0001 if self.percent < 100 else 1e-9

    def few_differences(self, differences: Column, n: Column, m: Column) -> Column:
        """True of any number that is at most the sets' symmetric difference, if they link."""
        return (100 + self.percent) * differences <= (100 - self.percent) * (n + m)

    def linked(self, overlap: Column, n: Column, m: Column) -> Column:
        return 100 * overlap >= self.percent * (n + m - overlap)


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["`text`"].cast("string"), F.lit("")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("`doc_id`").cast("long").alias("doc_id"),
                       F.coalesce(F.col("`text`").cast("string"), F.lit("")).alias("text"),
                       _text_key(docs).alias("text_key"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _spans(rows: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(rows, np.arange(n + 1))


def _set_ids(rows: np.ndarray, hashes: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """64-bit ids of the sets; 0 for empty ones."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes, out=sums[1:])
    more = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(shingles.mix(hashes ^ np.uint64(ORDER_SEEDS[0])), out=more[1:])
    a, b = spans[:-1], spans[1:]
    ids = shingles.mix(shingles.mix(sums[b] - sums[a]) * np.uint64(3) + (more[b] - more[a]) + (b - a).astype(np.uint64))
    return np.where(a == b, np.uint64(0), ids | np.uint64(1))


def _prefixes(rows, hashes, spans, rank, order, threshold: Threshold):
    """(spans, tokens) of the prefixes: the tokens of least (rank, order) in each set."""
    by = np.lexsort((order, rank, rows))
    sizes = np.diff(spans)
    wanted = np.where(sizes > 0, threshold.prefix(sizes), 0)
    place = np.arange(len(rows)) - spans[rows]
    picked = by[place < wanted[rows]]
    return np.concatenate([[0], np.cumsum(wanted)]), hashes[picked]


def _lists(spans: np.ndarray, tokens: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(spans.astype(np.int32)), _signed(tokens))


def _parity(rows: np.ndarray, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """`words` longs (a power of two, or none) for each row, one after the other: for each bit,
    whether an odd number of the row's tokens falls on it."""
    has = words[rows] > 0
    rows, hashes = rows[has], hashes[has]
    bits = words.astype(np.int64) * 64
    begin = np.cumsum(bits) - bits
    at = begin[rows] + (hashes & (bits[rows] - 1).astype(np.uint64)).astype(np.int64)
    flips = np.bincount(at, minlength=int(bits.sum())) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def document_sets(docs: DataFrame, table, threshold: Threshold) -> DataFrame:
    """doc_id, text_key, set_id, n, prefix under the first order, parity map m0..m3 of every document."""
    k = threshold.k
    maps = [f"m{i}" for i in range(MAP_WORDS)] + [f"w{i}" for i in range(MORE_WORDS)]
    schema = ("doc_id long, text_key long, set_id long, n long, prefix array<long>, wide array<long>, "
              + ", ".join(f"{m} long" for m in maps))
    names = ["doc_id", "text_key", "set_id", "n", "prefix", "wide", *maps]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for batch in batches:
            for start, stop in blocks(batch.column(1), BLOCK_BYTES):
                part = batch.slice(start, stop - start)
                rows, hashes = shingles.shingle_sets(part.column(1), k)
                spans = _spans(rows, len(part))
                cut, tokens = _prefixes(rows, hashes, spans, sketches.counted(counts, hashes), hashes, threshold)
                sizes = np.diff(spans)
                packed = np.concatenate([
                    _parity(rows, hashes, np.full(len(part), MAP_WORDS)).reshape(len(part), MAP_WORDS),
                    _parity(rows, hashes >> np.uint64(20), np.full(len(part), MORE_WORDS)).reshape(len(part), MORE_WORDS)], axis=1)
                wide_words = np.where(sizes < WIDE_FROM, 0, 1 << np.ceil(np.log2(
                    np.maximum(sizes, 1) / WIDE_SHARE).clip(0)).astype(np.int64))
                wide = _parity(rows, hashes >> np.uint64(8), wide_words)
                wide_ends = np.concatenate([[0], np.cumsum(wide_words)])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), _signed(_set_ids(rows, hashes, spans)), pa.array(np.diff(spans)),
                    _lists(cut, tokens), _lists(wide_ends, wide), *[pa.array(np.ascontiguousarray(column)) for column in packed.T]], names)

    return _texts(docs).mapInArrow(work, schema)


def whole_sets(docs: DataFrame, table, wanted, threshold: Threshold) -> DataFrame:
    """doc_id, set_id, n, tokens, prefixes p2 and p3 under the other orders, of the documents whose
    id is in the map `wanted` (and a few others)."""
    k = threshold.k
    schema = "doc_id long, set_id long, n long, tokens array<long>, p2 array<long>, p3 array<long>"
    names = ["doc_id", "set_id", "n", "tokens", "p2", "p3"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, bits = table.value, wanted.value
        for batch in batches:
            batch = batch.filter(pa.array(sketches.marked(bits, _id_hash(batch.column(0)))))
            for start, stop in blocks(batch.column(1), BLOCK_BYTES):
                part = batch.slice(start, stop - start)
                rows, hashes = shingles.shingle_sets(part.column(1), k)
                spans = _spans(rows, len(part))
                rank = np.log2(sketches.counted(counts, hashes) + 1.0).astype(np.int64)
                more = [_lists(*_prefixes(rows, hashes, spans, rank, shingles.mix(hashes ^ np.uint64(s)), threshold))
                        for s in ORDER_SEEDS]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), _signed(_set_ids(rows, hashes, spans)), pa.array(np.diff(spans)),
                    _lists(spans, hashes), *more], names)

    return _texts(docs).mapInArrow(work, schema)


def _id_hash(ids: pa.Array) -> np.ndarray:
    return shingles.mix(ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                        + np.uint64(0x9E3779B97F4A7C15))


def _differences(name: str, words: int) -> Column:
    """Bits in which the parity maps a.<name>0, ... and b.<name>0, ... differ."""
    out = F.lit(0)
    for i in range(words):
        out = out + F.bit_count(F.col(f"a.{name}{i}").bitwiseXOR(F.col(f"b.{name}{i}")))
    return out


def _may_follow(threshold: Threshold) -> Column:
    """Whether a and b, of like size, can be linked if this is the first token they share: no more than
    the tokens from here on can be common."""
    n, m = F.col("a.n"), F.col("b.n")
    rest = F.least(n - F.col("a.place"), m - F.col("b.place"))
    return threshold.like_size(n, m) & threshold.linked(rest, n, m)


def _may_link(threshold: Threshold) -> Column:
    return _may_follow(threshold) & threshold.few_differences(_differences("m", MAP_WORDS), F.col("a.n"), F.col("b.n"))


def _near(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (u, v) whose wide parity maps, which grow with the sets, differ in few enough bits,
    with all their columns; small sets have none.

    Sets of like size have maps of one size or twice that; halves of the larger are folded."""
    wide = sets.select("set_id", "n", "wide")
    both = pairs.join(wide.toDF("u", "u_n", "u_wide"), "u").join(wide.toDF("v", "v_n", "v_wide"), "v")
    xor = lambda a, b: a.bitwiseXOR(b)

    def folded(own, other):
        size = F.size(other)
        return F.when(F.size(own) > size, F.zip_with(
            F.slice(own, F.lit(1), size), F.slice(own, size + 1, size), xor)).otherwise(F.col(own))

    differ = F.aggregate(F.zip_with(folded("u_wide", "v_wide"), folded("v_wide", "u_wide"),
                                    lambda a, b: F.bit_count(xor(a, b))), F.lit(0), lambda s, x: s + x)
    small, large = F.least(F.size("u_wide"), F.size("v_wide")), F.greatest(F.size("u_wide"), F.size("v_wide"))
    comparable = (small > 0) & (large <= 2 * small)
    return both.filter(~comparable | threshold.few_differences(differ, F.col("u_n"), F.col("v_n"))).select(*pairs.columns)


def _salted(left: DataFrame, right: DataFrame, key: str, rows: DataFrame, share: int, own: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column `_salt` to join on as well, so that at most about `share` left rows
    have one key and salt.  `rows` (key, _n): left rows of the keys with more than that.  Salts come from
    a hash of the left rows' `own` column, so a task that runs again deals them alike."""
    salts = F.ceil(F.col("_n") / share).cast("long")
    hot = rows.filter(F.col("_n") > share).select(key, salts.alias("_salts"))
    one = F.lit(1).cast("long")
    left = left.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(own), F.coalesce("_salts", one))).drop("_salts")
    right = right.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce("_salts", one) - 1))).drop("_salts")
    return left, right


def _verified(pairs: DataFrame, whole: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (u, v) of sets that share prefix tokens under the other orders and are linked.

    `v` may be the same in very many pairs; those are spread over copies of its set.
    """
    counts = pairs.groupBy("v").agg(F.count("*").alias("_n"))
    number, most = counts.agg(F.sum("_n"), F.max("_n")).first()  # two numbers
    share = max(HOT, (number or 0) // partitions(pairs.sparkSession))

    def side(prefix):
        return whole.select(F.col("set_id").alias(prefix), *[
            F.col(c).alias(f"{prefix}_{c}") for c in ("n", "tokens", "p2", "p3")])

    left, right, on = pairs.join(side("u"), "u"), side("v"), ["v"]
    if (most or 0) > share:
        left, right = _salted(left, right, "v", staged(counts.filter(F.col("_n") > share), "pair-counts"), share, "u")
        on.append("_salt")
    overlap = F.size(F.array_intersect("u_tokens", "v_tokens"))
    return left.join(right, on).filter(
        F.arrays_overlap("u_p2", "v_p2") & F.arrays_overlap("u_p3", "v_p3")
        & threshold.linked(overlap, F.col("u_n"), F.col("v_n"))).select("u", "v")


def _rank() -> Column:
    """By this the first document of a component is the one to stay: smallest id, then text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) after more links between their members.

    Only the components' names and what had none take part, one link for each two of them.
    """
    ends = links.join(labels.toDF("u", "u_of"), "u", "left").join(labels.toDF("v", "v_of"), "v", "left").select(
        F.coalesce("u_of", "u").alias("u"), F.coalesce("v_of", "v").alias("v")).distinct()
    more = staged(components(ends), "merged-components")
    moved = labels.join(more.toDF("component", "larger"), "component", "left").select(
        "node", F.coalesce("larger", "component").alias("component"))
    # Names of components have a row of their own in `labels`; other nodes of `more` are new.
    return staged(moved.unionByName(more.join(labels.select("node"), "node", "left_anti")), "components")


def _round_pairs(several: DataFrame, labels: DataFrame, number: int, threshold: Threshold) -> DataFrame:
    """Pairs (u, v) that may be linked: v is a set of a token by a hash that is another in each round
    `number`, in even rounds of the token's largest component; u is one of that token outside v's component."""
    sizes = labels.groupBy("component").agg(F.count("*").alias("_size"))
    named = staged(labels.join(sizes, "component").select(F.col("node").alias("set_id"), "component", "_size"), "round-labels")
    at = several.join(named, "set_id", "left").withColumn("component", F.coalesce("component", "set_id")).withColumn(
        "_size", F.coalesce("_size", F.lit(1).cast("long")))
    largest = ["_size", "component"] if number % 2 == 0 else []
    centre = F.max(F.struct(*largest, F.xxhash64("set_id", F.lit(number)).alias("_hash"), *[
        c for c in at.columns if c not in ["token", *largest]])).alias("c")
    centres = staged(at.groupBy("token").agg(
        centre, F.count("*").alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high"),
    ).filter("_low < _high").select("token", "c", "_n"), "round-centres")
    others = attach(at, centres, "token", "_n").filter("component <> c.component")
    return others.select(F.struct(*[c for c in several.columns if c != "token"]).alias("a"), F.col("c").alias("b")).filter(
        _may_link(threshold)).select(F.col("a.set_id").alias("u"), F.col("b.set_id").alias("v")).distinct()


def _are_few(pairs: DataFrame, few: int) -> bool:
    return pairs.limit(few + 1).count() <= few


def link(docs: DataFrame, threshold: Threshold) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, text_key, set_id, n) and sets (set_id, _n documents, component_id, first).

    component_id is the smallest doc_id that links reach, `first` the document that stands for
    the component.  Documents without words have
    set_id 0, n 0 and no links.
    """
    spark, k = docs.sparkSession, threshold.k
    texts = _texts(docs)

    def hashes(batch):
        for start, stop in blocks(batch.column(1), BLOCK_BYTES):
            yield shingles.shingle_sets(batch.column(1).slice(start, stop - start), k)[1]

    table = spark.sparkContext.broadcast(sketches.count_table(texts, hashes, COUNTERS))
    maps, more = [f"m{i}" for i in range(MAP_WORDS)], [f"w{i}" for i in range(MORE_WORDS)]
    # Prefixes and maps take most of the room: of all documents until there are sets, and prefixes of
    # sets until there are postings.
    documents = staged(document_sets(docs, table, threshold), "document-sets")
    found = staged(documents.select("doc_id", "text_key", "set_id", "n"), "set-documents")
    # All columns but doc_id depend on the set alone.
    grouped = staged(documents.filter("n > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("mult"), F.min(_rank()).alias("first"),
        *[F.first(c).alias(c) for c in ("n", "prefix", "wide", *maps, *more)]), "sets-with-prefixes")
    unstage(documents)
    sets = staged(grouped.drop("prefix"), "sets")

    # Postings of the tokens that several sets share.
    shared = staged(grouped.select(F.explode("prefix").alias("token")).groupBy("token").agg(
        F.count("*").alias("_n")).filter("_n > 1"), "shared-tokens")
    postings = attach(grouped.select("set_id", F.posexplode("prefix").alias("place", "token")), shared, "token", "_n")
    # A set has no more postings than its prefix.
    members = staged(postings.join(sets.select("set_id", "n", "mult", *maps), "set_id"), "members")
    unstage(grouped)

    # First the pairs of each token's centre, the set with most copies, with the others.
    centre = F.max(F.struct("mult", "set_id", "n", "place", *maps)).alias("c")
    centres = staged(members.groupBy("token").agg(centre, F.count("*").alias("_n")), "centres")
    first = attach(members, centres, "token", "_n").filter("set_id <> c.set_id")
    first = first.select(F.struct("set_id", "n", "place", *maps).alias("a"), F.col("c").alias("b")) \
        .filter(_may_link(threshold)).select(
            F.col("a.set_id").alias("u"), F.col("b.set_id").alias("v"), F.col("b.mult").alias("v_mult"))
    first = staged(first.distinct(), "centre-pairs")
    near = staged(_near(first, sets, threshold), "near-centres")

    def whole_of(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.explode(F.array("u", "v")).alias("set_id")).distinct()
        reps = staged(nodes.join(sets.select("set_id", "rep"), "set_id").select("rep", "set_id"), "to-verify")
        wanted = spark.sparkContext.broadcast(
            sketches.bit_map(reps, lambda batch: [_id_hash(batch.column(0))], CANDIDATE_BITS))
        whole = whole_sets(docs, table, wanted, threshold)
        whole = whole.join(reps.select("set_id"), "set_id", "left_semi")
        # Dealt by the set already; of a set's copies one is enough.
        return staged(whole.dropDuplicates(["set_id"]), "whole-sets")

    def verify(pairs: DataFrame, whole: DataFrame) -> DataFrame:
        return staged(_verified(pairs, whole, threshold), "links")

    # A set meets the largest of its centres first, then those of other components.
    whole = whole_of(near)
    best = near.groupBy("u").agg(F.max(F.struct("v_mult", "v"))["v"].alias("v"))
    best = staged(best.select("u", "v"), "best-centres")
    labels = staged(components(verify(best, whole)), "components")
    named = labels.withColumnRenamed("component", "_of")
    apart = near.join(named.toDF("u", "u_of"), "u", "left").join(named.toDF("v", "v_of"), "v", "left").filter(
        F.coalesce("u_of", "u") != F.coalesce("v_of", "v")).select("u", "v").join(best, ["u", "v"], "left_anti")
    apart = staged(apart, "other-centres")  # pairs of centres and of what they did not link
    few = max(FEW_PAIRS, isqrt(sets.count()))  # so many sets have no more pairs than half of all sets
    later = _are_few(apart, few)
    if not later:
        labels = _merged(labels, verify(apart, whole))

    # The pair of a token's only two sets has been seen.
    several = staged(attach(members.select("token", "set_id", "n", "place", *maps),
                            staged(centres.select("token", "_n").filter("_n > 2"), "several"), "token", "_n"), "several-sets")
    unstage(members)
    label = F.coalesce(F.col("component"), F.col("set_id"))

    # Other centres of each token, until two rounds in a row link nothing or meet few pairs.  Then
    # few sets are near the centre of another component; the last step meets them again.
    idle = 0
    for number in range(CENTRE_ROUNDS):
        met = staged(_near(_round_pairs(several, labels, number, threshold), sets, threshold), "round-pairs")
        found_links = None if _are_few(met, few) else verify(met, whole_of(met))
        if found_links is not None and found_links.limit(1).count():
            labels, idle = _merged(labels, found_links), 0
        elif idle:
            break
        else:
            idle = 1

    # Then pairs of one token across components.
    marked = staged(several.drop(*maps).join(
        labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", label), "labelled")
    # Sets of like size meet under a size class of theirs: their own or the next.
    size_class = F.floor(F.log(F.col("n")) / F.lit(threshold.size_step()))
    keyed = marked.select(F.explode(F.array(size_class, size_class + 1)).alias("class"), "*").select(
        F.xxhash64("token", "class").alias("key"), "set_id", "n", "place", "component")
    mixed = staged(keyed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("_n"))
        .filter("low < high").select("key", "_n"), "mixed-keys")
    left = attach(keyed, mixed.select("key", F.col("_n").alias("_rows")), "key", "_rows")
    left = staged(left.join(sets.select("set_id", *more), "set_id"), "mixed-postings")
    a, b = _salted(left, left, "key", mixed, HOT, "set_id")
    n, m = F.col("a.n"), F.col("b.n")
    second = a.alias("a").join(b.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a._salt") == F.col("b._salt"))
                               & (F.col("a.set_id") < F.col("b.set_id"))
                               & (F.col("a.component") != F.col("b.component")) & _may_follow(threshold)
                               & threshold.few_differences(_differences("w", MORE_WORDS), n, m))
    second = second.select(F.col("a.set_id").alias("u"), F.col("b.set_id").alias("v")).distinct()
    second = staged(second, "cross-pairs")  # each pair once, before those seen are taken out
    known = first.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    close = _near(second.join(known, ["u", "v"], "left_anti"), sets, threshold)
    close = staged(close.unionByName(apart) if later else close, "near-pairs")
    if close.limit(1).count():
        labels = _merged(labels, verify(close, whole_of(close)))

    named = sets.select("set_id", "mult", "rep", "first").join(
        labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", label)
    named = staged(named, "named-sets")
    least = staged(named.groupBy("component").agg(F.min("rep").alias("component_id"), F.min("first").alias("head"),
                                                 F.count("*").alias("_n")), "least")
    out = attach(named.drop("first"), least, "component", "_n").select(
        "set_id", F.col("mult").alias("_n"), "component_id", F.col("head").alias("first"))
    return found.select("doc_id", "text_key", "set_id", "n"), staged(out, "set-components")


def join(docs: DataFrame, threshold: Threshold) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents without words or text have no shingles and are linked with nothing; their
    component is their own id.  Null ids are passed on and never name a component that has
    another id; rows may repeat; an empty table gives no rows.
    """
    found, sets = link(docs, threshold)
    linked = attach(found.filter("n > 0"), sets, "set_id", "_n").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(found.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, threshold: Threshold = Threshold()) -> DataFrame:
    """The documents with one of each group of linked ones, with all their columns.

    The smallest id of a group stays (null ids last, then by a hash of the text); rows equal in
    id and text are one document and stay or go together.  Documents without words stay.
    """
    found, sets = link(docs, threshold)
    gone = attach(found.filter("n > 0"), sets, "set_id", "_n").filter(~_rank().eqNullSafe(F.col("first"))).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    gone = staged(gone.distinct(), "near-copies")
    same = docs["doc_id"].cast("long").eqNullSafe(gone["__id"]) & (_text_key(docs) == gone["__key"])
    return docs.join(gone, same, "left_anti")
