"""Quality rules per document, and host verdicts from shrunken failure rates.

A document fails by its own text, or because its host's failure rate, shrunk towards
the corpus by a beta prior fitted to all hosts, is above a threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm.common import WHITE, attach, staged

WORD = f"[^{WHITE}]+"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PCT = 30
HOST_MAX_RATE = 0.9      # a host above this shrunken failure rate is rejected whole
MIN_STRENGTH = 10.0      # rows the prior counts for, at least
MAX_STRENGTH = 1e6       # and at most (all hosts alike)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the array."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(h: Column) -> Column:
        # (hash, start) in order: a window repeats when a neighbour has its hash.
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            last = F.size(p) - 1
            same = lambda a, b: F.get(p, a)["h"] == F.get(p, b)["h"]
            found = F.filter(p, lambda x, k: ((k > 0) & same(k, F.greatest(k - 1, F.lit(0))))
                             | ((k < last) & same(k, F.least(k + 1, last))))
            return F.array_sort(F.transform(found, lambda x: x["i"]))

        def cover(s: Column) -> Column:
            return F.aggregate(
                F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda acc, x: acc + x)

        return _let(pairs, lambda p: _let(starts(p), cover))

    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(_let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
        .otherwise(covered(h))))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)
    and base_failed.  Null texts have no words and fail.  Columns of these names are replaced."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    with_words = docs.withColumn("n_words", F.explode(F.array(words)))
    return with_words.withColumns({
        "n_repeat_words": _repeat_words(F.col("n_words")),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "word_chars": F.length(F.translate(body, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
    }).withColumn("n_words", F.size("n_words").cast("long")).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")))


def host_verdicts(stats: DataFrame, host: str = "host", failed: str = "base_failed",
                  max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """host, n_rows, n_failed, host_rejected.

    The prior Beta(m*k, (1-m)*k) has the corpus' failure rate m, and its strength k from the
    spread of the hosts' rates (method of moments); a host's rate is (failed + m*k) / (rows + k).
    One host or equal rates give the strongest prior.  The counts of hosts are combined on the
    map side; the prior is one row.
    """
    hosts = stats.groupBy(host).agg(
        F.count("*").alias("n_rows"), F.sum(F.col(failed).cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_rows")
    prior = hosts.agg(
        (F.sum("n_failed") / F.sum("n_rows")).alias("_mean"),
        F.round(F.var_pop(F.round(rate, 9)), 9).alias("_spread"))
    strength = F.when(F.col("_spread") > 0, F.least(F.lit(MAX_STRENGTH), F.greatest(
        F.lit(MIN_STRENGTH), F.col("_mean") * (1 - F.col("_mean")) / F.col("_spread") - 1))
    ).otherwise(F.lit(MAX_STRENGTH))
    shrunk = (F.col("n_failed") + F.col("_mean") * strength) / (F.col("n_rows") + strength)
    return hosts.join(F.broadcast(prior)).select(  # the prior is a single row
        host, "n_rows", "n_failed", (F.round(shrunk, 6) > max_rate).alias("host_rejected"))


def judge(docs: DataFrame, host: str = "source", id_col: str = "doc_id", text: str = "text",
          max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """One row per document: id, the counts of `text_rules`, base_failed, host_rejected, kept.

    Null hosts form one host of their own.  Ids are passed on, not looked at, so null and
    repeated ids are fine; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), _host(docs, host))
    stats = staged(text_rules(rows).drop("text"), "quality")
    hosts = staged(host_verdicts(stats, max_rate=max_rate).drop("n_failed")
                   .withColumnRenamed("n_rows", "_n"), "hosts")
    return attach(stats, hosts, "host", "_n").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"),
        "host_rejected")


def _host(docs: DataFrame, host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`").cast("string")), F.lit("")).alias("host")


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The kept documents with the columns they came with."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    stats = text_rules(docs.select(F.col("`text`").alias("text"), _host(docs, host)))
    rejected = staged(host_verdicts(stats.select("host", "base_failed")).filter("host_rejected")
                      .select(F.col("host").alias("__host")), "rejected-hosts")
    whole = docs.select(F.struct(*names).alias("__row"), F.col("`text`").alias("text"),
                        _host(docs, host).alias("__host"))
    good = text_rules(whole).filter(~F.col("base_failed"))
    return good.join(rejected, "__host", "left_anti").select("__row.*")


SQL = """
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words
        FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
st AS (SELECT t.doc_id, source, len(w)::BIGINT AS n_words,
    length(translate(text, E' \\t\\n\\x0b\\x0c\\r', ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(text, chr(10)),
               lambda x: translate(x, E' \\t\\n\\x0b\\x0c\\r', '') <> '') AS l FROM t) t
  LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM st),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS x FROM f GROUP BY source),
p AS (SELECT sum(x) / sum(n) AS m, round(var_pop(round(x / n, 9)), 9) AS v FROM h),
k AS (SELECT m, CASE WHEN v > 0 THEN least(1e6, greatest(10.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM p),
r AS (SELECT source, round((x + m * s) / (n + s), 6) > 0.9 AS host_rejected FROM h, k)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_rejected AS kept, host_rejected
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source"""
