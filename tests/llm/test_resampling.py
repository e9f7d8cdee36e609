"""Importance resampling and the radix sort against plain definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from examloom.llm import radix, resampling
from tests.llm.brute import lower

TARGET = "item_id long, text string"


def brute(docs, target, longest=1, percent=10, least=20):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        runs = [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]

    found = [(i, *features(t)) for i, t in docs]
    s = Counter(b for _, _, f in found for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    rows = []
    for i, n_words, f in found:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append((n_words, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2**32)))))
    may = sorted((r for r in rows if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = may[:len(may) * percent // 100]
    out = Counter((*r[1:], None) for r in rows)
    for place, r in enumerate(drawn, 1):
        out[(*r[1:], None)] -= 1
        out[(*r[1:], place)] += 1
    return +out


def rows_of(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def target_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], TARGET)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_odd_rows(spark, odd_docs, one_document):
    wanted = ["the quick brown wizards", None, "", "word3 and17 ÄÖ"]
    for docs in (odd_docs, one_document):
        for rule in (resampling.Rule(percent=50), resampling.Rule(longest=3, percent=70)):
            out = resampling.resample(docs, target_of(spark, wanted), rule)
            assert rows_of(out) == brute(pairs(docs), wanted, rule.longest, rule.percent)


def test_empty(spark, no_docs, odd_docs):
    out = resampling.resample(no_docs, target_of(spark, ["a"]))
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and out.count() == 0
    assert rows_of(resampling.resample(odd_docs, target_of(spark, []))) == brute(pairs(odd_docs), [])


def test_long_text_in_pieces(monkeypatch):
    text = ("Alpha beta-gamma ÄÖ 12 " * 50 + "x" * 300 + " delta").encode()
    whole = [list(f) for _, f in resampling._features(text, resampling._Buckets(97), 3)]
    monkeypatch.setattr(resampling, "PIECE_BYTES", 64)
    monkeypatch.setattr(resampling, "CACHE_BYTES", 300)
    parts = [f for _, f in resampling._features(text, resampling._Buckets(97), 3)]
    assert len(parts) > 10 and Counter(sum(whole, [])) == Counter(int(b) for p in parts for b in p)


def test_radix_rank(spark, conf, monkeypatch):
    """Negative, extreme, repeated and missing keys, with blocks smaller than the table."""
    rng = random.Random(5)
    extreme = [-(1 << 63), (1 << 63) - 1, 0, -1, 1]
    rows = [(rng.randrange(-40, 40), rng.choice(extreme + [None, rng.randrange(1 << 40)])) for _ in range(3_000)]
    monkeypatch.setattr(radix, "BLOCK_BITS", 6)
    df = spark.createDataFrame(rows, "score long, doc_id long").repartition(5)
    out = radix.radix_rank(df, [("score", True), ("doc_id", False)], "place").orderBy("place").collect()
    assert [r.place for r in out] == list(range(len(rows)))
    expected = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert [(r.score, r.doc_id) for r in out] == expected


def test_radix_rank_one_value(spark):
    same = spark.range(100).select(F.lit(3).cast("long").alias("k")).repartition(3)
    assert sorted(r.p for r in radix.radix_rank(same, [("k", False)], "p").collect()) == list(range(100))
    assert radix.radix_rank(same.filter("k > 3"), [("k", False)], "p").count() == 0
