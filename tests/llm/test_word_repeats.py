"""Repeated windows of words against a plain definition, and the automaton against substrings."""

import hashlib
import random
import re
from collections import Counter

import pytest

from examloom.llm import queries, word_repeats  # noqa: F401  (queries registers on import)
from examloom.llm.automaton import NOBODY, SuffixAutomaton
from examloom.llm.registry import QUERIES
from tests.llm.conftest import texts


def brute(docs, window=13):
    """(doc_id, n_words, n_removed, kept) of (doc_id, text) rows."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, words in split:
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            first[key] = min(first.get(key, NOBODY), NOBODY if i is None else i)
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < (NOBODY if i is None else i):
                gone.update(range(at, at + window))
        out.append((i, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return out


def check(spark, rows):
    docs = rows if hasattr(rows, "select") else spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = Counter(tuple(r) for r in word_repeats.remove(docs).select("doc_id", "n_words", "n_removed", "kept").collect())
    assert out == Counter(brute(pairs))


def made_up(n, rng, alphabet=40):
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(50)
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[a:a + rng.randrange(5, 40)]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
        if rng.random() < .3:
            rows.append((rng.randrange(1_000, 2_000), rows[rng.randrange(len(rows))][1]))
    return rows


def test_whole_table(spark, sf_dir):
    docs = texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op13_substring_dedup"](spark, sf_dir).collect()}
    assert out == {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(docs.items())}


def test_odd_rows(spark, odd_docs, one_document):
    check(spark, odd_docs)
    check(spark, one_document)


def test_empty_table(spark, no_docs):
    assert word_repeats.remove(no_docs).collect() == []


def test_passages(spark):
    check(spark, made_up(150, random.Random(1)))
    check(spark, made_up(80, random.Random(2), alphabet=2))  # few different words, very many equal runs


def test_one_anchor_in_many_documents(spark, monkeypatch):
    """More segments of an anchor than a shard takes, and pieces that cut documents."""
    monkeypatch.setattr(word_repeats, "SLICE", 3)
    monkeypatch.setattr(word_repeats, "SHARD_WORDS", 50)
    monkeypatch.setattr(word_repeats, "PIECE_BYTES", 100)
    monkeypatch.setattr(word_repeats, "BATCH_BYTES", 64)
    rng = random.Random(3)
    common = "five words in every text and then some more of them".split()
    rows = []
    for i in range(120):
        own = [f"o{rng.randrange(3)}" for _ in range(20)]
        rows.append((i, " ".join(own[:10] + common + own[10:])))
    check(spark, rows)


@pytest.mark.parametrize("seed", range(5))
def test_automaton(seed):
    rng = random.Random(seed)
    sequences = [("".join(rng.choice("ab" if seed % 2 else "abcd") for _ in range(rng.randrange(1, 30))), rng.randrange(9))
                 for _ in range(12)]
    automaton = SuffixAutomaton()
    for s, owner in sequences:
        automaton.add(s, owner)
    automaton.settle()
    for window in (1, 3, 6):
        for s in [s for s, _ in sequences] + ["abcabcabxab", "x"]:
            expected = [min([o for t, o in sequences if s[i:i + window] in t], default=NOBODY)
                        for i in range(len(s) - window + 1)]
            assert automaton.least_owners(s, window) == expected
