"""The registered queries over whole tables, against DuckDB or a plain definition."""

import base64
import hashlib
import html
import re

import pytest

from checks.compare import connect, difference
from examloom.llm import queries  # noqa: F401  (registers on import)
from examloom.llm.registry import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.conftest import texts


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def rows(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_near_copies(spark, sf_dir, documents):
    out = rows(QUERIES["op2_ngram_jaccard"](spark, sf_dir), "n_shingles", "component_id")
    assert out == brute.near_components(documents, 85, 4)


def test_long_repeats(spark, sf_dir, documents):
    out = rows(QUERIES["op6_long_repeats"](spark, sf_dir), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert out == brute.cut_repeats(documents)


def test_tokens(spark, sf_dir, documents):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for doc_id, text in documents.items():
        ids = encoding.encode_ordinary(text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[doc_id] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    out = rows(QUERIES["op5_byte_bpe"](spark, sf_dir), "n_tokens", "ids_sha256", "decoded_sha256")
    assert out == expected


def test_pages(spark, sf_dir):
    """The articles of these pages stand in one element."""
    given = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op3_html_extraction"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", given[r["page_id"]], re.S)[1]
        article = re.sub("</?b>", "", re.sub("</?(?:p|h1)>|<br>", " ", article))
        text = " ".join(html.unescape(article).split())
        assert (r["text"], r["n_chars"]) == (text, len(text))


def test_shards(spark, sf_dir, documents):
    out = QUERIES["op4_sharding"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(documents)
    by_shard, by_text = {}, {}
    for r in out:
        text = (documents[r["doc_id"]] or "").encode()
        assert r["size"] == len(text) + 8
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        by_text.setdefault(text, []).append(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(by_shard.get(s, ())) for s in range(24)]
    assert sum(sizes) == len(out) and max(sizes) - min(sizes) <= 1
    # Groups smaller than a shard stay together.
    assert all(len(set(s)) == 1 for s in by_text.values())
