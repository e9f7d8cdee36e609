"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from examloom.llm import bpe, chat, exact_dedup, extraction, jaccard, licenses, long_repeats, mixing, quality, sharding
from tests.llm import brute
from tests.llm.conftest import LONG, texts


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


OPERATORS = {
    "mixing": mixing.select, "mixed": mixing.mixed,
    "jaccard": lambda d: jaccard.join(d, jaccard.Threshold(85, 4)), "keep_one": jaccard.keep_one,
    "sharding": sharding.shard, "bpe": lambda d: bpe.digests(d, *vocabulary()),
    "repeats": long_repeats.remove, "licenses": licenses.scan, "quality": quality.judge,
    "keep_good": quality.keep_good,
    "exact": lambda d: exact_dedup.deduplicate(d, exact_dedup.new_index(d.sparkSession)),
    "keep_first": lambda d: exact_dedup.keep_first(d, exact_dedup.new_index(d.sparkSession)),
}
FILTERS = {"mixing", "mixed", "keep_one", "keep_good", "keep_first"}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(no_docs, name):
    assert OPERATORS[name](no_docs).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_and_null_ids(one_document, name):
    out = OPERATORS[name](one_document).collect()
    if name not in FILTERS:
        assert len(out) == one_document.count()


@pytest.mark.parametrize("name", ["mixed", "keep_one", "keep_good", "keep_first"])
def test_filters_return_the_columns_they_got(odd_docs, name):
    out = OPERATORS[name](odd_docs)
    assert out.columns == odd_docs.columns
    assert all(r["kept"] == "clash" for r in out.collect())


def test_quality(odd_docs):
    given = texts(odd_docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in quality.judge(odd_docs).collect():
        counts = brute.quality_counts(given[r["doc_id"]])
        assert tuple(r[n] for n in names) == counts
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])


def test_a_host_of_failures_is_rejected(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "short", "bad") for i in range(60)] + [(100, good, "bad")]
    rows += [(200 + i, good + f" {i}", f"host{i % 3}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert out[100]["host_rejected"] and not out[100]["kept"] and not out[100]["base_failed"]
    assert all(out[200 + i]["kept"] for i in range(60))
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == set(range(200, 260))


def test_exact_copies(odd_docs):
    out = {r["doc_id"]: r for r in OPERATORS["exact"](odd_docs).collect()}
    assert {i: out[i]["keep_id"] for i in (1, 2, 3, 4, 5, 6, 13, 14)} == {
        1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 13: 13, 14: 14}
    assert out[4]["group_size"] == 3 and out[1]["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_index_remembers_earlier_batches(spark, odd_docs):
    index = exact_dedup.new_index(spark)
    first = odd_docs.filter("doc_id >= 5")
    exact_dedup.deduplicate(first, index).collect()
    again = exact_dedup.DigestIndex(spark, index.path, index.buckets)
    out = {r["doc_id"]: r for r in exact_dedup.deduplicate(odd_docs.filter("doc_id < 6"), again).collect()}
    assert (out[4]["keep_id"], out[4]["kept"]) == (5, False)
    assert (out[5]["keep_id"], out[5]["kept"]) == (5, False)
    assert out[1]["kept"] and not out[2]["kept"]
    assert again.rows().count() == first.unionByName(odd_docs.filter("doc_id < 6")).select(
        exact_dedup.text_digest(F.col("text"))).distinct().count()


def test_keep_first_drops_equal_rows(one_document):
    kept = OPERATORS["keep_first"](one_document).collect()
    assert len({r["doc_id"] for r in kept}) == len(kept)


def test_near_copies(odd_docs):
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in OPERATORS["jaccard"](odd_docs).collect()}
    assert out == brute.near_components(texts(odd_docs), 85, 4)
    assert out[1] == (0, 1) and out[13] == out[14] == (1, 13)


def test_near_copies_of_one_text(spark):
    """A large group whose members are linked through its centre, through others, or not at all."""
    base = [f"w{i}" for i in range(80)]
    docs = {}
    for i in range(300):
        words = list(base)
        for j in range(i % 7):
            words[(i * 13 + j * 11) % 80] = f"x{i}y{j}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in OPERATORS["jaccard"](df).collect()}
    assert out == brute.near_components(docs, 85, 4)
    assert 1 < len({c for _, c in out.values()}) < 300


def test_near_copies_of_large_texts(spark):
    """Parity maps of one size and of two; links just above and just below the threshold."""
    docs = {}
    for g, size in enumerate((260, 500, 1020, 1100, 2040)):
        base = [f"g{g}w{i}" for i in range(size)]
        for j, changed in enumerate((0, size // 100, size // 55, size // 50, size // 45, size // 20)):
            words = list(base) + [f"e{g}x{j}n{i}" for i in range(4 * j)]
            for i in range(changed):
                words[i * size // changed] = f"c{g}x{j}n{i}"
            docs[10 * g + j] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in OPERATORS["jaccard"](df).collect()}
    assert out == brute.near_components(docs, 85, 4)
    assert 10 < len({c for _, c in out.values()}) < 30


def test_long_repeats(odd_docs):
    out = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
           for r in long_repeats.remove(odd_docs).collect()}
    assert out == brute.cut_repeats(texts(odd_docs))


def test_repeats_of_a_hot_passage(spark, monkeypatch):
    """More different segments around one passage than a block takes."""
    monkeypatch.setattr(long_repeats, "SLICE", 7)
    monkeypatch.setattr(long_repeats, "INDEX_BYTES", 2_000)
    passage = " ".join(f"common{i}" for i in range(40))
    docs = {i: f"{i * 7919 % 1000} own start {i % 5} {passage} and end {i % 3} of {i * 31}" for i in range(120)}
    docs[200], docs[201], docs[202] = "a" * 1000, "ab" * 300, "a" * 99
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    out = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
           for r in long_repeats.remove(df).collect()}
    assert out == brute.cut_repeats(docs)


def test_tokens(odd_docs):
    import numpy as np

    codec = bpe.Codec(*vocabulary())
    odd = ["", "a" * 3000, " " * 500 + "x", "ß" * 400, "日本語" * 100, "\U0001F600" * 90, "=-" * 300 + "\n\n \t x", "x\x00y", LONG]
    encoded = codec.encode(odd)
    assert codec.decode(encoded) == [t.encode() for t in odd]
    import tiktoken
    plain = tiktoken.Encoding("own", pat_str=vocabulary()[1], mergeable_ranks=codec.ranks, special_tokens={})
    for text, ids in zip(odd, encoded):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text)
    codec.cache = {}
    bpe.CACHE_PIECES, limit = 50, bpe.CACHE_PIECES  # the cache starts anew again and again
    try:
        assert [codec.encode([t])[0] for t in odd] == encoded
    finally:
        bpe.CACHE_PIECES = limit
    out = {r["doc_id"]: r for r in bpe.encode_documents(odd_docs, *vocabulary()).collect()}
    assert out[1]["n_tokens"] == 0 and bytes(out[1]["ids"]) == b""
    assert all(bytes(out[i]["decoded"]).decode() == (t or "") for i, t in texts(odd_docs).items())


def test_shards_of_a_group_larger_than_a_shard(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'copy' ELSE concat('t', id) END AS text")
    out = sharding.shard(docs, shards=8).collect()
    sizes = Counter(r["shard"] for r in out)
    assert sorted(sizes.values()) == [125] * 8
    copies = Counter(r["shard"] for r in out if r["doc_id"] % 3 == 0)
    assert sorted(copies.values())[-2:] == [125, 125]  # it fills whole shards
    assert all(r["grown_shard"] is None and r["law"] == "rows" for r in out)


@pytest.mark.parametrize("size, singles", [(2, 0), (10, 48)])
def test_shards_without_singles_to_exchange(spark, size, singles):
    """Linked documents change places with each other; what stays split does not grow with the rows."""
    docs = spark.range(2400).selectExpr("id AS doc_id", f"CASE WHEN id < {singles} THEN concat('t', id) "
                                        f"ELSE concat('g', (id - {singles}) DIV {size}) END AS text")
    out = sharding.shard(docs).collect()
    assert sorted(Counter(r["shard"] for r in out).values()) == [100] * 24
    groups = {}
    for r in out:
        if r["doc_id"] >= singles:
            groups.setdefault((r["doc_id"] - singles) // size, set()).add(r["shard"])
    assert sum(len(s) > 1 for s in groups.values()) <= 24


def test_mixing_shares_and_shortages(spark):
    text = "w " * 10
    rows = [(i, text, "en", "a") for i in range(10)] + [(100 + i, text, "en", "b") for i in range(100)]
    rows += [(300 + i, text, "de", "c") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.select(docs, weights={"lang": {"en": 1, "de": 1}}, budget_pct=50, max_epochs=2,
                        domain=lambda s: F.lit("all")).collect()
    taken = Counter()
    for r in out:
        taken[r["source"]] += r["taken_tokens"]
    # Half of 3100 tokens; en and de share evenly; a gives two epochs (200), its sibling the rest.
    assert taken["c"] == 775 and taken["a"] == 200 and taken["b"] == 575
    assert {r["epoch"] for r in out if r["source"] == "a"} == {0, 1}


def test_mixing_with_nulls(odd_docs):
    out = mixing.select(odd_docs).collect()
    sizes = {i: len((t or "").split()) for i, t in texts(odd_docs).items()}
    assert sum(r["taken_tokens"] for r in out) <= sum(sizes.values())
    assert all(r["n_tokens"] == sizes[r["doc_id"]] for r in out if r["doc_id"] != 12)


def test_licenses(spark):
    rows = [(1, "Use it under the\nMIT   License. under the mit license"), (2, "APACHE license, version 2; cc-by-nc"),
            (3, "This work is licensed under GNU General Public License version 3"), (4, "under the mit licenses"), (5, None)]
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[1]["n_base"], out[1]["first_word"], out[1]["last_word"], out[1]["base_labels"]) == (2, 2, 6, "mit")
    assert (out[2]["n_base"], out[2]["base_labels"], out[2]["first_word"]) == (2, "apache-2,cc-by-nc", 0)
    assert out[3]["n_base"] == 0 and out[3]["labels"] == "gpl-3" and 0.8 <= out[3]["score"] < 1
    assert out[4]["n_base"] == 0 and out[4]["first_word"] is None
    assert (out[5]["n_words"], out[5]["labels"], out[5]["score"]) == (0, "", 0.0)


def used_features(tree):
    return set() if isinstance(tree, bool) else {tree[0]} | used_features(tree[2]) | used_features(tree[3])


def test_long_page(spark):
    tree = extraction.train_tree(spark)
    page = "<article>" + "<p>A sentence of some words.</p>" * 50_000 + "</article>"
    assert extraction.main_text(page, tree) == " ".join(["A sentence of some words."] * 50_000)


def test_pages(spark):
    tree = extraction.train_tree(spark)
    for page in extraction.PAGES:
        assert all(extraction.is_main(tree, features) == main for _, features, main in extraction.flat_blocks(page))
    text = lambda page: extraction.main_text(page, tree)
    assert text(None) == "" and text("") == "" and text("<p") == ""
    assert text("<article><p>a &lt; b &amp;amp; c<br>d<b>e</b>f<p>x < y</article><footer>no</footer>") == "a < b &amp; c d" + "ef x < y"
    assert text('<article><script>if (a<b) "</p>"</script><p title="a>b">yes</p><!-- <p>no</p> --></article>') == "yes"
    assert text('<article><p>yes</p></article><div class="comments"><p>no</p></div><div id=sidebar>no</div>') == "yes"
    for name in ("social-science", "content-with-sidebar", "legal-analysis", "post ad-free", "search-result", "form-guide"):
        article = f'<h1>On towns</h1><p>{"A long sentence of a town in spring. " * 6}</p><p>Few.</p>'
        assert text(f'<div class="{name}">{article}</div>').startswith("On towns A long")  # its end could be a footer
        whole = text(f'<article class="x"><div class="{name}">{article}</div></article>')
        assert whole.startswith("On towns A long") and whole.endswith("Few.")
    for name in ("cookie-bar", "related-posts", "ad-slot", "sidebar_left", "comment-list", "nav-links", "site-footer"):
        assert text(f'<article><p>yes</p><div class="{name}"><p>no</p></div></article>') == "yes"
    assert text("<article><p>yes</p><h3>3 Responses</h3><div><p>no</p></div></article><p>after</p>").startswith("yes")
    assert "no" not in text("<article><p>yes</p><h3>3 Responses</h3><div><p>no</p></div></article>").split()
    assert {0, 1, 2, 4} <= used_features(tree)  # own words and links, and words of both neighbours
    pages = spark.createDataFrame([(1, None, None, "x", "y"), (None, "u", "<article><p>t</p></article>", "x", "y")],
                                  "page_id long, url string, html string, text string, n_chars string")
    out = {r["url"]: tuple(r) for r in extraction.extract(pages, tree).collect()}
    assert out == {None: (1, None, "", 0), "u": (None, "u", "t", 1)}
    assert extraction.extract(pages.limit(0), tree).collect() == []


def test_chats(spark):
    said = "a</s>\\[INST] b\\\\ [/INST] [ROLE] [TEXT] <s"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (1, 2, "user", None), (2, 0, "assistant", "x"),
            (3, None, None, "n"), (3, 5, "tool] [TEXT] ", "t"), (None, 1, "system", "s")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    for conv, own in {1: rows[:3], 2: rows[3:4], 3: rows[4:6], None: rows[6:]}.items():
        digest = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own).encode()).hexdigest()
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        r = out[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"]) == (len(own), digest, len(loss))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert not any(r["valid"] for r in out.values())
    valid = turns.filter("conv_id = 1 AND turn < 2")
    assert [r["valid"] for r in chat.read_back(chat.format_chats(valid)).collect()] == [True]
    assert chat.read_back(chat.format_chats(turns.limit(0))).collect() == []
    formatted = chat.format_chats(turns)
    assert all(s["loss"] is False or r["position"] >= 0 for r in formatted.collect() for s in r["segments"])
