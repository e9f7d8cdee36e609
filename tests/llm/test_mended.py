"""Indexes that are opened again, large ids with missing ones, licenses that differ in a word."""

import hashlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from checks.compare import connect
from examloom.llm import chat, common, exact_dedup, jaccard, licenses, long_repeats
from examloom.llm.common import scratch
from tests.llm import brute


def made_up(spark, ids, text="text {}"):
    return spark.createDataFrame([(i, text.format(i)) for i in ids], "doc_id long, text string")


def kept(df):
    return sorted(r["doc_id"] for r in df.collect() if r["kept"])


def test_index_opened_with_other_partitions(spark, conf):
    path = scratch(spark, "digests")
    conf("spark.sql.shuffle.partitions", "8")
    index = exact_dedup.DigestIndex(spark, path)
    assert len(kept(exact_dedup.deduplicate(made_up(spark, range(500)), index))) == 500
    index.close()
    conf("spark.sql.shuffle.partitions", "4")
    again = exact_dedup.DigestIndex(spark, path)
    assert again.buckets == 8
    assert kept(exact_dedup.deduplicate(made_up(spark, range(400, 600)), again)) == list(range(500, 600))
    assert again.rows().count() == 600


def test_index_refuses_other_forms(spark):
    path = scratch(spark, "digests")
    exact_dedup.DigestIndex(spark, path, 4).close()
    with pytest.raises(ValueError, match="buckets"):
        exact_dedup.DigestIndex(spark, path, 6)
    spark.range(3).write.parquet(f"{path}-plain")
    with pytest.raises(ValueError, match="note"):
        exact_dedup.DigestIndex(spark, f"{path}-plain")


def test_two_indexes_whose_paths_end_alike(spark):
    one, two = (exact_dedup.DigestIndex(spark, f"{scratch(spark, side)}/digests") for side in "ab")
    assert len(kept(exact_dedup.deduplicate(made_up(spark, range(50)), one))) == 50
    assert len(kept(exact_dedup.deduplicate(made_up(spark, range(40, 60)), two))) == 20
    assert (one.rows().count(), two.rows().count()) == (50, 20)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_copies_over_batches(spark, batches):
    """Later batches meet the texts of earlier ones in the index."""
    rows = [(i, f"text {i % 17}") for i in range(100)] + [(None, "text 3"), (None, "alone"), (None, "alone"), (5, "text 5")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    index = exact_dedup.new_index(spark)
    out = exact_dedup.deduplicate(docs, index, batches=batches).collect()
    size = Counter(t for _, t in rows)
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in size}
    assert len(out) == len(rows)
    for r in out:
        text = digest[r["text_sha256"]]
        assert r["group_size"] == size[text]
        assert r["keep_id"] == (None if text == "alone" else int(text.split()[1]))
    assert sorted(r["doc_id"] for r in out if r["kept"] and r["doc_id"] is not None) == list(range(17))
    assert sum(r["kept"] for r in out) == 18 and index.rows().count() == 18
    if batches > 1:
        assert 1 < index.batches() <= batches


def test_large_ids_beside_missing_ones(spark, conf):
    conf("spark.sql.shuffle.partitions", "1")
    ids = [2**53, 2**53 + 1, -2**53 - 1, 2**63 - 1, None]
    turns = [(i, n, role, f"{i} {role}", "clash") for i in ids for n, role in enumerate(("user", "assistant"))]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string, segments string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert set(out) == set(ids) and all(r["n_turns"] == 2 for r in out.values())
    for i, r in out.items():
        assert r["loss_sha256"] == hashlib.sha256(f"{i} assistant".encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256(f"user\n{i} user\nassistant\n{i} assistant\n".encode()).hexdigest()


def test_very_long_turn(spark):
    long = "[INST] \\ word " * 100_000
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], "conv_id long, turn int, role string, text string")
    (r,) = chat.read_back(chat.format_chats(df)).collect()
    assert r["loss_chars"] == len(long) and r["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()


MIT = licenses.TEMPLATES["mit"][1][1].split()
BSD = licenses.TEMPLATES["bsd"][0][1].split()
NOTICES = [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("released under the apache license", ""), ("distributed under the MIT License", "mit"),
    ("licensed under the Apache License, Version 1.1", ""), ("Licensed under the Apache License,\nVersion 2.0", "apache-2"),
    ("This work is licensed under the GNU General Public License version 2", ""),
    ("This work is licensed under the GNU General\nPublic License version 3", "gpl-3"),
    (" * ".join(MIT[:11]) + "\n * " + " ".join(MIT[11:21]) + "\n * " + " ".join(MIT[21:]), "mit"),
    (" ".join(BSD[:7]) + "\n" + " ".join(BSD[7:14]) + "\r\n" + " ".join(BSD[14:]), "bsd"),
    (" ".join(BSD[:7]) + "\n\n\n\n\n" + " ".join(BSD[7:]), ""), ("nothing " * 30_000, ""), ("", ""), (None, ""),
]


def test_licenses_differ_in_a_word(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string, labels string")
    out = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert out == {i: label for i, (_, label) in enumerate(NOTICES)}


def test_license_values_of_odd_rows(spark, odd_docs, tmp_path):
    """The values of odd rows, by DuckDB."""
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id NOT IN (9, 10, 12)")  # DuckDB takes minutes for the long ones
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(licenses.SQL).fetchall()
    found = licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_staged_tables_go(spark, tmp_path):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    with common.staging(spark):
        index = exact_dedup.new_index(spark)
        exact_dedup.deduplicate(made_up(spark, range(30)), index).write.parquet(str(tmp_path / "out"))
        index.close()
        assert len(set(folder.iterdir()) - before) > 2
    left = {p.name.split("-")[0] for p in set(folder.iterdir()) - before}
    assert left <= {"digest"} and spark.read.parquet(str(tmp_path / "out")).count() == 30  # the index' note stays


def test_copies_not_linked_with_their_centre(spark, monkeypatch):
    """The set with most copies is linked with none of the others, which are linked with each other."""
    base = [f"w{i}" for i in range(100)]

    def changed(*places):
        return " ".join(f"x{places}{i}" if i in places else w for i, w in enumerate(base))

    texts = [changed(30, 60), changed(30, 60)] + [changed(i) for i in range(5, 95)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, staged = {}, jaccard.staged

    def counted(df, name):
        out = staged(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "staged", counted)
    result = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs, jaccard.Threshold(80, 5)).collect()}
    assert result == {0: 0, 1: 0} | {i: 2 for i in range(2, 92)}
    assert rows["cross-pairs"] < 90  # 4,005 pairs of these sets


def test_few_pairs_of_centres_wait_for_the_last_step(spark, monkeypatch):
    """As above with few sets: they are linked without rounds of verifying and merging."""
    base = [f"w{i}" for i in range(100)]

    def changed(*places):
        return " ".join(f"x{places}{i}" if i in places else w for i, w in enumerate(base))

    texts = [changed(30, 60), changed(30, 60)] + [changed(i) for i in range(5, 95, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names, staged = [], jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: names.append(name) or staged(df, name))
    result = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs, jaccard.Threshold(80, 5)).collect()}
    assert result == {i: c for i, (_, c) in brute.near_components(dict(enumerate(texts)), 80, 5).items()}
    assert names.count("round-pairs") == 2 and names.count("merged-components") == 1
    assert names.count("links") == 2  # of the best centres, and of all that was left


def test_few_pairs_grow_with_the_root_of_the_sets(spark, monkeypatch):
    """18 sets that their centre is not linked with, among 500: few of them."""
    base = [f"w{i}" for i in range(100)]

    def changed(*places):
        return " ".join(f"x{places}{i}" if i in places else w for i, w in enumerate(base))

    monkeypatch.setattr(jaccard, "FEW_PAIRS", 2)
    texts = [changed(30, 60), changed(30, 60)] + [changed(i) for i in range(5, 95, 5)]
    texts += [" ".join(f"o{k}t{i}" for i in range(20)) for k in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names, staged = [], jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: names.append(name) or staged(df, name))
    result = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs, jaccard.Threshold(80, 5)).collect()}
    assert result == {i: c for i, (_, c) in brute.near_components(dict(enumerate(texts)), 80, 5).items()}
    assert names.count("round-pairs") == 2 and names.count("links") == 2


def test_prefixes_of_sets_do_not_stay_staged(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2 + j}" for j in range(40))) for i in range(40)],
                                 "doc_id long, text string")
    before = set(common._STAGED)
    jaccard.join(docs, jaccard.Threshold(80, 5))
    left = [path for path in common._STAGED if path not in before]
    columns = {c for path in left for c in spark.read.parquet(path).columns}
    assert "wide" in columns and "prefix" not in columns


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    """Hashed in pieces of any size, which are small: arrays of them stay in a processor's cache."""
    assert long_repeats.HASHED_BYTES * 8 <= 1 << 20
    rng = np.random.default_rng(3)
    for alphabet in (1, 2, 26):
        sizes = rng.choice([0, 1, 99, 100, 101, 150, 700], 12)
        flat, ends = rng.integers(97, 97 + alphabet, sizes.sum()).astype(np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        monkeypatch.setattr(long_repeats, "HASHED_BYTES", 1 << 16)
        whole = long_repeats.anchors(flat, ends)
        strings = {int(a) for x, y in zip(whole[1], whole[2]) for a in range(x, y - 99)}
        assert strings == {a for a in range(len(flat)) if any(x <= a and a + 100 <= y for x, y in zip(ends, ends[1:]))}
        for place, start, end in zip(whole[3], whole[1], whole[2]):
            assert end - 100 <= place <= start + 68  # every string of the segment holds its anchor
        monkeypatch.setattr(long_repeats, "HASHED_BYTES", 130)
        assert all(np.array_equal(x, y) for x, y in zip(whole, long_repeats.anchors(flat, ends)))
