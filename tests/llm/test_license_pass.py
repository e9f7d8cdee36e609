"""License scans read and split each text once; case beyond A-Z; texts that cannot match are not staged."""

import pytest
from pyspark.sql import functions as F

from examloom.llm import licenses


def test_texts_are_read_once(spark, tmp_path):
    n = 40
    rows = [(i, f"plain text number {i}\nreleased under the MIT license" if i % 4 == 0 else f"plain text number {i}")
            for i in range(n)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    docs = spark.read.parquet(str(tmp_path / "docs")).select("doc_id", counted("text").alias("text"))
    out = {r["doc_id"]: (r["n_words"], r["labels"]) for r in licenses.scan(docs).collect()}
    assert out == {i: (9, "mit") if i % 4 == 0 else (4, "") for i in range(n)}
    assert read.value == n


def test_only_texts_that_may_match_are_staged(spark):
    texts = ["released under the MIT license", "Redistribution and use are not the same", "", None,
             "licensed under CC\n" + "BY-SA 4.0", "the mit of a person in this software"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses._split_once(docs, "doc_id", "text", licenses.TEMPLATES, licenses.PHRASES, licenses.THRESHOLD)
    found = {r["doc_id"]: (r["_text"] is not None, r["_spaced"]) for r in rows.collect()}
    assert found == {i: (i in (0, 4), " released under the mit license " if i == 0 else None) for i in range(6)}


@pytest.mark.parametrize("text, words, base, labels", [
    ("released under the MİT license", 5, 0, ""), ("under the mit license", 4, 1, "mit"),
    ("worK under the MIT LICENSE É", 6, 1, "mit"), ("under the mit licenſe", 4, 0, ""),
    ("under\x00the\x7fmit\x01LICENSE\x0b", 4, 1, "mit"), ("éunder the mit license", 4, 0, ""),
    (" \n\t", 0, 0, ""), ("\n a--b \x00", 2, 0, ""),
    ("this worK is licensed under the gnu general public license version 3", 12, 0, "gpl-3"),
])
def test_case_and_gaps(spark, text, words, base, labels):
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_words"], row["n_base"], row["labels"]) == (words, base, labels)


def test_phrases_beyond_ascii(spark):
    docs = spark.createDataFrame([(1, "Unter der Ä-LIZENZ"), (2, "unter der ä lizenz")], "doc_id long, text string")
    out = licenses.scan(docs, phrases={"der Ä lizenz": "upper"})
    assert {r["doc_id"]: r["base_labels"] for r in out.collect()} == {1: "upper", 2: ""}
