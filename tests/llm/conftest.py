import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i}" for i in range(20_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, copies, and clashing columns."""
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew a bitter potion " * 3
    own = " ".join(f"unique{i}" for i in range(60))
    rows = [
        (1, None, None, None, None), (2, "", "en", "s1", 0), (3, " \t\n ", "en", "s1", 4),
        (4, base, "en", "s1", 9), (5, base, "en", None, 9), (6, base.replace(" ", "\n", 2), "en", "s2", 9),
        (7, own, "de", "s2", 1), (8, own + " more", None, "s2", 1), (9, LONG, "en", "s3", 1),
        (10, LONG + " end", "en", "s3", 1), (11, "ß" * 700 + " a" * 40, "de", "s3", 1), (12, "\x00x\x0b" * 60, "en", "s4", 1),
        (13, "one two three", "en", "s4", 1), (14, "ONE two\tthree", "en", "s4", 1),
    ]
    columns = ["n_words", "kept", "_n", "h", "set_id", "digest", "place", "shard", "token", "leaf", "host", "epoch"]
    schema = DOCUMENT + "".join(f", `{c}` string" for c in columns)
    return spark.createDataFrame([r + ("clash",) * len(columns) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture()
def one_document(spark, odd_docs):
    """Documents with repeated rows and null ids."""
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id < 9")
    return plain.unionByName(plain).unionByName(plain.selectExpr(
        "cast(null AS long) AS doc_id", "text", "lang", "source", "n_chars"))


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
