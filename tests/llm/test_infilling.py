"""Fill-in-the-middle against its definition, and the boundary containers against sorted lists."""

import hashlib
import re

import numpy as np
import pytest

from examloom.llm import infilling


def brute(doc_id, text, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = [None, "", "\n", "\n\n\n", "one line", "one\ntwo\n", "one\ntwo", "ends <P> here\nand", "<\nS>\n<P\n",
         "Ä\nö\r\n\x00\n€", "a <\n<S\n<M" * 30, "line\n" * 70_000, "\n" * 200_000, "x" * 150_000 + "\ny", "<M>"]


def documents(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS * 8)] + [(None, "a\nb\nc\n", None)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, form string"), rows


@pytest.mark.parametrize("rule", [infilling.Rule(), infilling.Rule(percent=50, spm_percent=20)])
def test_rows(spark, rule):
    docs, rows = documents(spark)
    found = sorted(map(repr, infilling.infill(docs, rule).collect()))
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    expected = [(i, *brute(i, t, rule.percent, rule.spm_percent)) for i, t, _ in rows]
    assert found == sorted(map(repr, spark.createDataFrame(
        expected, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    ).select(names).collect()))


def test_digests(spark):
    docs, rows = documents(spark)
    for r in infilling.digests(docs).collect():
        text = dict((i, t) for i, t, _ in rows)[r.doc_id] or ""
        output = brute(r.doc_id, text)[4]
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark, no_docs):
    assert infilling.infill(no_docs).count() == 0 and infilling.digests(no_docs).count() == 0


def test_containers():
    rng = np.random.Generator(np.random.PCG64(1))
    shapes = {
        infilling.ArrayContainer: np.sort(rng.choice(65_536, 900, False)),
        infilling.BitmapContainer: np.sort(rng.choice(65_536, 30_000, False)),
        infilling.RunContainer: np.concatenate([np.arange(10, 5_000), np.arange(6_000, 65_536)]),
    }
    for kind, low in shapes.items():
        built = infilling._container(low)
        assert type(built) is kind
        assert [built.select(k) for k in range(len(low))] == low.tolist()
    full = infilling._container(np.arange(65_536))
    assert type(full) is infilling.RunContainer and full.select(65_535) == 65_535


def test_boundary_set():
    for text in TEXTS:
        raw = (text or "").encode()
        ends = [m.end() for m in re.finditer(rb"[^\n]*\n|[^\n]+", raw)]
        found = infilling.BoundarySet(raw)
        assert len(found) == len(ends)
        step = max(1, len(ends) // 200)
        assert all(found.select(k) == ([0] + ends)[k] for k in [*range(0, len(ends), step), len(ends)])
