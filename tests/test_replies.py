"""Reply parsers, acceptance and first usable attempt."""

from random import Random

import pytest
from pyspark.sql import functions as F

from examloom.functions.replies import parse_bold_reply, parse_korean_reply, valid_generation
from examloom.operators.replies import first_by_attempt, first_valid_attempt, parse_generation_ko
from tests.helpers import evaluate, plan

BOLD = {
    "plain": ("**New Question:** Q?\n**New Choices:**\n1. a\n2. b\n3. c\n4. d\n5. e\n\n**New Answer:** 3",
              ("Q?", ["a", "b", "c", "d", "e"], 3)),
    "answer inside the list is lost": (
        "**New Question:** Q\n**New Choices:**\n1. a\n2. b\n**New Answer:** 3", ("Q", ["a", "b"], None)),
    "blank line closes an empty list": (
        "**New Question:** Q\n**New Choices:**\n\n1. a\n**New Answer:** 2", ("Q", [], 2)),
    "blank line of other spaces": (
        "**New Choices:**\n1. a\n 　\t\n2. b\n**New Answer:** 2", ("", ["a"], 2)),
    "not a number": ("**New Answer:** 3번", ("", [], None)),
    "last readable answer": (
        "**New Answer:** 1\n**New Answer:** 4\n**New Answer:** x", ("", [], 4)),
    "last question, even inside a list": (
        "**New Question:** A\n**New Choices:**\n1. a\n**New Question:** B **New Question:** C \n2. b",
        ("B  C", ["a", "b"], None)),
    "heading text is ignored": ("**New Choices:** 1. no\n1. yes", ("", ["yes"], None)),
    "indented heading is no heading": (" **New Choices:**\n1. a\n **New Question:** Q", ("", [], None)),
    "options: indented, without a dot, other lines": (
        "**New Choices:**\n  1. a. b \n2) c\nfoo\n6. f\n- 3. g\n12. h\n5.", ("", ["a. b", "2) c", "h", "5."], None)),
    "second list": (
        "**New Choices:**\n1. a\n\n**New Choices:**\n2. b\n\n**New Answer:** 1", ("", ["a", "b"], 1)),
    "repeated heading keeps the list open": (
        "**New Choices:**\n1. a\n**New Choices:**\n2. b\n**New Answer:** 1", ("", ["a", "b"], None)),
    "answer before the list": (
        "**New Answer:** 5\n**New Choices:**\n1. a", ("", ["a"], 5)),
    "answer marker alone": ("**New Answer:**", ("", [], None)),
    "carriage returns": (
        "**New Question:** Q\r\n**New Choices:**\r\n1. a\r\n\r\n**New Answer:** 2\r", ("Q", ["a"], 2)),
    "line separators do not end a line": (
        "**New Question:** Q\u2028**New Answer:** 2", ("Q\u2028**New Answer:** 2", [], None)),
    "empty": ("", ("", [], None)),
}


@pytest.mark.parametrize("case", BOLD)
def test_bold_reply(spark, case):
    reply, expected = BOLD[case]
    assert [tuple(r) for r in evaluate(spark, parse_bold_reply, [reply])] == [expected]


def test_bold_reply_against_the_definition(spark):
    """A line is inside a list if a heading stands before it with no blank line between."""
    pool = ["**New Question:** Q1", "**New Question:** Q2 ", "**New Choices:**", "1. a", " 2. b. c",
            "text", "", " \t", "**New Answer:** 3", "**New Answer:** no", "12) z", "9. no"]
    random = Random(7)
    replies = [[random.choice(pool) for _ in range(random.randrange(14))] for _ in range(300)]

    def inside(lines, n):
        before = [m for m in range(n) if lines[m] == "**New Choices:**"]
        return bool(before) and all(line.strip() for line in lines[before[-1]:n])

    def expected(lines):
        texts = {"1. a": "a", " 2. b. c": "b. c", "12) z": "12) z"}
        asked = [line for line in lines if "Question" in line]
        found = [texts[x] for n, x in enumerate(lines) if x in texts and inside(lines, n)]
        answered = any(x == "**New Answer:** 3" and not inside(lines, n) for n, x in enumerate(lines))
        return (asked[-1][18:].strip() if asked else "", found, 3 if answered else None)

    got = evaluate(spark, parse_bold_reply, ["\n".join(lines) for lines in replies])
    assert [tuple(r) for r in got] == [expected(lines) for lines in replies]


FIVE = "1. a\n2. b\n3. c\n4. d\n5. e"
ABCDE = ["a", "b", "c", "d", "e"]
KOREAN = {
    "label without the space stays": (f"질문: Q\n선택지:\n{FIVE}\n정답: 2", ("질문: Q", ABCDE, 2)),
    "label with the space goes": (f"  질문 : Q \n선택지\n{FIVE}\n정답: 2", ("Q", ABCDE, 2)),
    "four options swallow the answer": (
        "질문 : Q\n선택지:\n1. a\n2. b\n3. c\n4. d\n정답: 2", ("Q", ABCDE[:4], None)),
    "blank lines inside the list": (
        "선택지:\n1. a\n\n2. b\n3. c\n\n4. d\n5. e\n정답: 5", ("", ABCDE, 5)),
    "other lines inside the list": (
        "선택지:\n1. a\nx\n2. b\n정답: 1\n3. c\n4. d\n5. e", ("", ABCDE, None)),
    "sixth option is ignored": (f"선택지:\n{FIVE}\n1. f\n정답: 3", ("", ABCDE, 3)),
    "reopened list swallows answers": (
        f"선택지:\n{FIVE}\n정답: 1\n선택지:\n정답: 4", ("", ABCDE, 1)),
    "reopened list takes more options": (
        f"선택지:\n{FIVE}\n정답: 1\n선택지:\n1. f\n정답: 4", ("", ABCDE + ["f"], 1)),
    "heading repeated inside the list": (
        "선택지:\n1. a\n선택지:\n2. b\n3. c\n4. d\n5. e\n정답: 2", ("", ABCDE, 2)),
    "not a number": (f"선택지:\n{FIVE}\n정답: 3번", ("", ABCDE, None)),
    "no colon": (f"선택지:\n{FIVE}\n정답 3", ("", ABCDE, None)),
    "first colon only": (f"정답: 2\n선택지:\n{FIVE}\n정답: 3: 4", ("", ABCDE, 2)),
    "last readable answer": ("정답: 1\n정답: 4\n정답: x", ("", [], 4)),
    "last question, even inside a list": (
        "질문 : A\n선택지:\n1. a\n질문 : B 질문 : C", ("B C", ["a"], None)),
    "indented lines count": ("　선택지:\n\t1. a. b\n 2) c", ("", ["a. b", "2) c"], None)),
    "empty": ("", ("", [], None)),
}


@pytest.mark.parametrize("case", KOREAN)
def test_korean_reply(spark, case):
    reply, expected = KOREAN[case]
    assert [tuple(r) for r in evaluate(spark, parse_korean_reply, [reply])] == [expected]


def test_korean_label_can_be_removed(spark):
    got = evaluate(spark, lambda c: parse_korean_reply(c, strip_label=True), ["질문: Q", "질문 : R"])
    assert [r["question"] for r in got] == ["Q", "R"]


def test_long_reply(spark):
    """Whole texts of many thousand lines are parsed without recursion."""
    body = "\n".join(["filler line"] * 20_000)
    reply = f"{body}\n**New Choices:**\n{body}\n1. a\n{body}\n\n{body}\n**New Answer:** 2"
    assert tuple(evaluate(spark, parse_bold_reply, [reply])[0]) == ("", ["a"], 2)
    reply = f"{body}\n선택지:\n{body}\n{FIVE}\n{body}\n정답: 2"
    assert tuple(evaluate(spark, parse_korean_reply, [reply])[0]) == ("", ABCDE, 2)


def test_valid_generation(spark):
    replies = [BOLD["plain"][0], BOLD["blank line closes an empty list"][0], "", None]
    assert evaluate(spark, lambda c: valid_generation(parse_bold_reply(c)), replies) == [
        True, False, False, False]
    replies = [KOREAN["label with the space goes"][0], KOREAN["four options swallow the answer"][0],
               "질문 : Q\n" + KOREAN["reopened list takes more options"][0]]
    assert evaluate(spark, lambda c: valid_generation(parse_korean_reply(c), 5), replies) == [
        True, False, False]


def responses(spark, rows):
    return spark.createDataFrame(rows, "id string, attempt int, text string")


def test_first_valid_attempt(spark):
    good = "질문 : Q{0}\n선택지:\n" + FIVE + "\n정답: {0}"
    rows = [
        ("a", 1, good.format(1)), ("a", 2, good.format(2)),
        ("b", 1, "bad"), ("b", 2, good.format(2)),
        ("c", 1, "bad"), ("c", 2, ""), ("c", 3, good.format(3)),
        ("d", 1, None),
        ("e", 1, good.format(4)), ("e", 1, good.format(2)),
    ]
    got = first_valid_attempt(responses(spark, rows)).orderBy("id").collect()
    assert [(r["id"], r["attempt"], r["question"], r["answer"]) for r in got] == [
        ("a", 1, "Q1", 1), ("b", 2, "Q2", 2), ("e", 1, "Q2", 2)]


def test_first_by_attempt(spark):
    rows = [("a", 2, "y"), ("a", 1, "z"), ("b", 1, "")]
    got = first_by_attempt(responses(spark, rows), "text").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a", 1, "z"), ("b", 1, "")]


def test_replies_are_parsed_once(spark):
    parsed = parse_generation_ko(responses(spark, [("a", 1, "x")]))
    filtered = parsed.filter("parsed.answer = 2").select("parsed.question")
    assert plan(filtered).count("split(") == 1


def test_hot_id_is_combined_before_the_shuffle(spark):
    good = "질문 : Q\n선택지:\n" + FIVE + "\n정답: 1"
    hot = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit(1).alias("attempt"), F.lit(good).alias("text"))
    got = first_valid_attempt(hot)
    assert got.count() == 2_001
    assert "partial_min" in got._jdf.queryExecution().executedPlan().toString()
