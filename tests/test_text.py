"""Text rules: Python string semantics, labels, ids, decoding."""

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.functions import labels, literals, text
from tests.helpers import evaluate

SLOW = settings(max_examples=5, deadline=None, database=None,
                suppress_health_check=list(HealthCheck))
# Characters both the JVM and Python know; newer ones differ in being printable.
KNOWN = st.characters(exclude_categories=["Cs", "Co"]).filter(
    lambda c: unicodedata.ucd_3_2_0.category(c) != "Cn")
ANY_TEXT = st.text(st.one_of(st.sampled_from("'\"\\\n \xa0a한"), KNOWN), max_size=12)


def test_whitespace_is_pythons():
    assert set(text.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip(spark):
    values = [" \t한글　\n", "\x1c\x85a b\xa0", "", " ", "​keep​"]
    assert evaluate(spark, text.strip, values) == [v.strip() for v in values]


def test_python_int(spark):
    values = ["3", " +3　", "-12", "1_000", "３", "3번", "3.7", "", "1__0", "_1", "+",
              "99999999999", "٣", "1" * 20]
    assert evaluate(spark, text.python_int, values) == [
        3, 3, -12, 1000, 3, None, None, None, None, None, None, 99999999999, 3, None]


def test_after_first(spark):
    values = ["1. a. b", "no separator", ". x", "1."]
    assert evaluate(spark, lambda c: text.after_first(c, ". "), values) == [
        "a. b", "no separator", "x", "1."]


def test_words(spark):
    assert evaluate(spark, text.words, ["A 한국어_1, Éa! x 12", "", None]) == [
        ["한국어_1", "éa", "12"], [], None]


def test_word_counts(spark):
    def counts(c):
        return text.word_counts(text.words(c))

    rows = evaluate(spark, counts, ["the cat the dog the", "", None, "aa"])
    assert [[(t["term"], t["tf"]) for t in r] for r in rows] == [
        [("cat", 1), ("dog", 1), ("the", 3)], [], [], [("aa", 1)]]


def test_bare_text(spark):
    values = ["*a* (Note B　c) (한글) (a1)", "((x))", "(a\nb)"]
    assert evaluate(spark, text.bare_text, values) == ["a  (한글) (a1)", "()", ""]


# --- Python literals ------------------------------------------------------------------


@SLOW
@given(st.lists(ANY_TEXT, min_size=1, max_size=40))
def test_string_literal_equals_repr(spark, values):
    got = evaluate(spark, lambda c: literals.python_literal(c, T.StringType()), values)
    assert got == [repr(v) for v in values]


PROBLEM = st.fixed_dictionaries(
    {"question": ANY_TEXT, "choices": st.lists(ANY_TEXT, max_size=6)},
    optional={"answer": st.one_of(st.none(), st.integers(0, 9)),
              "question_plus": st.one_of(st.none(), ANY_TEXT)})


@SLOW
@given(st.lists(PROBLEM, min_size=1, max_size=40))
def test_problem_literal_round_trip(spark, problems):
    got = evaluate(spark, literals.parse_problem_literal, [repr(p) for p in problems])
    assert [(g["question"], g["choices"], g["answer"], g["question_plus"]) for g in got] == [
        (p["question"], p["choices"], p.get("answer"), p.get("question_plus")) for p in problems]


@pytest.mark.parametrize("bad", [
    None, "", "text", "{'question': 'q'}", "{'choices': ['a']}", "['q']", "{'question': 'q', ",
    "{'question': 'a', 'choices': ['b'], 'answer': null}", "{'question': 'a', 'choices': 3}",
    "{'question': 'a', 'choices': ['b']} tail", "__import__('os').getcwd()",
])
def test_unusable_problem_is_null(spark, bad):
    assert evaluate(spark, literals.parse_problem_literal, [bad]) == [None]


def test_problem_details(spark):
    values = [
        "{'question': \"it's\", 'choices': ['x', 'y'], 'answer': 2}",
        "{'question': 'it\\'s', 'choices': ['a\\xa0b'], 'answer': None}",
        "{'choices': [1, True], 'question': 'q' 'r', 'answer': '4', 'other': 1}",
        "{'question': 'q', 'choices': ['\"x\"', \"it's\"], 'answer': 12, 'question_plus': ''}",
    ]
    got = evaluate(spark, literals.parse_problem_literal, values)
    assert [tuple(g) for g in got] == [
        ("it's", ["x", "y"], 2, None),
        ("it's", ["a\xa0b"], None, None),
        ("qr", ["1", "True"], 4, None),
        ("q", ['"x"', "it's"], 12, ""),
    ]


def test_usual_problems_stay_in_the_jvm(spark):
    """Long texts with ordinary escapes match the native shape; others do not."""
    long = {"question": "it's \n\\ \"x\" " * 50_000, "choices": ["a'b", "c\td"], "answer": 3,
            "question_plus": "한국어\n" * 50_000}
    values = [repr(long), "{'question': 'a\\xa0', 'choices': []}", "{'question': 'a', 'choices': [None]}"]
    native = evaluate(spark, lambda c: F.rlike(c, F.lit(literals._PLAIN_PROBLEM)), values)
    assert native == [True, False, False]
    got = evaluate(spark, literals.parse_problem_literal, values)
    assert (got[0]["question"], got[0]["choices"], got[0]["question_plus"]) == (
        long["question"], long["choices"], long["question_plus"])
    assert got[1]["question"] == "a\xa0" and got[2]["choices"] == [None]


def test_lone_surrogate_is_unusable(spark):
    assert evaluate(spark, literals.parse_problem_literal, [
        "{'question': '\\ud800', 'choices': []}"]) == [None]


def test_problem_json(spark):
    got = evaluate(spark, literals.parse_problem_json, [
        '{"question": "q", "choices": ["a\\n"], "answer": null}', "{'x': 1}", "junk"])
    assert tuple(got[0]) == ("q", ["a\n"], None, None) and got[1:] == [None, None]


def test_list_literal(spark):
    values = ["['a', \"b's\", 3]", "['a', \"b's\"]", "['it\\'s\\n']", "[]", "('x',)", "{'a': 1}", "[", None]
    assert evaluate(spark, literals.parse_list_literal, values) == [
        ["a", "b's", "3"], ["a", "b's"], ["it's\n"], [], ["x"], None, None, None]


# --- labels ------------------------------------------------------------------------------


def test_clean_topic(spark):
    values = {
        "**경제(a)**": "경제", "사회, 경제": "사회", "경제, 사회": "사회", "(문학) 기타": "ETC",
        "세계사": "세계사", "": "ETC", "언어와 매체 (문학)": "언어와 매체",
        "(경제\u2028)역사": "ETC", "(경제\n)": "경제", "분류 실패": "ETC", "독해((a)문학)": "문학",
    }
    assert evaluate(spark, labels.clean_topic, list(values)) == list(values.values())


def test_prior_knowledge(spark):
    assert evaluate(spark, labels.normalize_prior_knowledge, [
        "필요 없음", "**필요 없음** 입니다", "필요함", "필요없음", "분류 실패"]) == [
        "필요 없음", "필요 없음", "필요함", "필요함", "필요함"]


def test_label_reply(spark):
    replies = [
        "주제: 경제\n사전지식 필요: 필요 없음\n더: 있음", "주제: 경제", "", "경제\n필요 없음",
        "a: b: c\nd: e: f", "주제:경제\n사전지식: 필요", "x: \ny: ", "\nx: a\ny: b",
    ]
    failed = ("분류 실패", "분류 실패")
    assert [tuple(r) for r in evaluate(spark, labels.parse_label_reply, replies)] == [
        ("경제", "필요 없음"), failed, failed, failed, ("b", "e"), failed, ("", ""), failed]


def test_id_number(spark):
    assert evaluate(spark, labels.id_number, [
        "exam-425", "a1b22", "abc", "", "12345678901234567890", "007"]) == [
        425.0, 1.0, float("inf"), float("inf"), 12345678901234567890.0, 7.0]


def test_completion_text(spark):
    values = ["a<start_of_turn>model\nx<start_of_turn>model\ny", "no marker", "<start_of_turn>model"]
    assert evaluate(spark, labels.completion_text, values) == ["\ny", None, ""]


def test_decode_label(spark):
    values = ["1<end_of_turn>\n", " 5\n", "6", "0", "", "01", "3<end_of_turn>4", "x", "　2"]
    assert evaluate(spark, labels.decode_label, values) == [
        0, 4, None, None, None, None, 2, None, 1]
