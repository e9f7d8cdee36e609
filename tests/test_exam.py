"""Exam tables, prompts and chat text."""

from pyspark.sql import functions as F

from examloom import fixed_values as fv
from examloom.functions import prompts
from examloom.operators import exam as ex
from examloom.operators import messages
from examloom.schemas import EXAM_RAW
from examloom.sources import templates
from tests.helpers import evaluate, plan

FLAT = ("id string, paragraph string, question string, choices array<string>, answer int, "
        "question_plus string")


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), EXAM_RAW)


def test_flatten_exam(spark):
    df = raw(
        spark,
        ("a", "P", "{'question': 'Q', 'choices': ['x', 'y'], 'answer': 1}", "outer"),
        ("b", "P", "{'question': 'Q', 'choices': [], 'question_plus': 'inner'}", "outer"),
        ("c", "P", "broken", "outer"),
    )
    assert [tuple(r) for r in ex.flatten_exam(df).orderBy("id").collect()] == [
        ("a", "P", "Q", ["x", "y", "정답 없음"], 1, None),
        ("b", "P", "Q", ["정답 없음"], None, "inner"),
    ]
    outer = ex.flatten_exam(df, coalesce_outer=True).orderBy("id").collect()
    assert [r["question_plus"] for r in outer] == ["outer", "inner"]
    assert [r["id"] for r in ex.unreadable_exam(df).collect()] == ["c"]
    assert ex.unreadable_exam(df).columns == df.columns


def test_flatten_reads_each_literal_once(spark):
    df = raw(spark, ("a", "P", "{'question': 'Q', 'choices': [], 'answer': 1}", None))
    flat = ex.flatten_exam(df)
    assert plan(flat.filter("answer = 1 AND question_plus = ''")).count("ArrowEvalPython") == 1
    assert plan(ex.unreadable_exam(df)).count("ArrowEvalPython") == 1


def test_nest_and_drop(spark):
    df = spark.createDataFrame([("a", "P", "Q", ["x"], 3, None)], FLAT)
    nested = ex.drop_problem_parts(ex.nest_problems(df))
    assert nested.columns == ["id", "paragraph", "question_plus", "problems"]
    assert nested.first()["problems"].asDict() == {"question": "Q", "choices": ["x"], "answer": 3}


def test_full_question_and_length(spark):
    df = spark.createDataFrame(
        [(1, "Q", None), (2, "Q", ""), (3, "Q", "한국어😀")], "n int, question string, question_plus string")
    rows = ex.add_question_length(ex.add_full_question(df)).orderBy("n").collect()
    assert [(r["question_plus"], r["full_question"], r["question_length"]) for r in rows] == [
        ("", "Q", 1), ("", "Q", 1), ("한국어😀", "Q 한국어😀", 6)]


def test_filters(spark):
    df = spark.createDataFrame(
        [("가" * 286,), ("가" * 287,), (None,)], "paragraph string")
    assert ex.filter_min_length(df).count() == 1
    counts = spark.createDataFrame([(1024, [1]), (1025, [1] * 1025)], "token_count int, ids array<int>")
    assert ex.filter_max_tokens(counts).count() == 1
    assert ex.filter_max_tokens(counts, "ids").count() == 1
    labels = spark.createDataFrame([("필요 없음",), ("필요함",), (None,)], "prior_knowledge_needed string")
    assert ex.filter_no_prior_knowledge(labels).count() == 1


def test_quarantine_keeps_every_row(spark):
    df = spark.range(10).select("id", F.when(F.col("id") > 6, "large").alias("why"))
    good, bad = ex.quarantine(df, F.col("why"))
    assert (good.count(), bad.count()) == (7, 3)
    assert {r["reason"] for r in bad.collect()} == {"large"}


def test_augmented_rows(spark):
    df = spark.createDataFrame([("a", "P", "Q", ["x"], 3, "old")], FLAT)
    row = ex.make_augmented_rows(df).first()
    assert (row["id"], row["question_plus"], row["problems"]["answer"]) == ("a_aug", "", 3)


def test_sort_by_id_number(spark):
    ids = ["b", "x10", "x9", "y9z1", "a", "n12345678901234567890123456789012345678901234567890",
           "n2345678901234567890123456789012345678901234567890", "z007", ""]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    assert [r["id"] for r in ex.sort_by_id_number(df).collect()] == [
        "z007", "x9", "y9z1", "x10", "n2345678901234567890123456789012345678901234567890",
        "n12345678901234567890123456789012345678901234567890", "", "a", "b"]


def test_sort_spreads_a_hot_id(spark, conf):
    """Rows that share one id still end up in several range partitions."""
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(0, 8_000, numPartitions=8).select(F.lit("exam-1").alias("id"), F.lit("p").alias("paragraph"))
    ordered = ex.sort_by_id_number(df)
    sizes = [len(p) for p in ordered.rdd.glom().collect()]
    assert sum(sizes) == 8_000 and max(sizes) < 4_000


def test_preview(spark):
    assert [r["id"] for r in ex.preview(spark.range(100), "id").collect()] == [0, 1, 2, 3, 4]


def test_merge_sources(spark):
    a = spark.createDataFrame([("1", "P", "x")], "id string, paragraph string, question_plus string")
    b = spark.createDataFrame([("P", "1")], "paragraph string, id string")
    merged = ex.merge_sources(a, b, a)
    assert merged.columns == a.columns
    assert sorted(tuple(r) for r in merged.collect() if r["question_plus"]) == [("1", "P", "x")] * 2
    assert merged.filter("question_plus IS NULL").collect()[0]["paragraph"] == "P"
    named = ex.merge_sources(a, b, names=["train", "bold"])
    assert sorted((r["id"], r["source"]) for r in named.collect()) == [("1", "bold"), ("1", "train")]


# --- prompts ----------------------------------------------------------------------------


def test_number_choices(spark):
    assert evaluate(spark, prompts.number_choices, [["a", "b"], [], [None]], "array<string>") == [
        "1 - a\n2 - b", "", "1 - None"]


def test_prompt_text(spark):
    df = spark.createDataFrame([
        ("a", "지문 {question} $1 \\1", "Q {choices}", ["x", "y"], 1, None),
        ("b", "P", "Q", ["x"], 1, "{paragraph}"),
    ], FLAT)
    got = [r["prompt"] for r in messages.render_prompt(df).orderBy("id").collect()]
    assert got == [
        "지문:\n지문 {question} $1 \\1\n\n질문:\nQ {choices}\n\n선택지:\n1 - x\n2 - y\n\n"
        "위 선택지 번호 중 하나를 정답으로 고르세요.\n정답:",
        "지문:\nP\n\n질문:\nQ\n\n<보기>:\n{paragraph}\n\n선택지:\n1 - x\n\n"
        "<보기>를 참고하여 위 선택지 번호 중 하나를 정답으로 고르세요.\n정답:",
    ]


def test_messages(spark):
    df = spark.createDataFrame([("a", "P", "Q", ["x", "y"], None, "")], FLAT)
    train = messages.train_messages(df).first()
    assert [m["role"] for m in train["messages"]] == ["system", "user", "assistant"]
    assert train["messages"][2]["content"] == "None" and train["label"] is None
    assert train["messages"][0]["content"] == "지문을 읽고 질문의 답을 구하세요."
    test = messages.test_messages(df).first()
    assert [m["role"] for m in test["messages"]] == ["system", "user"] and test["len_choices"] == 2


def test_render_chat(spark):
    chats = [
        [("system", "S"), ("user", "U"), ("assistant", "A")],
        [("user", "U"), ("system", "late"), ("assistant", "A"), ("tool", "T"), ("user", "V")],
        [],
    ]
    got = evaluate(spark, prompts.render_chat, chats, "array<struct<role:string,content:string>>")
    assert got == [
        "S<start_of_turn>user\nU<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>\n",
        "<start_of_turn>user\nU<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>\n"
        "<start_of_turn>user\nV<end_of_turn>\n<start_of_turn>model\n",
        "",
    ]


def test_turns_join_to_the_chat(spark):
    chat = [("system", "S"), ("user", "U"), ("system", "late"), ("assistant", "A")]
    turns = spark.createDataFrame(
        [(c, n + c, r, t) for c in (0, 4) for n, (r, t) in enumerate(chat)],
        "conv_id int, turn int, role string, text string")
    segments = messages.render_chat_turns(turns).filter("conv_id = 4").orderBy("turn").collect()
    whole = evaluate(spark, prompts.render_chat, [chat], "array<struct<role:string,content:string>>")
    assert "".join(r["segment"] for r in segments) == whole[0]
    given = messages.render_chat_turns(turns, first_turn=0).filter("conv_id = 0").orderBy("turn").collect()
    assert "".join(r["segment"] for r in given) == whole[0]
    empty = evaluate(spark, prompts.render_chat, [[("system", "S"), ("user", None), ("assistant", "A")]],
                     "array<struct<role:string,content:string>>")[0]
    assert empty == "S<start_of_turn>user\n<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>\n"


def test_label_and_generation_prompts(spark):
    df = spark.createDataFrame([("a", "P{x}", "Q", ["it's", 'b"'], 4, None)], FLAT)
    label = messages.label_prompt(df).first()["label_prompt"]
    assert "지문: P{x}\n    문제: Q\n    선택지: [\"it's\", 'b\"']\n    보기: nan\n" in label["user"]
    assert label["system"] == fv.LABEL_SYSTEM_PROMPT
    english = messages.generation_prompt_en(df).first()["generation_prompt"]
    assert "Paragraph: P{x}\n" in english and "Original Answer: 4\n" in english
    assert fv.GENERATION_EXAMPLE in english and "{example}" not in english
    korean = messages.generation_prompt_ko(df).first()["generation_messages"]
    assert [m["role"] for m in korean] == ["system", "user"]
    assert "원래 정답: 4\n" in korean[1]["content"]


def test_templates_from_files(spark, tmp_path):
    path = tmp_path / "plain.txt"
    path.write_text("P: {paragraph}\nC: {choices}", encoding="utf-8")
    chosen = templates.prompt_templates(spark, plain_path=str(path))
    assert chosen["material"] == fv.PROMPT_WITH_MATERIAL
    df = spark.createDataFrame([("a", "P", "Q", ["x"], 1, None)], FLAT)
    text = prompts.render_prompt(
        F.col("paragraph"), F.col("question"), F.col("choices"), F.col("question_plus"), **chosen)
    assert df.select(text.alias("t")).first()["t"] == "P: P\nC: 1 - x"
