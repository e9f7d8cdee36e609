"""Exam-shaped inputs derived from the given tables, for Spark and for DuckDB.

Every fixture covers its whole table and keeps whole texts.  The Spark side
builds typed columns; the `*_SQL` strings state the same rows, or the rows a
correct operator has to return, as common table expressions.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.functions.literals import python_literal
from examloom.schemas import PROBLEMS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table, dealt over all cores, as these files are of one row group each; a large one over as many tasks as it has splits."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.repartition(max(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()))


# --- exam questions -----------------------------------------------------------------

def exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat questions without the sentinel option; 4 or 5 options each."""
    docs = table(spark, sf_dir, "documents")
    options = ["source", "lang", "concat(lang, '-', source)", "cast(n_chars AS string)"]
    four = f"array({', '.join(options)})"
    five = f"array_append({four}, concat('c:', char(92), doc_id))"
    return docs.selectExpr(
        "doc_id",
        "source",
        "concat('exam-', doc_id) AS id",
        "text AS paragraph",
        "concat(source, char(39), 's passage in ', lang, ': which statement fits?') AS question",
        f"CASE WHEN doc_id % 2 = 1 THEN {five} ELSE {four} END AS choices",
        "doc_id % (4 + doc_id % 2) + 1 AS answer",
        "CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 2 THEN text END AS question_plus",
    )


EXAM_SQL = r"""exam AS (
  SELECT doc_id,
         'exam-' || doc_id AS id,
         text AS paragraph,
         source || '''s passage in ' || lang || ': which statement fits?' AS question,
         CASE WHEN doc_id % 2 = 1
              THEN [source, lang, lang || '-' || source, n_chars::VARCHAR, 'c:\' || doc_id]
              ELSE [source, lang, lang || '-' || source, n_chars::VARCHAR] END AS choices,
         (doc_id % (4 + doc_id % 2) + 1)::BIGINT AS answer,
         CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 2 THEN text END AS question_plus
  FROM documents)"""

# Options with the sentinel appended.
FLAT_SQL = EXAM_SQL + """, flat AS (
  SELECT * REPLACE (list_append(choices, '정답 없음') AS choices) FROM exam)"""


def flat_exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from examloom.operators.exam import append_sentinel_choice

    return append_sentinel_choice(exam(spark, sf_dir))


def exam_raw(spark: SparkSession, sf_dir: str, odd: bool = False) -> DataFrame:
    """Raw rows whose `problems` is dict text; extra material is a key only if present.

    `odd`: most rows are literals outside the usual shape, five of eight unreadable.
    """
    rows = exam(spark, sf_dir)
    with_extra = python_literal(F.struct(*PROBLEMS.fieldNames()), PROBLEMS)
    without = T.StructType(PROBLEMS.fields[:3])
    plain = python_literal(F.struct(*without.fieldNames()), without)
    rows = rows.withColumn(
        "problems", F.when(F.col("question_plus").isNull(), plain).otherwise(with_extra))
    if odd:
        rows = rows.withColumn("problems", F.expr(ODD_PROBLEMS_SPARK))
    return rows.select("doc_id", "id", "paragraph", "problems", "question_plus")


# Literals outside the usual shape by doc_id % 8; the last five cannot be read.
ODD_PROBLEMS_SPARK = r'''CASE doc_id % 8
  WHEN 0 THEN problems
  WHEN 1 THEN concat('{"choices": ["', choices[1], '\\x41", r"b\\n", u"c"], "answer": "2", "question": "', source, '"}')
  WHEN 2 THEN concat('{"answer": 3000000000, "question": """', source, '""", "choices": ("', choices[1], '", "z"),}')
  WHEN 3 THEN concat('{"question": "', source, '", "choices": "xyz", "answer": 1}')
  WHEN 4 THEN concat('{"question": "', source, '", "choices": ["a"], "answer": 1.7}')
  WHEN 5 THEN concat('{"question": "', source, '", "choices": ["a"], "answer": 99999999999999999999}')
  WHEN 6 THEN concat('{"question": "', source, '", "choices": ["a"], "answer": 1e999}')
  ELSE concat(source, ' {') END'''
ODD_PROBLEMS_SQL = r"""odd AS (SELECT doc_id, id,
  CASE doc_id % 8 WHEN 0 THEN question WHEN 1 THEN source WHEN 2 THEN source END AS question,
  CASE doc_id % 8 WHEN 0 THEN choices WHEN 1 THEN [lang || 'A', 'b\n', 'c'] WHEN 2 THEN [lang, 'z'] END AS choices,
  CASE doc_id % 8 WHEN 0 THEN answer WHEN 1 THEN 2 WHEN 2 THEN 3000000000 END AS answer,
  CASE WHEN doc_id % 8 = 0 THEN question_plus END AS question_plus,
  CASE WHEN doc_id % 8 > 2 THEN 'unreadable problem' END AS reason
  FROM exam JOIN documents USING (doc_id))"""


# The same dict text.  Documents hold neither single quotes nor backslashes.
CHOICES_LITERAL_SQL = r"""'[' || array_to_string(list_transform(choices,
    lambda c: '''' || replace(c, '\', '\\') || ''''), ', ') || ']'"""

RAW_SQL = EXAM_SQL + r""", raw AS (
  SELECT *, '{''question'': "' || question || '", ''choices'': ' || """ + CHOICES_LITERAL_SQL + r"""
      || ', ''answer'': ' || answer
      || CASE WHEN question_plus IS NULL THEN ''
              ELSE ', ''question_plus'': ''' || replace(question_plus, chr(10), '\n') || '''' END
      || '}' AS problems
  FROM exam)"""


# --- model replies -------------------------------------------------------------------

def label_reply_text() -> str:
    """Spark SQL text of a label reply; six kinds, then the whole document."""
    return """CASE doc_id % 6
      WHEN 0 THEN concat('주제: **경제(', source, ')**\\n사전지식 필요: 필요 없음\\n', text)
      WHEN 1 THEN concat('주제: 사회, 경제\\n사전지식 필요: 필요함\\n', text)
      WHEN 2 THEN concat('주제: (문학) 기타\\n사전지식 필요: 필요 없음입니다\\n', text)
      WHEN 3 THEN concat('세계사\\n필요 없음\\n', text)
      WHEN 4 THEN '주제: 언어와 매체'
      ELSE '' END"""


def label_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply for every document that has a quality label; the others have none."""
    docs = table(spark, sf_dir, "documents")
    labelled = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    return docs.join(labelled, "doc_id", "left_semi").selectExpr(
        "concat('exam-', doc_id) AS id", "'label' AS source", "1 AS attempt",
        f"{label_reply_text()} AS text")


# What the two reply lines say, and what cleaning makes of it.
LABELS_SQL = """labelled AS (
  SELECT doc_id,
         CASE doc_id % 6 WHEN 0 THEN '**경제(' || source || ')**' WHEN 1 THEN '사회, 경제'
                         WHEN 2 THEN '(문학) 기타' ELSE '분류 실패' END AS raw_topic,
         CASE doc_id % 6 WHEN 0 THEN '필요 없음' WHEN 1 THEN '필요함'
                         WHEN 2 THEN '필요 없음입니다' ELSE '분류 실패' END AS raw_prior,
         CASE doc_id % 6 WHEN 0 THEN '경제' WHEN 1 THEN '사회' ELSE 'ETC' END AS topic,
         CASE WHEN doc_id % 6 IN (0, 2) THEN '필요 없음' ELSE '필요함' END AS prior
  FROM documents)"""


def bold_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per document: the whole text, then one of six endings."""
    docs = table(spark, sf_dir, "documents")
    question = "concat('\\n**New Question:** Where is ', source, ' from? \\n')"
    options = "concat_ws('\\n', '1. one', ' 2. two. b', '3 three', lang, '4. four', '5. five')"
    text = f"""concat(text, CASE (doc_id div 6) % 6
      WHEN 0 THEN concat({question}, '**New Choices:**\\n', {options}, '\\n\\n**New Answer:** 3')
      WHEN 1 THEN concat({question}, '**New Choices:**\\n', {options}, '\\n**New Answer:** 3')
      WHEN 2 THEN concat({question}, '**New Choices:**\\n \\n', {options}, '\\n**New Answer:** 2')
      WHEN 3 THEN concat({question}, '**New Choices:**\\n', {options}, '\\n\\n**New Answer:** 3번')
      WHEN 4 THEN concat({question}, '**New Choices:** as asked\\n', {options},
                         '\\n\\n**New Answer:** 2\\n**New Answer:** +4\\n**New Answer:** none')
      ELSE '\\nNew Question: none' END)"""
    return docs.selectExpr(
        "doc_id", "concat('exam-', doc_id) AS id", "'bold' AS source", "1 AS attempt",
        f"{text} AS text")


BOLD_SQL = """bold AS (
  SELECT doc_id, 'exam-' || doc_id AS id,
         CASE WHEN doc_id // 6 % 6 = 5 THEN '' ELSE 'Where is ' || source || ' from?' END AS question,
         CASE WHEN doc_id // 6 % 6 IN (2, 5) THEN []
              ELSE ['one', 'two. b', '3 three', 'four', 'five'] END AS choices,
         CASE doc_id // 6 % 6 WHEN 0 THEN 3 WHEN 2 THEN 2 WHEN 4 THEN 4 END::BIGINT AS answer,
         doc_id // 6 % 6 IN (0, 4) AS valid
  FROM documents)"""


def korean_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attempts per document: the whole text, then one of six kinds of reply."""
    docs = table(spark, sf_dir, "documents")
    ask = "concat('\\n질문 : ', source, '의 답은? \\n')"
    tight = "concat('\\n질문: ', source, '의 답은?\\n')"
    four = "concat_ws('\\n', '1. 하나', ' 2. 둘', '3) 셋', '4. 넷. 사')"
    good = f"concat({ask}, '선택지:\\n', {four}, '\\n\\n5. 다섯\\n정답: 5')"
    first = f"""CASE (doc_id div 6) % 6
      WHEN 0 THEN concat({tight}, '선택지:\\n', {four}, '\\n5. 다섯\\n정답: 2')
      WHEN 1 THEN concat({ask}, '선택지\\n', {four}, '\\n5. 다섯\\n6. 여섯\\n정답: 9')
      WHEN 2 THEN concat({ask}, '선택지:\\n', {four}, '\\n정답: 2')
      WHEN 3 THEN concat({ask}, '선택지:\\n', {four}, '\\n5. 다섯\\n정답: 3번')
      WHEN 4 THEN concat({ask}, '선택지:\\n', {four}, '\\n5. 다섯\\n정답: 1\\n선택지:\\n정답: 4')
      ELSE '' END"""
    second = f"""CASE (doc_id div 6) % 6
      WHEN 2 THEN {good}
      WHEN 3 THEN concat({ask}, '선택지:\\n', {four}, '\\n5. 다섯\\n정답 3')
      ELSE concat({ask}, '정답: 1') END"""
    return docs.selectExpr(
        "doc_id", "concat('exam-', doc_id) AS id", "'korean' AS source",
        "text AS document",
        f"inline(array(struct(1 AS attempt, {first} AS reply), struct(2 AS attempt, {second} AS reply)))",
    ).selectExpr("doc_id", "id", "source", "attempt", "concat(document, reply) AS text")


KOREAN_SQL = """korean AS (
  SELECT doc_id, 'exam-' || doc_id AS id, attempt, kind,
         CASE WHEN attempt = 1 AND kind = 5 THEN ''
              WHEN attempt = 1 AND kind = 0 THEN '질문: ' || source || '의 답은?'
              ELSE source || '의 답은?' END AS question,
         CASE WHEN attempt = 1 AND kind = 5 OR attempt = 2 AND kind NOT IN (2, 3) THEN []
              WHEN attempt = 1 AND kind = 2 THEN ['하나', '둘', '3) 셋', '넷. 사']
              ELSE ['하나', '둘', '3) 셋', '넷. 사', '다섯'] END AS choices,
         CASE WHEN attempt = 1 THEN CASE kind WHEN 0 THEN 2 WHEN 1 THEN 9 WHEN 4 THEN 1 END
              ELSE CASE kind WHEN 2 THEN 5 WHEN 3 THEN NULL ELSE 1 END END::BIGINT AS answer,
         (attempt = 1 AND kind IN (0, 1, 4)) OR (attempt = 2 AND kind = 2) AS valid
  FROM (SELECT *, doc_id // 6 % 6 AS kind FROM documents), (VALUES (1), (2)) v(attempt))"""


# --- scores, metric log, chat --------------------------------------------------------

def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five or six option scores per vector, label as reference index."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "concat('exam-', vec_id) AS id",
        "cast(embedding AS array<double>) AS logits",
        "cast(5 + vec_id % 2 AS int) AS len_choices",
        "cast(label % 5 AS int) AS label")


LOGITS_SQL = """scores AS (
  SELECT vec_id, 'exam-' || vec_id AS id, label % 5 AS label,
         embedding[1:5 + vec_id % 2]::DOUBLE[] AS logits,
         5 + vec_id % 2 AS len_choices
  FROM embeddings)"""
BEST_SQL = LOGITS_SQL + """, best AS (
  SELECT *, (list_position(logits, list_max(logits)) - 1)::INTEGER AS idx FROM scores)"""
ANSWER_SQL = """CASE WHEN idx < 5 THEN (idx + 1)::VARCHAR
       WHEN idx = 5 THEN (('0x' || substr(md5('42:' || id), 1, 8))::BIGINT % 5 + 1)::VARCHAR END"""


HOURLY_REPORT_SQL = """report AS (
  SELECT user_id::VARCHAR AS run, hour, floor(event_id / 1000)::INTEGER::VARCHAR AS epoch,
         training_loss, value AS validation_loss, (event_id % 100) / 100::DOUBLE AS accuracy
  FROM (SELECT *, last_value(loss IGNORE NULLS) OVER (
                    PARTITION BY user_id ORDER BY hour, event_type = 'purchase', loss NULLS FIRST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS training_loss
        FROM (SELECT *, strftime(ts, '%Y-%m-%d %H') AS hour,
                     CASE WHEN event_type IN ('click', 'view') THEN value END AS loss FROM events))
  WHERE event_type = 'purchase')"""


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a training log: one run per user, purchases are evaluations."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS run", "ts", "event_id",
        "CASE WHEN event_type = 'purchase' THEN 'evaluate' ELSE 'log' END AS event",
        "event_id / 1000D AS epoch",
        "CASE WHEN event_type IN ('click', 'view') THEN value END AS loss",
        "CASE WHEN event_type = 'purchase' THEN value END AS eval_loss",
        "CASE WHEN event_type = 'purchase' THEN event_id % 100 / 100D END AS eval_accuracy")


REPORT_SQL = """report AS (
  SELECT user_id::VARCHAR AS run, event_id, floor(event_id / 1000)::INTEGER::VARCHAR AS epoch,
         training_loss, value AS validation_loss, (event_id % 100) / 100::DOUBLE AS accuracy
  FROM (SELECT *, last_value(CASE WHEN event_type IN ('click', 'view') THEN value END IGNORE NULLS)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS training_loss
        FROM events)
  WHERE event_type = 'purchase')"""


# --- SQL text helpers ---------------------------------------------------------------

def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_fill(template: str, **slots: str) -> str:
    """SQL concatenation of a template with SQL expressions in its slots."""
    parts = []
    for text, slot, _, _ in Formatter().parse(template):
        if text:
            parts.append(sql_text(text))
        if slot is not None:
            parts.append(f"coalesce(({slots[slot]})::VARCHAR, 'None')")
    return "(" + " || ".join(parts) + ")"


NUMBERED_SQL = """array_to_string(list_transform(choices, lambda c, i: i || ' - ' || c), chr(10))"""
WORDS_SQL = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"
