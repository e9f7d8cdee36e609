"""One registered query per operator.  Structs and arrays are flattened to scalars,
long texts are compared by digest and length, doubles are rounded to six digits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from examloom import fixed_values as fv
from examloom.functions import labels as label_fns
from examloom.functions import prompts as prompt_fns
from examloom.functions import scoring as score_fns
from examloom.functions.replies import parse_bold_reply, parse_korean_reply, valid_generation
from examloom.functions.text import bare_text
from examloom.operators import exam as ex
from examloom.operators import features, messages, metrics, replies, split
from examloom.plans import augmenting, labelling, scoring, training
from examloom.schemas import EXAM_RAW
from examloom.sources import large_csv, reports, tables, templates
from examloom.streaming import reports as streaming_reports


def digest(column, name):
    return F.md5(column).alias(name)


def joined(column="choices", name="choices"):
    return F.array_join(column, "|").alias(name)


def joined_messages():
    return F.array_join(F.transform(
        "messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")


CHOICES = "array_to_string(choices, '|') AS choices"

# --- sources and sinks ---------------------------------------------------------------


@query("s1_read_exam_csv", f"""WITH {fx.RAW_SQL}
SELECT id, md5(paragraph) AS paragraph, md5(problems) AS problems,
       md5(nullif(question_plus, '')) AS question_plus FROM raw""")
def s1(spark, sf_dir):
    path = tables.scratch_path(spark, "exam-csv")
    tables.write_csv(fx.exam_raw(spark, sf_dir).select(*EXAM_RAW.fieldNames()), path)
    back = tables.read_exam_csv(spark, path)
    return back.select("id", *[digest(F.col(c), c) for c in EXAM_RAW.fieldNames()[1:]])


@query("s1_read_large_csv", f"""WITH {fx.RAW_SQL}
SELECT id, md5(paragraph) AS paragraph, md5(problems) AS problems,
       md5(nullif(question_plus, '')) AS question_plus FROM raw""")
def s1_large(spark, sf_dir):
    path = tables.scratch_path(spark, "large-csv")
    tables.write_csv(fx.exam_raw(spark, sf_dir).select(*EXAM_RAW.fieldNames()), path)
    back = large_csv.read_large_csv(spark, path)
    return back.select("id", *[digest(F.col(c), c) for c in EXAM_RAW.fieldNames()[1:]])


@query("s2_write_table", f"""WITH {fx.EXAM_SQL}
SELECT id, md5(paragraph) AS paragraph, question, {CHOICES}, answer FROM exam""")
def s2(spark, sf_dir):
    path = tables.scratch_path(spark, "exam")
    nested = ex.drop_problem_parts(ex.nest_problems(fx.exam(spark, sf_dir)))
    tables.write_table(nested, path)
    return spark.read.schema(nested.schema).parquet(path).select(
        "id", digest(F.col("paragraph"), "paragraph"), "problems.*",
    ).withColumn("choices", F.array_join("choices", "|"))


@query("s2_write_csv_nested", f"""WITH {fx.RAW_SQL}
SELECT id, md5('{{''question'': "' || question || '", ''choices'': ' || {fx.CHOICES_LITERAL_SQL}
           || ', ''answer'': ' || answer || '}}') AS problems FROM raw""")
def s2_csv(spark, sf_dir):
    path = tables.scratch_path(spark, "exam-nested-csv")
    nested = ex.drop_problem_parts(ex.nest_problems(fx.exam(spark, sf_dir)))
    tables.write_csv(nested.select("id", "paragraph", "problems", "question_plus"), path)
    return tables.read_exam_csv(spark, path).select("id", digest(F.col("problems"), "problems"))


# Templates of a user, written as files; slots in another order, and one of them left out.
OWN_PLAIN = "Q: {question}\n{choices}\n\n{paragraph}\n"
OWN_MATERIAL = "{question_plus} / {question}\n{choices}\n"
OWN_SLOTS = {"paragraph": "paragraph", "question": "question", "question_plus": "question_plus",
             "choices": fx.NUMBERED_SQL}


@query("s3_prompt_templates", f"""WITH {fx.EXAM_SQL}
SELECT id, md5(CASE WHEN coalesce(question_plus, '') <> '' THEN {fx.sql_fill(OWN_MATERIAL, **OWN_SLOTS)}
                    ELSE {fx.sql_fill(OWN_PLAIN, **OWN_SLOTS)} END) AS prompt FROM exam""")
def s3(spark, sf_dir):
    paths = {}
    for name, text in (("plain", OWN_PLAIN), ("material", OWN_MATERIAL)):
        paths[name] = tables.scratch_path(spark, f"template-{name}")
        spark.createDataFrame([(text[:-1],)], "value string").coalesce(1).write.text(paths[name])
    own = templates.prompt_templates(spark, paths["plain"], paths["material"])
    rendered = messages.render_prompt(fx.exam(spark, sf_dir), templates=own)
    return rendered.select("id", digest(F.col("prompt"), "prompt"))


@query("s4_write_epoch_report", f"""WITH {fx.REPORT_SQL},
blocks AS (SELECT 'Epoch : ' || epoch || ',' || chr(10)
    || 'Training Loss : ' || coalesce(printf('%.6f', training_loss), 'None') || ',' || chr(10)
    || 'Validation Loss : ' || printf('%.6f', validation_loss) || ',' || chr(10)
    || 'Accuracy : ' || printf('%.6f', accuracy) || chr(10) AS block FROM report)
SELECT block FROM blocks""")
def s4(spark, sf_dir):
    path = tables.scratch_path(spark, "epoch-report")
    reports.write_epoch_report(epoch_report(spark, sf_dir), path, "run", "event_id")
    whole_blocks = spark.read.option("lineSep", "#" * 25 + "\n").text(path)
    return whole_blocks.select(F.col("value").alias("block"))


# --- projections, nesting, parsing ----------------------------------------------------


@query("p1_parse_problems", f"""WITH {fx.EXAM_SQL}, {fx.ODD_PROBLEMS_SQL}
SELECT id, question, {CHOICES}, answer, md5(question_plus) AS question_plus FROM odd""")
def p1(spark, sf_dir):
    parsed = ex.parse_problems(fx.exam_raw(spark, sf_dir, odd=True))
    return parsed.select(
        "id", "p.question", joined("p.choices"), "p.answer",
        digest(F.col("p.question_plus"), "question_plus"))


@query("p2_append_sentinel_choice", f"WITH {fx.FLAT_SQL} SELECT id, {CHOICES} FROM flat")
def p2(spark, sf_dir):
    return fx.flat_exam(spark, sf_dir).select("id", joined())


@query("p3_flatten_exam", f"""WITH {fx.FLAT_SQL}
SELECT id, md5(paragraph) AS paragraph, question, {CHOICES}, answer,
       md5(question_plus) AS question_plus FROM flat""")
def p3(spark, sf_dir):
    return ex.flatten_exam(fx.exam_raw(spark, sf_dir)).select(
        "id", digest(F.col("paragraph"), "paragraph"), "question", joined(), "answer",
        digest(F.col("question_plus"), "question_plus"))


@query("p4_nest_problems", f"""WITH {fx.EXAM_SQL}
SELECT id, question || '#' || array_to_string(choices, '|') || '#' || answer AS problems FROM exam""")
def p4(spark, sf_dir):
    nested = ex.nest_problems(fx.exam(spark, sf_dir))
    return nested.select("id", F.concat_ws(
        "#", "problems.question", F.array_join("problems.choices", "|"),
        F.col("problems.answer").cast("string")).alias("problems"))


@query("p5_drop_columns", f"""WITH {fx.EXAM_SQL}
SELECT doc_id, id, paragraph, question_plus FROM exam""")
def p5(spark, sf_dir):
    return ex.drop_problem_parts(fx.exam(spark, sf_dir).drop("source"))


@query("p6_full_question", f"""WITH {fx.EXAM_SQL}
SELECT id, coalesce(question_plus, '') AS question_plus,
       CASE WHEN coalesce(question_plus, '') = '' THEN question
            ELSE question || ' ' || question_plus END AS full_question FROM exam""")
def p6(spark, sf_dir):
    return ex.add_full_question(fx.exam(spark, sf_dir)).select(
        "id", "question_plus", "full_question")


@query("p7_question_length", f"""WITH {fx.EXAM_SQL}
SELECT id, CAST(length(question) + CASE WHEN coalesce(question_plus, '') = '' THEN 0
       ELSE 1 + length(question_plus) END AS INTEGER) AS question_length FROM exam""")
def p7(spark, sf_dir):
    return ex.add_question_length(ex.add_full_question(fx.exam(spark, sf_dir))).select(
        "id", "question_length")


@query("p8_number_choices", f"WITH {fx.FLAT_SQL} SELECT id, {fx.NUMBERED_SQL} AS choices FROM flat")
def p8(spark, sf_dir):
    return fx.flat_exam(spark, sf_dir).select(
        "id", prompt_fns.number_choices(F.col("choices")).alias("choices"))


SLOTS = {"paragraph": "paragraph", "question": "question", "question_plus": "question_plus",
         "choices": fx.NUMBERED_SQL}
PROMPT_SQL = (
    f"CASE WHEN coalesce(question_plus, '') <> '' THEN {fx.sql_fill(fv.PROMPT_WITH_MATERIAL, **SLOTS)}"
    f" ELSE {fx.sql_fill(fv.PROMPT_PLAIN, **SLOTS)} END")


@query("p9_render_prompt", f"""WITH {fx.FLAT_SQL}, prompts AS (SELECT id, {PROMPT_SQL} AS prompt FROM flat)
SELECT id, md5(prompt) AS prompt_md5, length(prompt)::INTEGER AS prompt_length FROM prompts""")
def p9(spark, sf_dir):
    return messages.render_prompt(fx.flat_exam(spark, sf_dir)).select(
        "id", digest(F.col("prompt"), "prompt_md5"), F.length("prompt").alias("prompt_length"))


SYSTEM_SQL = fx.sql_text(fv.SYSTEM_MESSAGE)


@query("p10_train_messages", f"""WITH {fx.FLAT_SQL}
SELECT id, md5('system:' || {SYSTEM_SQL} || '|user:' || {PROMPT_SQL} || '|assistant:' || answer)
       AS messages, answer AS label FROM flat""")
def p10(spark, sf_dir):
    return messages.train_messages(fx.flat_exam(spark, sf_dir)).select(
        "id", digest(joined_messages(), "messages"), "label")


@query("p11_test_messages", f"""WITH {fx.FLAT_SQL}
SELECT id, md5('system:' || {SYSTEM_SQL} || '|user:' || {PROMPT_SQL}) AS messages,
       answer AS label, len(choices)::INTEGER AS len_choices FROM flat""")
def p11(spark, sf_dir):
    return messages.test_messages(fx.flat_exam(spark, sf_dir)).select(
        "id", digest(joined_messages(), "messages"), "label", "len_choices")


CHAT_SQL = (f"{SYSTEM_SQL} || '<start_of_turn>user' || chr(10) || {PROMPT_SQL} || '<end_of_turn>'"
            " || chr(10) || '<start_of_turn>model' || chr(10) || answer || '<end_of_turn>' || chr(10)")


@query("p12_render_chat", f"""WITH {fx.FLAT_SQL}, chat AS (SELECT id, {CHAT_SQL} AS text FROM flat)
SELECT id, md5(text) AS text_md5, length(text)::INTEGER AS text_length FROM chat""")
def p12(spark, sf_dir):
    chat = messages.render_chat(messages.train_messages(fx.flat_exam(spark, sf_dir)))
    return chat.select("id", digest(F.col("text"), "text_md5"), F.length("text").alias("text_length"))


TEST_CHAT_SQL = (f"{SYSTEM_SQL} || '<start_of_turn>user' || chr(10) || {PROMPT_SQL} || '<end_of_turn>'"
                 " || chr(10) || '<start_of_turn>model' || chr(10)")


@query("p12_render_chat_test", f"""WITH {fx.FLAT_SQL}, chat AS (SELECT *, {TEST_CHAT_SQL} AS text FROM flat)
SELECT id, md5(text) AS text_md5, length(text)::INTEGER AS text_length, len(choices)::INTEGER AS len_choices
FROM chat""")
def p12_test(spark, sf_dir):
    chat = scoring.test_chat(fx.flat_exam(spark, sf_dir))
    return chat.select("id", digest(F.col("text"), "text_md5"), F.length("text").alias("text_length"), "len_choices")


# Every seventh turn has no text; conversations start at turn 3.
@query("p12_render_chat_turns", """SELECT conv_id, turn + 3 AS turn,
  CASE WHEN role = 'user' THEN '<start_of_turn>user' || chr(10) || text || '<end_of_turn>' || chr(10)
                               || '<start_of_turn>model' || chr(10)
       WHEN role = 'assistant' THEN text || '<end_of_turn>' || chr(10)
       WHEN role = 'system' AND turn = 0 THEN text ELSE '' END AS segment
FROM (SELECT * REPLACE (CASE WHEN (conv_id + turn) % 7 = 0 THEN '' ELSE text END AS text) FROM conversations)""")
def p12_turns(spark, sf_dir):
    turns = fx.table(spark, sf_dir, "conversations").withColumn(
        "text", F.when((F.col("conv_id") + F.col("turn")) % 7 != 0, F.col("text"))).withColumn(
        "turn", F.col("turn") + 3)
    return messages.render_chat_turns(turns).select("conv_id", "turn", "segment")


LIST_SLOTS = {"paragraph": "paragraph", "question": "question", "answer": "answer",
              "choices": fx.CHOICES_LITERAL_SQL}


@query("p13_label_prompt", f"""WITH {fx.EXAM_SQL}
SELECT id, md5({fx.sql_text(fv.LABEL_SYSTEM_PROMPT)} || {fx.sql_fill(
    fv.LABEL_USER_PROMPT, question_plus="coalesce(question_plus, 'nan')", **LIST_SLOTS)})
    AS prompt FROM exam""")
def p13(spark, sf_dir):
    return messages.label_prompt(fx.exam(spark, sf_dir)).select(
        "id", digest(F.concat("label_prompt.system", "label_prompt.user"), "prompt"))


@query("p14_generation_prompt_en", f"""WITH {fx.EXAM_SQL}
SELECT id, md5({fx.sql_fill(fv.GENERATION_PROMPT_EN, example=fx.sql_text(fv.GENERATION_EXAMPLE),
                            **LIST_SLOTS)}) AS prompt FROM exam""")
def p14(spark, sf_dir):
    return messages.generation_prompt_en(fx.exam(spark, sf_dir)).select(
        "id", digest(F.col("generation_prompt"), "prompt"))


@query("p15_generation_prompt_ko", f"""WITH {fx.EXAM_SQL}
SELECT id, md5('system:' || {fx.sql_text(fv.GENERATION_SYSTEM_KO)} || '|user:' ||
           {fx.sql_fill(fv.GENERATION_USER_KO, **LIST_SLOTS)}) AS messages FROM exam""")
def p15(spark, sf_dir):
    asked = messages.generation_prompt_ko(fx.exam(spark, sf_dir))
    return asked.select("id", F.col("generation_messages").alias("messages")).select(
        "id", digest(joined_messages(), "messages"))


@query("p16_make_augmented_row", f"""WITH {fx.EXAM_SQL}
SELECT id || '_aug' AS id, md5(paragraph) AS paragraph, question, {CHOICES}, answer,
       '' AS question_plus FROM exam""")
def p16(spark, sf_dir):
    rows = ex.make_augmented_rows(fx.exam(spark, sf_dir))
    return rows.select(
        "id", digest(F.col("paragraph"), "paragraph"), "problems.question",
        joined("problems.choices"), "problems.answer", "question_plus")


# --- filters ----------------------------------------------------------------------------


def labelled(spark, sf_dir):
    """Every document with the labels its reply text holds, cleaned."""
    docs = fx.table(spark, sf_dir, "documents")
    raw = docs.select("doc_id", F.inline(F.array(label_fns.parse_label_reply(
        F.expr(fx.label_reply_text())))))
    return raw.select(
        "doc_id", "topic", F.col("prior_knowledge_needed").alias("prior"),
        label_fns.clean_topic(F.col("topic")).alias("clean"),
        label_fns.normalize_prior_knowledge(F.col("prior_knowledge_needed")).alias(
            "prior_knowledge_needed"))


@query("f1_filter_no_prior_knowledge", f"""WITH {fx.LABELS_SQL}
SELECT doc_id, topic FROM labelled WHERE prior = '필요 없음'""")
def f1(spark, sf_dir):
    return ex.filter_no_prior_knowledge(labelled(spark, sf_dir)).select(
        "doc_id", F.col("clean").alias("topic"))


@query("f2_filter_min_length", f"""WITH {fx.EXAM_SQL}
SELECT id, md5(paragraph) AS paragraph FROM exam WHERE length(paragraph) > 286""")
def f2(spark, sf_dir):
    return ex.filter_min_length(fx.exam(spark, sf_dir)).select(
        "id", digest(F.col("paragraph"), "paragraph"))


@query("f3_filter_max_tokens", f"""SELECT doc_id, len({fx.WORDS_SQL.format('text')})::INTEGER AS token_count
FROM documents WHERE len({fx.WORDS_SQL.format('text')}) <= 1024""")
def f3(spark, sf_dir):
    counted = features.add_token_count(fx.table(spark, sf_dir, "documents"))
    return ex.filter_max_tokens(counted).select("doc_id", "token_count")


@query("f4_valid_generation", f"""WITH {fx.BOLD_SQL}, {fx.KOREAN_SQL}
SELECT id, 'bold' AS source, 1 AS attempt, valid FROM bold
UNION ALL SELECT id, 'korean', attempt, valid FROM korean""")
def f4(spark, sf_dir):
    bold = fx.bold_replies(spark, sf_dir).withColumn(
        "valid", valid_generation(parse_bold_reply(F.col("text"))))
    korean = fx.korean_replies(spark, sf_dir).withColumn(
        "valid", valid_generation(parse_korean_reply(F.col("text")), fv.OPTION_COUNT))
    return ex.merge_sources(bold, korean).select("id", "source", "attempt", "valid")


@query("f5_quarantine", f"""WITH {fx.EXAM_SQL}, {fx.ODD_PROBLEMS_SQL}
SELECT id, reason, reason IS NULL AS kept FROM odd""")
def f5(spark, sf_dir):
    parsed = ex.parse_problems(fx.exam_raw(spark, sf_dir, odd=True)).select("id", "p")
    flagged = tables.stage(parsed.select(
        "id", F.when(F.col("p").isNull(), F.lit("unreadable problem")).alias("reason")), "flagged")
    good, bad = ex.quarantine(flagged)
    return ex.merge_sources(
        good.withColumn("kept", F.lit(True)), bad.withColumn("kept", F.lit(False)),
    ).select("id", "reason", "kept")


# --- text cleaning and reply parsing ------------------------------------------------------


@query("t1_clean_topic", f"WITH {fx.LABELS_SQL} SELECT doc_id, topic FROM labelled")
def t1(spark, sf_dir):
    return labelled(spark, sf_dir).select("doc_id", F.col("clean").alias("topic"))


@query("t2_normalize_prior_knowledge", f"WITH {fx.LABELS_SQL} SELECT doc_id, prior FROM labelled")
def t2(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "doc_id", F.col("prior_knowledge_needed").alias("prior"))


MIXED_ID_SPARK = """CASE doc_id % 3 WHEN 0 THEN concat('exam-', doc_id)
    WHEN 1 THEN concat(source, '-', doc_id) ELSE lang END"""
MIXED_ID_SQL = """CASE doc_id % 3 WHEN 0 THEN 'exam-' || doc_id
    WHEN 1 THEN source || '-' || doc_id ELSE lang END"""


@query("t3_extract_id_number", f"""WITH ids AS (SELECT doc_id, {MIXED_ID_SQL} AS id FROM documents)
SELECT doc_id, id, TRY_CAST(nullif(regexp_extract(id, '[0-9]+'), '') AS DOUBLE) AS id_number,
       regexp_extract(id, '[0-9]+') = '' AS is_infinite FROM ids""")
def t3(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "documents").select("doc_id", F.expr(MIXED_ID_SPARK).alias("id"))
    number = label_fns.id_number(F.col("id"))
    infinite = number == float("inf")
    return ids.select("doc_id", "id", F.when(~infinite, number).alias("id_number"),
                      infinite.alias("is_infinite"))


@query("t4_clean_text", r"""SELECT doc_id,
  replace(regexp_replace('(Note ' || lang || ') **' || source || '** ' || text,
          '\([A-Za-z\s]*\)', '', 'g'), '*', '') AS text FROM documents""")
def t4(spark, sf_dir):
    marked = F.concat(F.lit("(Note "), "lang", F.lit(") **"), "source", F.lit("** "), "text")
    return fx.table(spark, sf_dir, "documents").select("doc_id", bare_text(marked).alias("text"))


@query("t5_parse_label_response", f"""WITH {fx.LABELS_SQL}
SELECT doc_id, raw_topic AS topic, raw_prior AS prior FROM labelled""")
def t5(spark, sf_dir):
    return labelled(spark, sf_dir).select("doc_id", "topic", "prior")


@query("t6_parse_generation_bold", f"""WITH {fx.BOLD_SQL}
SELECT id, question, {CHOICES}, answer FROM bold""")
def t6(spark, sf_dir):
    parsed = replies.parse_generation_bold(fx.bold_replies(spark, sf_dir))
    return parsed.select("id", "parsed.question", joined("parsed.choices"), "parsed.answer")


@query("t7_parse_generation_ko", f"""WITH {fx.KOREAN_SQL}
SELECT id, attempt, question, {CHOICES}, answer FROM korean""")
def t7(spark, sf_dir):
    parsed = replies.parse_generation_ko(fx.korean_replies(spark, sf_dir))
    return parsed.select(
        "id", "attempt", "parsed.question", joined("parsed.choices"), "parsed.answer")


@query("t8_first_valid_attempt", f"""WITH {fx.KOREAN_SQL}
SELECT id, min(attempt)::INTEGER AS attempt, arg_min(question, attempt) AS question,
       arg_min(answer, attempt) AS answer FROM korean WHERE valid GROUP BY id""")
def t8(spark, sf_dir):
    return replies.first_valid_attempt(fx.korean_replies(spark, sf_dir)).select(
        "id", "attempt", "question", "answer")


# Chat turns without a user turn hold no marker.
@query("t9_completion_split", """SELECT conv_id, turn,
  CASE WHEN role = 'user' THEN chr(10) || lang END AS completion
FROM (SELECT *, role || '!' AS lang FROM conversations)""")
def t9(spark, sf_dir):
    turns = messages.render_chat_turns(fx.table(spark, sf_dir, "conversations"), first_turn=0)
    text = F.concat("segment", "role", F.lit("!"))
    return turns.select("conv_id", "turn", label_fns.completion_text(text).alias("completion"))


# Turns of a user once, of an assistant behind two user turns, of others without a marker.
MARKED_SQL = f"""marked AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN u || text || ' end' WHEN 'assistant' THEN u || lang || u || text
                             ELSE text END AS text
  FROM (SELECT conv_id, turn, role, coalesce(text, '') AS text, 'go on' AS lang,
               '<start_of_turn>user x<end_of_turn>' || chr(10) || '<start_of_turn>model ' AS u FROM conversations)),
words AS (SELECT conv_id, turn, {fx.WORDS_SQL.format('text')} AS w FROM marked),
vocabulary AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) AS token_id
               FROM (SELECT unnest(w) AS term FROM words) GROUP BY term)"""


def marked_turns(spark, sf_dir):
    user = f"<start_of_turn>user x{fv.TURN_END}\n{fv.MODEL_TURN} "
    text = F.coalesce("text", F.lit(""))
    return fx.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "user", F.concat(F.lit(user), text, F.lit(" end"))).when(
            F.col("role") == "assistant", F.concat(F.lit(user + "go on" + user), text)).otherwise(text).alias("text"))


@query("t9_token_labels", f"""WITH {MARKED_SQL},
places AS (SELECT conv_id, turn, w, list_max(list_filter(range(1, len(w)), lambda i:
             w[i] = 'start_of_turn' AND w[i + 1] = 'model')) + 1 AS marker_end FROM words),
tokens AS (SELECT conv_id, turn, unnest(w) AS term, generate_subscripts(w, 1) AS pos, coalesce(marker_end, 1000000000) AS marker_end
           FROM places),
coded AS (SELECT conv_id, turn, md5(string_agg(token_id::VARCHAR, ',' ORDER BY pos)) AS input_ids,
            md5(string_agg(CASE WHEN pos > marker_end THEN token_id ELSE -100 END::VARCHAR, ',' ORDER BY pos)) AS labels,
            count(*) FILTER (pos > marker_end)::INTEGER AS trained
          FROM tokens JOIN vocabulary USING (term) GROUP BY conv_id, turn)
SELECT conv_id, turn, coalesce(input_ids, md5('')) AS input_ids, coalesce(labels, md5('')) AS labels,
       coalesce(trained, 0) AS trained FROM marked LEFT JOIN coded USING (conv_id, turn)""")
def t9_labels(spark, sf_dir):
    coded, ids = features.tokenize_with_ids(marked_turns(spark, sf_dir), "conv_id", "turn")
    rows = features.add_completion_labels(coded, ids)
    return rows.select(
        "conv_id", "turn", *[digest(F.array_join(F.col(c).cast("array<string>"), ","), c) for c in ("input_ids", "labels")],
        F.size(F.filter("labels", lambda x: x != fv.IGNORED)).alias("trained"))


@query("t10_decode_ids", f"""SELECT doc_id, md5(array_to_string({fx.WORDS_SQL.format('text')}, ' ')) AS text,
  len({fx.WORDS_SQL.format('text')})::INTEGER AS words FROM documents""")
def t10_ids(spark, sf_dir):
    coded, ids = features.tokenize_with_ids(fx.table(spark, sf_dir, "documents"), "doc_id")
    padded = coded.select("doc_id", F.flatten(F.array(  # ignored and padding places around and between the ids
        F.array(F.lit(fv.IGNORED), F.lit(0)), F.flatten(F.transform("input_ids", lambda x: F.array(x, F.lit(fv.IGNORED)))),
        F.array(F.lit(0)))).alias("input_ids"))
    text = features.detokenize(padded, ids, "doc_id")
    return text.select("doc_id", digest(F.col("text"), "text"),
                       F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", " "))).alias("words"))


# The trained ids of a turn decoded: an option's number, or a reject.
@query("t10_decode_label_ids", """SELECT conv_id, turn,
  CASE WHEN (conv_id + turn) % 8 BETWEEN 1 AND 5 THEN (conv_id + turn) % 8 - 1 END::INTEGER AS option,
  (conv_id + turn) % 8 NOT BETWEEN 1 AND 5 AS rejected FROM conversations""")
def t10_label_ids(spark, sf_dir):
    answer = ((F.col("conv_id") + F.col("turn")) % 8).cast("string")
    turns = fx.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(F.coalesce("text", F.lit("")), F.lit(f" {fv.MODEL_TURN} "), answer, F.lit(f" {fv.TURN_END}")).alias("text"))
    coded, ids = features.tokenize_with_ids(turns, "conv_id", "turn", split=F.split("text", r"\s+"))
    rows = features.add_completion_labels(coded, ids, marker=[fv.MODEL_TURN])
    decoded, rejected = replies.decode_labels(features.detokenize(rows, ids, "conv_id", "turn", input_ids="labels"))
    return ex.merge_sources(
        decoded.withColumn("rejected", F.lit(False)), rejected.withColumn("rejected", F.lit(True)),
    ).select("conv_id", "turn", "option", "rejected")


@query("t10_decode_label", """SELECT vec_id, label,
  CASE WHEN label BETWEEN 1 AND 5 THEN label - 1 END::INTEGER AS option, label NOT BETWEEN 1 AND 5 AS rejected
FROM embeddings""")
def t10(spark, sf_dir):
    text = F.concat(F.lit(" \n"), F.col("label").cast("string"),
                    F.lit(f"\u3000{fv.TURN_END}\n9{fv.TURN_END}"))
    decoded, rejected = replies.decode_labels(
        fx.table(spark, sf_dir, "embeddings").select("vec_id", "label", text.alias("text")))
    return ex.merge_sources(
        decoded.withColumn("rejected", F.lit(False)), rejected.withColumn("rejected", F.lit(True)),
    ).select("vec_id", "label", "option", "rejected")


@query("t11_token_count", f"""SELECT doc_id, len({fx.WORDS_SQL.format('text')})::INTEGER AS token_count
FROM documents""")
def t11_count(spark, sf_dir):
    return features.add_token_count(fx.table(spark, sf_dir, "documents")).select(
        "doc_id", "token_count")


@query("t11_tokenize", f"""WITH tokens AS (
  SELECT doc_id, unnest(words) AS term, generate_subscripts(words, 1) AS pos
  FROM (SELECT doc_id, {fx.WORDS_SQL.format('text')} AS words FROM documents)),
ranked AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) AS token_id
           FROM tokens GROUP BY term),
coded AS (SELECT doc_id, string_agg(token_id::VARCHAR, ',' ORDER BY pos) AS ids, count(*)::INTEGER AS n
          FROM tokens JOIN ranked USING (term) GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(ids, '')) AS input_ids, coalesce(n, 0) AS attended
FROM documents d LEFT JOIN coded USING (doc_id)""")
def t11(spark, sf_dir):
    coded = features.tokenize(fx.table(spark, sf_dir, "documents"), "doc_id")
    return coded.select(
        "doc_id", digest(F.array_join(F.col("input_ids").cast("array<string>"), ","), "input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("attended"))


# --- aggregation and features -------------------------------------------------------------

TOKENS_SQL = f"""tokens AS (SELECT doc_id, unnest({fx.WORDS_SQL.format('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term),
vocab AS (SELECT term, sum(tf)::BIGINT AS cf, count(*) AS df FROM tf GROUP BY term
          ORDER BY cf DESC, term LIMIT 1000)"""


@query("a1_tfidf", f"""WITH {TOKENS_SQL},
weighted AS (SELECT doc_id, term,
    tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1) AS w
  FROM tf JOIN vocab USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM weighted""")
def a1(spark, sf_dir):
    rows = features.tfidf(fx.table(spark, sf_dir, "documents"), "doc_id", text="text")
    return rows.withColumn("tfidf", F.round("tfidf", 6))


@query("a2_vocabulary", f"WITH {TOKENS_SQL} SELECT term, cf, df FROM vocab ORDER BY term")
def a2(spark, sf_dir):
    return features.vocabulary(fx.table(spark, sf_dir, "documents"), "text")


@query("a3_accuracy", f"""WITH {fx.BEST_SQL}
SELECT round(avg((idx = label)::INTEGER), 6) AS accuracy, count(*) AS rows FROM best""")
def a3(spark, sf_dir):
    scored = fx.logits(spark, sf_dir).select("label", predicted_index().alias("prediction"))
    return metrics.accuracy(scored).withColumn("accuracy", F.round("accuracy", 6))


def epoch_report(spark, sf_dir):
    return metrics.epoch_report(fx.metric_log(spark, sf_dir), order=("ts", "event_id"))


# By the hour, logs and evaluations share their place: the logs count first.
@query("a4_epoch_report", f"WITH {fx.HOURLY_REPORT_SQL} SELECT * FROM report")
def a4(spark, sf_dir):
    log = fx.metric_log(spark, sf_dir).withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    return metrics.epoch_report(log, order=("hour",))


# The log in three pieces, fed one by one; the second query goes on where the first one stopped.
@query("a4_stream_epoch_report", f"""WITH {fx.REPORT_SQL}
SELECT run, event_id, epoch, training_loss, validation_loss, accuracy FROM report""")
def a4_stream(spark, sf_dir):
    log = fx.metric_log(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    pieces, out, checkpoint = (tables.scratch_path(spark, name) for name in ("log-pieces", "stream-report", "stream-state"))
    cuts = log.select(F.unix_seconds("ts").alias("s")).agg(F.percentile("s", F.array(F.lit(1 / 3), F.lit(2 / 3)))).first()[0]
    part = F.when(F.unix_seconds("ts") <= cuts[0], 0).when(F.unix_seconds("ts") <= cuts[1], 1).otherwise(2)
    for piece in range(3):
        log.filter(part == piece).write.mode("append").parquet(pieces)
        events = spark.readStream.schema(log.schema).parquet(pieces)
        report = streaming_reports.stream_epoch_report(events, order=("ts", "event_id"))
        report.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start(out).awaitTermination()
    return spark.read.schema(report.schema).parquet(out).drop("ts")


# --- scoring --------------------------------------------------------------------------------


def option_scores():
    return score_fns.option_logits(F.col("logits"), F.col("len_choices"))


def predicted_index():
    return score_fns.argmax(score_fns.softmax(option_scores()))


def six_digits(x):
    """As DuckDB rounds: what is negative stays so, even where only -0.0 is left of it."""
    return F.signum(x) * F.round(F.abs(x), 6)


def rounded(array):
    return F.array_join(F.transform(
        array, lambda x: F.format_string("%.6f", six_digits(x))), ",")


@query("m1_option_logits", f"""WITH {fx.LOGITS_SQL}
SELECT vec_id, array_to_string(list_transform(logits, lambda x: printf('%.6f', round(x, 6))), ',')
       AS logits FROM scores""")
def m1(spark, sf_dir):
    return fx.logits(spark, sf_dir).select("vec_id", rounded(option_scores()).alias("logits"))


@query("m1_logits_at", """SELECT vec_id, round(embedding[11]::DOUBLE, 6) AS a,
  round(embedding[len(embedding)]::DOUBLE, 6) AS b FROM embeddings""")
def m1_at(spark, sf_dir):
    picked = score_fns.logits_at(
        F.col("logits"), F.array(F.lit(10), F.size("logits") - 1))
    return fx.logits(spark, sf_dir).select("vec_id", picked.alias("p")).select(
        "vec_id", six_digits(F.get("p", F.lit(0))).alias("a"),
        six_digits(F.get("p", F.lit(1))).alias("b"))


# Scores of three to six places, the last ones padding; one row has no place at all.
@query("m1_sequence_logits", """WITH s AS (SELECT vec_id, embedding::DOUBLE[] AS e, vec_id % 5 AS n FROM embeddings)
SELECT vec_id, CASE WHEN n >= 1 THEN printf('%.6f,%.6f', round(e[3] + n - 1, 6), round(e[5] + n - 1, 6)) END AS last,
  CASE WHEN n >= 2 THEN printf('%.6f,%.6f', round(e[3] + n - 2, 6), round(e[5] + n - 2, 6)) END AS second FROM s""")
def m1_sequence(spark, sf_dir):
    n = (F.col("vec_id") % 5).cast("int")
    places = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda p: F.transform("logits", lambda x: x + p))
    mask = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda p: F.when(p < n, 1).otherwise(0))
    rows = fx.logits(spark, sf_dir).select("vec_id", places.alias("logits"), mask.alias("attention_mask"))
    options = F.array(F.lit(2), F.lit(4))

    def scores(from_end):
        found = score_fns.sequence_logits(F.col("logits"), F.col("attention_mask"), options, from_end)
        return F.when(found.isNotNull(), rounded(found))

    return rows.select("vec_id", scores(1).alias("last"), scores(2).alias("second"))


@query("m2_softmax", f"""WITH {fx.LOGITS_SQL},
parts AS (SELECT vec_id, unnest(logits) AS x, generate_subscripts(logits, 1) AS option FROM scores)
SELECT vec_id, (option - 1)::INTEGER AS option,
       round(exp(x) / sum(exp(x)) OVER (PARTITION BY vec_id), 6) AS probability FROM parts""")
def m2(spark, sf_dir):
    probabilities = score_fns.softmax(option_scores())
    return fx.logits(spark, sf_dir).select(
        "vec_id", F.posexplode(probabilities).alias("option", "probability"),
    ).withColumn("probability", F.round("probability", 6))


@query("m3_argmax", f"WITH {fx.BEST_SQL} SELECT vec_id, idx FROM best")
def m3(spark, sf_dir):
    return fx.logits(spark, sf_dir).select("vec_id", predicted_index().alias("idx"))


@query("m4_predict_answer", f"WITH {fx.BEST_SQL} SELECT id, {fx.ANSWER_SQL} AS answer FROM best")
def m4(spark, sf_dir):
    answer = score_fns.predict_answer(predicted_index(), F.col("id"))
    return fx.logits(spark, sf_dir).select("id", answer.alias("answer"))


# --- order, limit, union, split ----------------------------------------------------------------


@query("o1_sort_by_id_number", f"""WITH ids AS (SELECT doc_id, {MIXED_ID_SQL} AS id FROM documents),
keyed AS (SELECT *, TRY_CAST(nullif(regexp_extract(id, '[0-9]+'), '') AS BIGINT) AS n FROM ids)
SELECT id, row_number() OVER (ORDER BY n NULLS LAST, id) - 1 AS position FROM keyed""")
def o1(spark, sf_dir):
    """The position that each row has in the output: range partitions in order, then rows."""
    ids = fx.table(spark, sf_dir, "documents").select("doc_id", F.expr(MIXED_ID_SPARK).alias("id"))
    placed = tables.stage(ex.sort_by_id_number(ids).select(
        "id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "sorted")
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("part", before.alias("before")))  # one row per range
    in_part = F.col("place") - F.shiftleft(F.col("part").cast("long"), 33)
    return placed.join(starts, "part").select("id", (F.col("before") + in_part).alias("position"))


@query("o2_preview", f"WITH {fx.EXAM_SQL} SELECT id, question, answer FROM exam ORDER BY id LIMIT 5")
def o2(spark, sf_dir):
    return ex.preview(fx.exam(spark, sf_dir).select("id", "question", "answer"), "id")


@query("u1_merge_sources", f"""WITH {fx.EXAM_SQL}
SELECT id, md5(paragraph) AS paragraph, question, question_plus FROM exam
UNION ALL BY NAME SELECT id || '_aug' AS id, question, md5(paragraph) AS paragraph FROM exam""")
def u1(spark, sf_dir):
    rows = fx.exam(spark, sf_dir).select(
        "id", digest(F.col("paragraph"), "paragraph"), "question", "question_plus")
    new = rows.select(F.concat("id", F.lit("_aug")).alias("id"), "question", "paragraph")
    return ex.merge_sources(rows, new)


SPLIT_SQL = """row_number() OVER (ORDER BY md5('42:' || {id})) <=
       (SELECT ceil(0.1::DOUBLE * count(*)) FROM {rows}) AS is_eval"""


@query("x1_train_eval_split", f"SELECT doc_id, {SPLIT_SQL.format(id='doc_id', rows='documents')} FROM documents")
def x1(spark, sf_dir):
    return split.assign_split(
        fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "is_eval")


# --- compositions --------------------------------------------------------------------------------


@query("w1_label_exam", f"""WITH {fx.EXAM_SQL}, {fx.LABELS_SQL}
SELECT id, CASE WHEN r.doc_id IS NOT NULL THEN topic END AS topic,
       CASE WHEN r.doc_id IS NOT NULL THEN prior END AS prior_knowledge_needed,
       md5(paragraph) AS paragraph, CASE WHEN r.doc_id IS NOT NULL THEN answer END AS answer,
       CASE WHEN r.doc_id IS NULL THEN 'no reply' END AS reason
FROM exam JOIN labelled USING (doc_id) LEFT JOIN (SELECT DISTINCT doc_id FROM labels) r USING (doc_id)""")
def w1(spark, sf_dir):
    _, cleaned, rejected = labelling.label_exam(
        fx.exam_raw(spark, sf_dir), fx.label_replies(spark, sf_dir))
    return ex.merge_sources(
        cleaned.select("id", "topic", "prior_knowledge_needed", "paragraph", "answer"), rejected,
    ).withColumn("paragraph", F.md5("paragraph"))


def sources(spark, sf_dir):
    """Questions of documents whose reply says that no prior knowledge is needed."""
    rows = fx.exam(spark, sf_dir).withColumn("text", F.col("paragraph"))
    parsed = rows.select("*", F.inline(F.array(label_fns.parse_label_reply(
        F.expr(fx.label_reply_text())))))
    prior = label_fns.normalize_prior_knowledge(F.col("prior_knowledge_needed"))
    labelled_rows = parsed.withColumn("prior_knowledge_needed", prior).select(
        "id", "topic", "prior_knowledge_needed", "paragraph", "question", "choices", "answer",
        "question_plus")
    return tables.stage(augmenting.select_sources(labelled_rows), "sources")


def both_replies(spark, sf_dir):
    return ex.merge_sources(fx.bold_replies(spark, sf_dir), fx.korean_replies(spark, sf_dir))


AUGMENTED_SQL = f"""{fx.EXAM_SQL}, {fx.LABELS_SQL}, {fx.BOLD_SQL}, {fx.KOREAN_SQL},
picked AS (SELECT e.* FROM exam e JOIN labelled USING (doc_id) WHERE prior = '필요 없음'),
made AS (
  SELECT 'bold' AS variant, p.id, b.question, b.choices, b.answer, paragraph
  FROM picked p LEFT JOIN bold b ON p.id = b.id AND valid
  UNION ALL
  SELECT 'korean', p.id, k.question, k.choices, k.answer, paragraph
  FROM picked p LEFT JOIN korean k ON p.id = k.id AND valid)"""


@query("w2_augment", f"""WITH {AUGMENTED_SQL}
SELECT variant, CASE WHEN answer IS NULL THEN id ELSE id || '_aug' END AS id,
       md5(paragraph) AS paragraph, question, {CHOICES}, answer FROM made""")
def w2(spark, sf_dir):
    rows = []
    made = augmenting.augment_all(sources(spark, sf_dir), both_replies(spark, sf_dir))
    for variant, (new, failed) in made.items():
        rows.append(new.select("id", "paragraph", "problems.*"))
        rows.append(failed.select("id", "paragraph"))
        rows[-2:] = [r.withColumn("variant", F.lit(variant)) for r in rows[-2:]]
    return ex.merge_sources(*rows).select(
        "variant", "id", digest(F.col("paragraph"), "paragraph"), "question", joined(), "answer")


@query("w3_build_train_final", f"""WITH {AUGMENTED_SQL}
SELECT id, md5(paragraph) AS paragraph, question, answer, md5(question_plus) AS question_plus
FROM exam WHERE length(paragraph) > 286
UNION ALL
SELECT id || '_aug', md5(paragraph), question, answer, md5('')
FROM made WHERE answer IS NOT NULL AND length(paragraph) > 286""")
def w3(spark, sf_dir):
    train = ex.nest_problems(fx.exam(spark, sf_dir)).select(
        "id", "paragraph", "problems", "question_plus")
    made = augmenting.augment_all(sources(spark, sf_dir), both_replies(spark, sf_dir))
    final = augmenting.build_train_table(train, *[new for new, _ in made.values()])
    return final.select(
        "id", digest(F.col("paragraph"), "paragraph"), "problems.question", "problems.answer",
        digest(F.col("question_plus"), "question_plus"))


@query("w4_build_train_eval", f"""WITH {fx.FLAT_SQL}, chat AS (SELECT id, answer, {CHAT_SQL} AS text FROM flat),
kept AS (SELECT *, len({fx.WORDS_SQL.format('text')})::INTEGER AS token_count FROM chat
         WHERE len({fx.WORDS_SQL.format('text')}) <= 1024),
tokens AS (SELECT id, unnest(words) AS term, generate_subscripts(words, 1) AS pos
           FROM (SELECT id, {fx.WORDS_SQL.format('text')} AS words FROM kept)),
ranked AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) AS token_id FROM tokens GROUP BY term),
coded AS (SELECT id, md5(string_agg(token_id::VARCHAR, ',' ORDER BY pos)) AS input_ids
          FROM tokens JOIN ranked USING (term) GROUP BY id)
SELECT id, md5(text) AS text_md5, answer AS label, input_ids, token_count AS attended,
       {SPLIT_SQL.format(id='id', rows='kept')} FROM kept JOIN coded USING (id)""")
def w4(spark, sf_dir):
    exam = ex.flatten_exam(fx.exam_raw(spark, sf_dir))
    rows = training.build_train_eval(training.exam_features(exam))
    return rows.select(
        "id", digest(F.col("text"), "text_md5"), "label",
        digest(F.array_join(F.col("input_ids").cast("array<string>"), ","), "input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("attended"), "is_eval")


@query("w5_score_test", f"""WITH {fx.FLAT_SQL}, {fx.LOGITS_SQL.replace(
    '5 + vec_id % 2 AS len_choices', '5 AS len_choices').replace(
    'embedding[1:5 + vec_id % 2]', 'embedding')},
best AS (SELECT flat.id, (list_position(logits[1:len(choices)], list_max(logits[1:len(choices)])) - 1)
                ::INTEGER AS idx FROM flat LEFT JOIN scores USING (id))
SELECT id, {fx.ANSWER_SQL} AS answer FROM best""")
def w5(spark, sf_dir):
    exam = ex.flatten_exam(fx.exam_raw(spark, sf_dir))
    logits = fx.logits(spark, sf_dir).select("id", "logits")
    # Every id once more with larger scores: the least row of an id counts.
    more = logits.withColumn("logits", F.transform("logits", lambda x: x + 1))
    return scoring.score_test(exam, more.unionByName(logits))
