"""Schemas of the tables that cross a file boundary.  Nothing is inferred."""

from pyspark.sql import types as T

PROBLEMS = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("choices", T.ArrayType(T.StringType())),
    T.StructField("answer", T.LongType()),
    T.StructField("question_plus", T.StringType()),
])

# Exam CSV: `problems` holds the text of a Python dict.
EXAM_RAW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("paragraph", T.StringType()),
    T.StructField("problems", T.StringType()),
    T.StructField("question_plus", T.StringType()),
])

# Labelled questions, flat; `choices` holds the text of a Python list.
CLASSIFIED_CSV = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("prior_knowledge_needed", T.StringType()),
    T.StructField("paragraph", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("choices", T.StringType()),
    T.StructField("answer", T.LongType()),
    T.StructField("question_plus", T.StringType()),
])

# One model reply per question, generator and attempt.
RESPONSES = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

METRIC_LOG = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("step", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("epoch", T.DoubleType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("eval_loss", T.DoubleType()),
    T.StructField("eval_accuracy", T.DoubleType()),
])
