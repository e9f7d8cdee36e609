from pyspark.sql import functions as F


def evaluate(spark, make_column, values, dtype="string"):
    """Apply a Column -> Column function to a list of values, in order."""
    rows = spark.createDataFrame(
        list(enumerate(values)), f"n int, x {dtype}").select(
        "n", make_column(F.col("x")).alias("y")).orderBy("n").collect()
    return [r["y"] for r in rows]


def plan(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)

