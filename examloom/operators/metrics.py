"""Accuracy and per-epoch reports.  DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from examloom.fixed_values import EPOCH_REPORT_FORMAT, REPORT_NUMBER_FORMAT
from examloom.sources.tables import stage


def accuracy(df: DataFrame, prediction: str = "prediction", reference: str = "label",
             *by: str) -> DataFrame:
    """Share of rows whose prediction equals the reference, and the row count."""
    hit = F.coalesce((F.col(prediction) == F.col(reference)).cast("double"), F.lit(0.0))
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("rows"))


def epoch_report(log: DataFrame, run: str = "run", order: tuple[str, ...] = ("step",),
                 ) -> DataFrame:
    """One row per evaluation with the training loss logged last before it.

    At one place of `order` a log comes before an evaluation; of several losses logged
    there the largest counts, so the order of the input never matters.  A log entry
    without a loss leaves the previous loss standing.  A run, or a short time of it,
    may hold a large share of all rows.  The rows are therefore
    range-partitioned by run and order into chunks of like size; each chunk starts
    from the last loss of its run's earlier chunks and is then handled on its own.
    The chunk numbers are staged, so that they stay the same wherever they are used.
    """
    logged = F.when(F.col("event") == "log", F.col("loss"))
    relevant = log.select(
        run, *order, "event", "epoch", "eval_loss", "eval_accuracy",
        logged.alias("training_loss"),
    ).filter((F.col("event") == "evaluate") | F.col("training_loss").isNotNull())
    rows = stage(
        relevant.repartitionByRange(run, *order).withColumn("_chunk", F.spark_partition_id()),
        "metric-log")

    # Last loss per chunk (null if it has none): one small row per chunk.
    logged_last = F.when(F.col("training_loss").isNotNull(), F.struct(*order, "training_loss"))
    chunks = rows.groupBy(run, "_chunk").agg(
        F.max(logged_last)["training_loss"].alias("training_loss"))
    earlier = Window.partitionBy(run).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.withColumn(
        "training_loss", F.last("training_loss", ignorenulls=True).over(earlier),
    ).filter(F.col("training_loss").isNotNull())

    # Carried rows first in their chunk; then by order, logs before evaluations.
    ranked = rows.withColumn("_rank", F.when(F.col("event") == "evaluate", 2).otherwise(1))
    seeded = ranked.unionByName(carried.withColumn("_rank", F.lit(0)), allowMissingColumns=True)
    so_far = Window.partitionBy(run, "_chunk").orderBy(
        F.col("_rank") > 0, *[F.col(c).asc_nulls_first() for c in order],
        "_rank", F.col("training_loss").asc_nulls_first(),
    ).rowsBetween(Window.unboundedPreceding, 0)
    filled = seeded.withColumn(
        "training_loss", F.last("training_loss", ignorenulls=True).over(so_far))
    return filled.filter(F.col("event") == "evaluate").select(
        run, *order,
        F.coalesce(F.col("epoch").cast("int").cast("string"), F.lit("N/A")).alias("epoch"),
        "training_loss",
        F.col("eval_loss").alias("validation_loss"),
        F.col("eval_accuracy").alias("accuracy"),
    )


def epoch_report_text(report: DataFrame, into: str = "value") -> DataFrame:
    """Add the printed block of each evaluation; missing numbers print as `None`."""
    def number(name):
        text = F.format_string(REPORT_NUMBER_FORMAT, name)
        return F.when(F.col(name).isNotNull(), text).otherwise(F.lit("None"))

    return report.withColumn(into, F.format_string(
        EPOCH_REPORT_FORMAT, "epoch", number("training_loss"), number("validation_loss"),
        number("accuracy")))
