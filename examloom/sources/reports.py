"""Epoch reports as text files."""

from pyspark.sql import DataFrame

from examloom.operators.metrics import epoch_report_text


def write_epoch_report(report: DataFrame, path: str, *order: str) -> None:
    """Append one text block per evaluation, in the given order."""
    blocks = epoch_report_text(report).orderBy(*order).select("value")
    blocks.write.mode("append").text(path)
