"""Prompt templates: the built-in texts or files with the same slots."""

from __future__ import annotations

from pyspark.sql import SparkSession

from examloom.fixed_values import PROMPT_PLAIN, PROMPT_WITH_MATERIAL


def read_template(spark: SparkSession, path: str) -> str:
    """Whole text of one template file (one small file, read at plan time)."""
    return spark.read.text(path, wholetext=True).first()["value"]


def prompt_templates(spark: SparkSession | None = None, plain_path: str | None = None,
                     material_path: str | None = None) -> dict[str, str]:
    """{'plain': ..., 'material': ...}; a path replaces the built-in text."""
    plain = read_template(spark, plain_path) if plain_path else PROMPT_PLAIN
    material = read_template(spark, material_path) if material_path else PROMPT_WITH_MATERIAL
    return {"plain": plain, "material": material}
