"""Fan-out of items over models and replicate runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.functions.prompts import build_prompt


def fan_out_runs(items: DataFrame, runs: int) -> DataFrame:
    """Every row once per run 1..runs; rows stay where they are."""
    return items.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(runs))))


def fan_out_models(items: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every row once per model, with the model's place in the list."""
    listed = F.array(*[F.struct(F.lit(i).alias("model_idx"), F.lit(m).alias("model")) for i, m in enumerate(models)])
    return items.withColumn("_m", F.explode(listed)).select(*items.columns, "_m.model_idx", "_m.model")


def apply_prompt_library(items: DataFrame, prompts: Mapping[str, str], content: str = "Content") -> DataFrame:
    """Every row once per template, with the finished prompt in place of the content."""
    listed = F.array(*[F.struct(F.lit(k).alias("theme"), F.lit(t).alias("template")) for k, t in prompts.items()])
    wide = items.withColumn("_p", F.explode(listed))
    others = [c for c in items.columns if c != content]
    return wide.select(
        *others,
        F.col("_p.theme").alias("theme"),
        F.concat(F.col("_p.template"), F.lit(" "), F.col(content)).alias("prompt"),
    )


def text_tasks(items: DataFrame, template: str, content: str = "Content") -> DataFrame:
    """Add the prompt for each item."""
    return items.withColumn("prompt", build_prompt(template, F.col(content)))


def image_path(folder: str, image: Column) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), image)


def image_tasks(images: DataFrame, template: str, folder: str) -> DataFrame:
    """Add the prompt and the path; image bytes are read where the answer is made."""
    return images.select("*", F.lit(template).alias("prompt"), image_path(folder, F.col("image")).alias("path"))
