"""Answers graded by a judge model, and models compared by their grades."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replivote.operators.annotate import annotate
from replivote.operators.inference import f_tail

#: What a judge is asked when nothing else is stated.
TEMPLATE = "Grade how well the response answers the prompt, from 1 (not at all) to 10 (fully). Reply with the number only."


def grade_prompt(asked: Column, response: Column, template: str = TEMPLATE) -> Column:
    """The judge's prompt for one answer; null where there is no answer."""
    return F.concat(F.lit(f"{template}\n\nPrompt: "), F.coalesce(asked, F.lit("")), F.lit("\n\nResponse: "), response)


def grade_of(reply: Column, low: float = 1, high: float = 10) -> Column:
    """The first number of a reply, null if there is none or it is out of range."""
    number = F.regexp_extract(reply, r"-?[0-9]+(?:\.[0-9]+)?", 0)
    value = F.when(number != "", number.try_cast("double"))
    return F.when(value.between(low, high), value)


def graded(answers: DataFrame, asked: Column, judge: str, open_responder: Callable, *, response: str = "response", status: str = "status", key: str, template: str = TEMPLATE) -> DataFrame:
    """``answers`` with ``grade``: a second annotation, by one judge, of every answer that is no error or blank.

    ``key`` names a column that tells rows apart for the judge. The judge's failures and replies
    without a number in range give a null grade.
    """
    able = (F.col(status) == "ok") & (F.trim(response) != "")
    tasks = answers.withColumn("_prompt", F.when(able, grade_prompt(asked, F.col(response), template)))
    replied = annotate(tasks, [judge], 1, open_responder, key=key, prompt="_prompt")
    grade = F.when(~F.col("failed")[0], grade_of(F.col("answers")[0]))
    return replied.withColumn("grade", grade).drop("_prompt", "answers", "failed")


def ranked_grades(grades: DataFrame, item: str, model: str = "model", grade: str = "grade", models: int | None = None) -> DataFrame:
    """``item, model, grade, place, ties``: mean grade of each model's answers to an item, ranked within the item.

    The lowest grade has place 1; equal grades share the mean of their places, and ``ties`` is
    ``t³ - t`` for ``t`` equal ones, spread over them. Only items that all models have a grade for count;
    how many models there are is counted, unless stated. Grades are read several times, so write them first.
    """
    mean = grades.where(F.col(grade).isNotNull()).groupBy(item, model).agg(F.avg(grade).alias("grade"))
    models = mean.select(model).distinct().count() if models is None else models
    within, equal = Window.partitionBy(item), Window.partitionBy(item, "grade")
    whole = mean.withColumn("_of", F.count("*").over(within)).where(F.col("_of") == models)
    same = F.count("*").over(equal)
    place = F.rank().over(within.orderBy("grade")) + (same - 1) / 2
    return whole.select(item, model, "grade", place.alias("place"), (same * same - 1).alias("ties"))


def friedman(ranks: DataFrame, model: str = "model") -> DataFrame:
    """One row: ``items, models, chi_squared, f, df_between, df_within, p`` for no difference between models.

    The chi-squared statistic is corrected for ties; ``p`` is that of its F form. Both are null with
    fewer than two models or items, or if all grades of every item are equal; ``f`` is also null when all items agree.
    """
    per_model = ranks.groupBy(model).agg(F.count("*").alias("n"), F.sum("place").alias("r"), F.sum("ties").alias("ties"))
    sums = per_model.agg(F.max("n").alias("items"), F.count("*").alias("models"), F.sum(F.col("r") ** 2).alias("_r2"), F.sum("ties").alias("_ties"))
    n, k = F.col("items").cast("double"), F.col("models").cast("double")
    plain = 12 * F.col("_r2") / (n * k * (k + 1)) - 3 * n * (k + 1)
    loss = 1 - F.col("_ties") / (n * k * (k * k - 1))
    able = (n > 1) & (k > 1)
    chi = sums.withColumn("chi_squared", F.when(able, F.when(loss > 1e-12, F.try_divide(plain, loss))))
    f = F.when(n * (k - 1) - F.col("chi_squared") > 1e-9, F.try_divide((n - 1) * F.col("chi_squared"), n * (k - 1) - F.col("chi_squared")))
    named = chi.withColumns({"f": f, "df_between": k - 1, "df_within": (k - 1) * (n - 1)})
    p = F.when(F.col("f").isNotNull(), f_tail(F.greatest(F.col("f"), F.lit(0.0)), F.col("df_between"), F.col("df_within")))
    return named.select("items", "models", "chi_squared", "f", "df_between", "df_within", p.alias("p"))


#: Chances of at most 0, 1, 2 ... by the Poisson distribution of mean 1.
POISSON = tuple(sum(1 / math.factorial(i) for i in range(k + 1)) / math.e for k in range(10))


def poisson_weight(item: Column, draw: Column, seed: int) -> Column:
    """How often a draw takes an item: Poisson of mean 1, from a hash, so reruns agree."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), item.cast("string"), draw.cast("string")))
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    weight = F.lit(0)
    for chance in POISSON:
        weight = weight + (u >= F.lit(chance)).cast("int")
    return weight


def bootstrap_differences(
    ranks: DataFrame, first: str, item: str, *, draws: int = 200, seed: int = 7, share: float = 0.95, model: str = "model"
) -> DataFrame:
    """``model, difference, low, high``: each model's mean grade less that of ``first``, with a bootstrap interval.

    A draw weighs every item anew, whatever task holds it, so nothing is gathered: sums of
    ``draws`` rows per model leave each task.
    """
    base = ranks.where(F.col(model) == first).select(F.col(item).alias("_item"), F.col("grade").alias("_base"))
    apart = ranks.where(F.col(model) != first).join(base, F.col(item) == F.col("_item"))
    each = apart.select(item, model, (F.col("grade") - F.col("_base")).alias("d"))
    drawn = each.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    weighed = drawn.withColumn("w", poisson_weight(F.col(item), F.col("draw"), seed))
    means = weighed.groupBy(model, "draw").agg(F.try_divide(F.sum(F.col("w") * F.col("d")), F.sum("w")).alias("m"))
    tail = (1 - share) / 2
    bounds = means.groupBy(model).agg(F.percentile("m", F.lit(tail)).alias("low"), F.percentile("m", F.lit(1 - tail)).alias("high"))
    return each.groupBy(model).agg(F.avg("d").alias("difference")).join(bounds, model).select(model, "difference", "low", "high")
