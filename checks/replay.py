"""Repeatable stand-in for model answers, as a Spark column and as an annotator.

Ten kinds of answer are picked by a hash of item, model and run: blank, error, the
whole text in several spellings, the text with its lines turned round, both as a list
in either order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replivote.operators.tasks import fan_out_models, fan_out_runs
from replivote.session import spread

MODELS = ("m1", "m2", "m3")
RUNS = 5
ERROR = "Error: timeout"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MARK = "variant"


def whole(text: Column) -> Column:
    """A whole text on one line."""
    return F.translate(text, "\n", " ")


def turned(text: Column) -> Column:
    """A whole text with its lines in reverse order, the last one left out, and one word more."""
    lines = F.split(text, "\n")
    return F.concat_ws(" ", F.reverse(F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(1)))), F.lit(MARK))


def longest(text: Column) -> Column:
    """The longest word of a whole text, the last in order of those."""
    pairs = F.transform(F.split(whole(text), " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))
    return F.array_max(pairs)["w"]


def last_word(text: Column) -> Column:
    """The word of a whole text that comes last in order."""
    return F.array_max(F.split(whole(text), " "))


def documents(
    spark: SparkSession, sf_dir: str, *more: str, short: bool = False, name: str = "documents", key: str = "doc_id", by: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """doc_id and two answers made of the whole text (or, short, chosen from all its words), spread by doc_id or as told."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = table(spark, sf_dir, name).select(F.col(key).alias("doc_id"), *more, text.alias("text"))
    if short:
        return spread(narrow.select("doc_id", *more, longest(F.col("text")).alias("w1"), last_word(F.col("text")).alias("w2")), *by)
    # the text moves, if anything does, and not the two answers made of it
    return spread(narrow, *by).select("doc_id", *more, whole(F.col("text")).alias("w1"), turned(F.col("text")).alias("w2"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One made-up file name per page; nine endings, two of them not images."""
    endings = F.array(*[F.lit(e) for e in (".jpg", ".JPEG", ".png", ".bmp", ".tiff", ".GIF", ".webp", ".txt", "")])
    ending = endings[(F.col("page_id") % 9).cast("int")]
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p"), "page_id", ending).alias("image"))


def kind(key: Column, model: Column, run: Column) -> Column:
    text = F.concat_ws("|", key.cast("string"), model, run.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10


def answer(kind_of: Column, w1: Column, w2: Column) -> Column:
    return (
        F.when(kind_of == 0, "")
        .when(kind_of == 1, ERROR)
        .when(kind_of == 2, F.concat(F.upper(F.substring(w1, 1, 1)), F.substr(w1, F.lit(2)), F.lit(".")))
        .when(kind_of == 6, F.concat(F.lit("  "), w1, F.lit(" ")))
        .when(kind_of == 7, w2)
        .when(kind_of == 8, F.concat(w1, F.lit(", "), w2))
        .when(kind_of == 9, F.concat(w2, F.lit("; "), w1))
        .otherwise(w1)
    )


def responses(spark: SparkSession, sf_dir: str, *more: str, short: bool = False, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Long replay answers: doc_id, model_idx, model, run, response, status; spread as ``documents`` is told."""
    tasks = fan_out_runs(fan_out_models(documents(spark, sf_dir, *more, short=short, by=by), MODELS), RUNS)
    kinds = tasks.withColumn("_k", kind(F.col("doc_id"), F.col("model"), F.col("run")))
    return kinds.select(
        "doc_id",
        *more,
        "model_idx",
        "model",
        "run",
        answer(F.col("_k"), F.col("w1"), F.col("w2")).alias("response"),
        F.when(F.col("_k") == 1, "error").otherwise("ok").alias("status"),
    )


def rows(spark: SparkSession, sf_dir: str, *more: str, **items_of: str) -> DataFrame:
    """The same answers as one run-major array per document: doc_id, answers, failed."""
    items = documents(spark, sf_dir, *more, by=(), **items_of)  # a row votes on its own: nothing groups them later
    slots = [(m, r) for r in range(1, RUNS + 1) for m in MODELS]
    kinds = items.withColumn("_k", F.array(*[kind(F.col("doc_id"), F.lit(m), F.lit(r)) for m, r in slots]))
    return kinds.select(
        "doc_id",
        *more,
        F.transform("_k", lambda k: answer(k, F.col("w1"), F.col("w2"))).alias("answers"),
        F.transform("_k", lambda k: k == 1).alias("failed"),
    )


def replay(words: Callable[[str, str | None, bytes | None], tuple[str, str]], raw_key: bool = True) -> Callable:
    """An annotator that gives the replay answers; ``words(key, prompt, content)`` makes the two of an item."""

    def open_responder():
        def respond(model: str, run: int, batch: dict[str, list]) -> list:
            out = []
            for key, prompt, content in zip(batch["key"], batch["prompt"], batch["content"]):
                w1, w2 = words(str(key), prompt, content)
                parts = [str(key), model, str(run)] if raw_key else [str(key), str(run)]
                k = int(hashlib.md5("|".join(parts).encode()).hexdigest()[:8], 16) % 10
                if k == 1:
                    out.append(TimeoutError("timeout"))
                else:
                    out.append(
                        {0: "", 2: w1[:1].upper() + w1[1:] + ".", 6: f"  {w1} ", 7: w2, 8: f"{w1}, {w2}", 9: f"{w2}; {w1}"}.get(k, w1)
                    )
            return out

        return respond

    return open_responder


def both_ways(content: str) -> tuple[str, str]:
    lines = content.split("\n")
    return content.replace("\n", " "), " ".join([*reversed(lines[: max(1, len(lines) - 1)]), MARK])


def replay_texts(template: str) -> Callable:
    """Replay for prompts that are a known template, a space and the text."""
    return replay(lambda key, prompt, content: both_ways(prompt[len(template) + 1 :]))


def replay_judge() -> Callable:
    """A judge whose grade hangs on a hash of its whole prompt; now and then it says no number."""

    def respond(model: str, run: int, batch: dict[str, list]) -> list[str]:
        hashes = [int(hashlib.md5(p.encode()).hexdigest()[:8], 16) for p in batch["prompt"]]
        return ["I cannot tell." if h % 23 == 0 else f"Grade: {h % 10 + 1}/10" for h in hashes]

    return respond


def replay_images() -> Callable:
    """Replay for images: the file's stem, and a digest of its bytes."""
    return replay(lambda key, prompt, content: (key.partition(".")[0], hashlib.md5(content).hexdigest()))


def replay_abstracts(templates: dict[str, str]) -> Callable:
    """Replay for keys ``id|theme`` and that theme's template."""
    return replay(lambda key, prompt, content: both_ways(prompt[len(templates[key.split("|")[1]]) + 1 :]), raw_key=False)
