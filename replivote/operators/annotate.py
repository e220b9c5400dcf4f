"""Ask an annotator for every answer of every item, in Arrow batches.

The text of an item crosses to Python once, whatever the number of models and
runs; only the answers come back. Within a batch all work for one model is done
before the next model starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.functions.text import clean_response
from replivote.operators.reshape import quoted

# (model, run, batch) -> one answer, or one exception, per row of the batch; a batch
# has key, prompt, path and content lists
Responder = Callable[[str, int, dict[str, list]], Sequence[str | Exception]]

_ANSWERS = "struct<answers: array<string>, failed: array<boolean>>"
_BATCH_BYTES = 32 << 20


def annotate(
    tasks: DataFrame,
    models: Sequence[str],
    runs: int,
    open_responder: Callable[[], Responder],
    *,
    key: str,
    prompt: str = "prompt",
    path: str | None = None,
    content: str | None = None,
    error_text: str = "Error: {error}",
    clean: bool = True,
    split_on_error: bool = False,
    batch_bytes: int = _BATCH_BYTES,
) -> DataFrame:
    """Add ``answers`` and ``failed`` arrays, run-major: position ``(run - 1) * models + model``.

    ``open_responder`` is called once per partition. ``content`` names a binary column, such
    as an image's bytes, that is read by the task and handed over. An exception returned for a row
    becomes its answer text. A whole call that raises fails for all its rows, and none is
    asked again; with ``split_on_error`` the batch is halved instead, and asked again,
    until the bad rows stand alone. Rows with a null prompt are not asked. Being declared
    non-deterministic, the call is never planned twice for one row.

    A batch of the responder holds as many rows as keep prompts and contents, counted once for
    every answer asked, within ``batch_bytes`` (one row at least): its answers, which may be as long as the
    prompts, are all in memory at once.
    """
    models = list(models)
    most = batch_bytes // max(1, len(models) * runs)

    def ask(responder: Responder, model: str, run: int, batch: dict[str, list]) -> list[str | Exception]:
        n = len(batch["key"])
        try:
            answers = list(responder(model, run, batch))
            if len(answers) != n:
                raise ValueError(f"{len(answers)} answers for {n} prompts")
            return answers
        except Exception as error:  # noqa: BLE001 - one bad row must not fail the others
            if n == 1 or not split_on_error:
                return [error] * n
        halves = ({k: v[: n // 2] for k, v in batch.items()}, {k: v[n // 2 :] for k, v in batch.items()})
        return [answer for half in halves for answer in ask(responder, model, run, half)]

    def cuts(arrays: Sequence[pa.Array]) -> Iterator[tuple[int, int]]:
        """Start and length of consecutive rows whose texts and bytes are together at most ``most``, but one row at least."""
        sizes = [pc.fill_null(pc.binary_length(a).cast(pa.int64()), 0).to_pylist() for a in arrays]
        start, held = 0, 0
        for i, size in enumerate(map(sum, zip(*sizes))):
            if i > start and held + size > most:
                yield start, i - start
                start, held = i, 0
            held += size
        yield start, len(arrays[0]) - start

    @F.arrow_udf(_ANSWERS)
    def ask_all(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        responder = open_responder()
        for arrays in batches:
            for start, n in cuts((arrays[1], arrays[3])):
                yield ask_batch(responder, *[a.slice(start, n) for a in arrays])

    def ask_batch(responder: Responder, keys: pa.Array, prompts: pa.Array, paths: pa.Array, contents: pa.Array) -> pa.Array:
        asked = [i for i, p in enumerate(prompts.is_valid().to_pylist()) if p]
        batch = {
            name: values.take(pa.array(asked, pa.int64())).to_pylist()
            for name, values in (("key", keys), ("prompt", prompts), ("path", paths), ("content", contents))
        }
        answers = [[None] * (len(models) * runs) for _ in range(len(prompts))]
        failed = [[None] * (len(models) * runs) for _ in range(len(prompts))]
        for m, model in enumerate(models) if asked else ():
            for run in range(1, runs + 1):
                slot = (run - 1) * len(models) + m
                for row, answer in zip(asked, ask(responder, model, run, batch)):
                    bad = isinstance(answer, Exception)
                    answers[row][slot] = error_text.format(error=answer) if bad else answer
                    failed[row][slot] = bad
        return pa.StructArray.from_arrays(
            [pa.array(answers, pa.list_(pa.string())), pa.array(failed, pa.list_(pa.bool_()))],
            names=["answers", "failed"],
        )

    where = F.col(path) if path else F.lit(None).cast("string")
    what = F.col(content) if content else F.lit(None).cast("binary")
    asked = tasks.withColumn("_a", ask_all.asNondeterministic()(F.col(key), F.col(prompt), where, what))
    answers = F.col("_a.answers")
    if clean:
        answers = F.transform(
            answers, lambda a, i: F.when(F.col("_a.failed")[i], a).otherwise(clean_response(a))
        )
    kept = [quoted(c) for c in tasks.columns if c != content]
    return asked.select(*kept, answers.alias("answers"), F.col("_a.failed").alias("failed"))


def status(answer: Column, failed: Column) -> Column:
    """'ok', 'error' or 'missing' for one answer."""
    return F.when(answer.isNull(), "missing").when(failed, "error").otherwise("ok")


def long_responses(annotated: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """One row per answer: keys, model_idx, model, run, response, status."""
    n = len(models)
    named = F.array(*[F.lit(m) for m in models])
    # the outer form: a plain explode would add a filter that evaluates the arrays twice
    each = annotated.select(*keys, F.posexplode_outer(F.arrays_zip("answers", "failed")).alias("_at", "_a"))
    model_idx = (F.col("_at") % n).cast("int")
    return each.select(
        *keys,
        model_idx.alias("model_idx"),
        named[model_idx].alias("model"),
        F.floor(F.col("_at") / n + 1).cast("int").alias("run"),
        F.col("_a.answers").alias("response"),
        status(F.col("_a.answers"), F.col("_a.failed")).alias("status"),
    )


def voting_answers(answers: Column, failed: Column, errors_vote: bool) -> Column:
    """The answer array with error texts blanked out unless they may vote."""
    if errors_vote:
        return answers
    return F.transform(answers, lambda a, i: F.when(failed[i], None).otherwise(a))
