"""Abstract presets, post-hoc aggregation and the single-model analysis."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replivote.functions.prompts import ABSTRACT_PROMPTS
from replivote.functions.votes import vote_simple, vote_words
from replivote.operators.annotate import Responder, annotate, voting_answers
from replivote.operators.items import assign_identifier, project_content
from replivote.operators.once import with_computed
from replivote.operators.reshape import NO_RESPONSE, discover_responses, quoted, wide_answers
from replivote.operators.tasks import apply_prompt_library, text_tasks
from replivote.sources.tables import scan_folder, select_by_position, union_by_name

# Where a bibliographic export holds the four fields, counted from 0.
EXPORT_POSITIONS = {2: "Publication Date", 3: "Author", 4: "Title", 10: "Abstract"}
PRESET_RUNS = 5
PRESET_MODEL = "gemma2"


def abstract_presets(
    export: DataFrame,
    open_responder: Callable[[], Responder],
    *,
    themes: Mapping[str, str] = ABSTRACT_PROMPTS,
    runs: int = PRESET_RUNS,
    model: str = PRESET_MODEL,
    positions: Mapping[int, str] = EXPORT_POSITIONS,
    key: str | None = None,
) -> DataFrame:
    """Ask every preset question about every abstract in one job.

    Gives one row per abstract and theme with ``Response 1..n``, answers as they
    came; a call that failed or was never made reads 'Error: No response'. Write it
    with ``partitionBy("theme")`` for one data set per theme. ``key`` names a column
    of the export handed to the responder, else the title is.
    """
    named = quoted(key) if key else quoted(export.columns[4])
    picked = select_by_position(export.withColumn("_key", named), {**positions, len(export.columns): "_key"})
    listed = apply_prompt_library(picked.withColumn("_text", F.col("Abstract")), themes, "_text")
    keyed = listed.withColumn("_key", F.concat_ws("|", F.col("_key").cast("string"), "theme"))
    answered = annotate(keyed, [model], runs, open_responder, key="_key", clean=False)
    padded = answered.withColumn(
        "answers",
        F.transform("answers", lambda a, i: F.when(a.isNull() | F.col("failed")[i], NO_RESPONSE).otherwise(a)),
    )
    return padded.select("theme", *positions.values(), *wide_answers(F.col("answers"), [None], runs, " "))


def aggregate_outputs(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack finished answer tables by column name and take the word vote of each row."""
    stacked = union_by_name(tables)
    said = F.array(*[quoted(name).cast("string") for name, _, _ in discover_responses(stacked.columns)])
    voted = stacked.withColumn("_vote", vote_words(said))  # leaves the JVM, so it is a step of its own
    return voted.select(
        *[quoted(c) for c in stacked.columns],
        F.col("_vote.consensus").alias("Consensus Result"),
        F.col("_vote.confidence").alias("Consensus over Total"),
    )


def aggregate_folder(spark: SparkSession, folder: str, sheet: str | None = None) -> DataFrame:
    """The word vote over every finished table of a folder, CSV or workbook, whatever columns each has."""
    return aggregate_outputs([scan_folder(spark, folder, None, sheet)])


def single_model_analysis(
    table: DataFrame,
    *,
    content_col: str,
    prompt: str,
    model: str,
    runs: int,
    open_responder: Callable[[], Responder],
    id_col: str | None = None,
    order_by: Sequence[str] | None = None,
    consensus: bool = True,
    errors_vote: bool = False,
) -> DataFrame:
    """One model, several runs, simple modal consensus."""
    items = project_content(assign_identifier(table, id_col, order_by), content_col, ["Identifier"])
    answered = annotate(
        text_tasks(items, prompt), [model], runs, open_responder, key="Identifier", error_text="Error occurred"
    )
    wide = [F.col("Identifier"), F.col("Content"), *wide_answers(F.col("answers"), [None], runs)]
    if not consensus:
        return answered.select(*wide)
    heard = voting_answers(F.col("answers"), F.col("failed"), errors_vote)
    voted = with_computed(answered, {"_vote": vote_simple(heard)})
    return voted.select(
        *wide,
        F.col("_vote.consensus").alias("Consensus_Result"),
        F.col("_vote.confidence").alias("Consensus_Confidence"),
    )
