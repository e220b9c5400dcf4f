"""Long and wide answer tables, joins by identifier, padding."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.operators.tasks import fan_out_models, fan_out_runs

NO_RESPONSE = "Error: No response"

_LABEL = re.compile(r"^response[_ ](\d+)(?: \((.*)\))?$", re.IGNORECASE)


def quoted(name: str) -> Column:
    """A column whose name may hold dots, blanks or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def label(run: int, model: str | None = None, separator: str = "_") -> str:
    base = f"Response{separator}{run}"
    return base if model is None else f"{base} ({model})"


def pivot_responses(responses: DataFrame, keys: Sequence[str], models: Sequence[str], runs: int) -> DataFrame:
    """Long to wide ``Response_{run} ({model})``, run-major; columns are stated, not discovered."""
    labels = [label(r, m) for r in range(1, runs + 1) for m in models]
    named = F.concat(F.lit("Response_"), F.col("run"), F.lit(" ("), F.col("model"), F.lit(")"))
    wide = responses.withColumn("_label", named).groupBy(*keys).pivot("_label", labels).agg(F.min("response"))
    return wide.select(*keys, *[quoted(c) for c in labels])


def wide_answers(answers: Column, models: Sequence[str | None], runs: int, separator: str = "_") -> list[Column]:
    """The same columns read from a run-major answer array: no grouping needed."""
    n = len(models)
    return [
        answers[(r - 1) * n + i].alias(label(r, m, separator))
        for r in range(1, runs + 1)
        for i, m in enumerate(models)
    ]


def discover_responses(columns: Sequence[str]) -> list[tuple[str, int | None, str | None]]:
    """Answer columns in table order as (column, run, model); case does not matter."""
    found = []
    for name in columns:
        if name.lower().startswith("response"):
            match = _LABEL.match(name)
            found.append((name, int(match[1]), match[2]) if match else (name, None, None))
    return found


def numbered_responses(columns: Sequence[str]) -> list[str]:
    """Columns the pooled pass reads: ``response_`` and a number first."""
    return [c for c in columns if re.match(r"response_\d+", c, re.IGNORECASE)]


def consensus_columns(columns: Sequence[str], models: Sequence[str]) -> list[str]:
    """Within-model consensus columns in model order, else any ``consensus (`` column."""
    stated = [c for c in (f"Consensus ({m})" for m in models) if c in columns]
    return stated or [c for c in columns if c.lower().startswith("consensus (")]


def unpivot_responses(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wide to long: keys, label, run, model, response."""
    found = discover_responses(wide.columns)
    each = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                F.lit(run).cast("int").alias("run"),
                F.lit(model).cast("string").alias("model"),
                quoted(name).cast("string").alias("response"),
            )
            for name, run, model in found
        ]
    )
    return wide.select(*[quoted(k) for k in keys], F.inline(each))


def reorder_columns(wide: DataFrame, first: Sequence[str], models: Sequence[str], runs: int) -> DataFrame:
    """Key columns, answers run-major, consensus pairs by model, the rest as it was."""
    wanted = [*first, *[label(r, m) for r in range(1, runs + 1) for m in models]]
    for m in models:
        wanted += [f"Consensus ({m})", f"Consensus_Confidence ({m})"]
    leading = [c for c in wanted if c in wide.columns]
    return wide.select(*[quoted(c) for c in [*leading, *[c for c in wide.columns if c not in leading]]])


def left_join_responses(master: DataFrame, answers: DataFrame, on: str) -> DataFrame:
    """Attach answers, one row per identifier; null identifiers match each other.

    One left join: its skewed side is the master table, whose large partitions the
    adaptive planner splits, repeating only the few answers that meet them.
    """
    right = answers.withColumnRenamed(on, "_right_key")
    return master.join(right, quoted(on).eqNullSafe(F.col("_right_key")), "left").drop("_right_key")


def dedupe_identifier(table: DataFrame, identifier: str, order: str) -> DataFrame:
    """First row of every identifier by ``order`` (unique; nulls come last).

    Only the two key columns are aggregated, combined map-side, so a hot identifier
    costs one row per task; the payload joins back on the unique order column. An
    identifier whose order is null in every row keeps one of them.
    """
    firsts = table.groupBy(quoted(identifier).alias("_id")).agg(F.min(quoted(order)).alias("_first"))
    known = table.join(firsts.where("_first is not null").select("_first"), quoted(order) == F.col("_first"), "left_semi")
    never = firsts.where("_first is null").select("_id")
    rest = table.where(quoted(order).isNull()).join(never, quoted(identifier).eqNullSafe(F.col("_id")), "left_semi")
    one = rest.groupBy(quoted(identifier)).agg(F.first(F.struct(*[quoted(c) for c in table.columns])).alias("_row"))
    return known.unionByName(one.select("_row.*"))


def shared_identifier_answers(table: DataFrame, answers: DataFrame, identifier: str, order: str) -> DataFrame:
    """Give all rows with one identifier the answers of its first row.

    ``answers`` is keyed by ``order``. First rows pick up their answers before the
    join on the identifier, which then has one row per identifier on its right.
    """
    firsts = table.groupBy(quoted(identifier)).agg(F.min(quoted(order)).alias("_first"))
    keyed = answers.withColumnRenamed(order, "_order")
    ready = firsts.join(keyed, F.col("_first") == F.col("_order")).drop("_first", "_order")
    return left_join_responses(table, ready, identifier)


def pad_missing(items: DataFrame, responses: DataFrame, key: str, models: Sequence[str], runs: int) -> DataFrame:
    """Every item x model x run; absent answers read 'Error: No response'.

    ``key`` is unique in ``items``. Of several answers to one key, model and run the
    smallest counts, so one key's answers are few: they are gathered before the join,
    and the grid is laid out after it.
    """
    single = responses.groupBy(key, "model", "run").agg(F.min("response").alias("response"))
    held = single.groupBy(key).agg(F.collect_list(F.struct("model", "run", "response")).alias("_held"))
    grid = fan_out_runs(fan_out_models(items.select(key).join(held, key, "left"), models), runs)
    own = F.filter("_held", lambda h: (h["model"] == F.col("model")) & (h["run"] == F.col("run")))
    found = F.get(own, F.lit(0))["response"]
    return grid.select(key, "model_idx", "model", "run", F.coalesce(found, F.lit(NO_RESPONSE)).alias("response"))
