import pytest
from pyspark.sql import functions as F

from replivote.operators import annotate as an
from replivote.operators import items, report, reshape, tasks

MODELS = ["llama3.2-vision:11b", "m2"]


def echo():
    """Answers with model, run and key; fails on marked prompts."""

    def respond(model, run, batch):
        return [f" {model}/{run}/{k}\r\n" for k in batch["key"]]

    return respond


def test_annotate_orders_answers_run_major(spark):
    df = spark.createDataFrame([(1, "p"), (2, "q")], "id long, prompt string")
    got = an.annotate(df, MODELS, 2, echo, key="id").orderBy("id").collect()
    assert got[1]["answers"] == [f"{m}/{r}/2" for r in (1, 2) for m in MODELS]
    assert got[1]["failed"] == [False] * 4
    long = an.long_responses(an.annotate(df, MODELS, 2, echo, key="id"), ["id"], MODELS)
    assert {(r.id, r.model_idx, r.model, r.run, r.response, r.status) for r in long.collect()} == {
        (i, k, m, run, f"{m}/{run}/{i}", "ok") for i in (1, 2) for k, m in enumerate(MODELS) for run in (1, 2)
    }


def test_annotate_isolates_errors_and_skips_null_prompts(spark):
    def open_responder():
        def respond(model, run, batch):
            if any(p == "bad" for p in batch["prompt"]):
                raise RuntimeError("boom")
            return [ValueError("odd") if p == "odd" else p.upper() for p in batch["prompt"]]

        return respond

    prompts = ["a", "bad", "odd", None, "b", "bad", "c"]
    df = spark.createDataFrame(list(enumerate(prompts)), "id long, prompt string").coalesce(1)
    got = an.annotate(df, ["m"], 1, open_responder, key="id", split_on_error=True).orderBy("id").collect()
    assert [r["answers"][0] for r in got] == ["A", "Error: boom", "Error: odd", None, "B", "Error: boom", "C"]
    states = an.long_responses(an.annotate(df, ["m"], 1, open_responder, key="id", split_on_error=True), ["id"], ["m"]).orderBy("id")
    assert [r.status for r in states.collect()] == ["ok", "error", "error", "missing", "ok", "error", "ok"]


def test_annotate_rejects_wrong_answer_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, prompt string").coalesce(1)
    got = an.annotate(df, ["m"], 1, lambda: lambda model, run, batch: ["x", "y", "z"], key="id").collect()
    assert all(r["failed"] == [True] and "answers for 2 prompts" in r["answers"][0] for r in got)


def test_annotator_opens_once_per_partition(spark):
    def open_responder():
        calls = []

        def respond(model, run, batch):
            calls.append(1)
            return [str(len(calls))] * len(batch["key"])

        return respond

    df = spark.createDataFrame([(i, "p") for i in range(10)], "id long, prompt string").coalesce(1)
    got = an.annotate(df, ["a", "b"], 2, open_responder, key="id").collect()
    assert {tuple(r["answers"]) for r in got} == {("1", "3", "2", "4")}  # all of one model, then the next


def test_numbering_in_stated_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("t")).repartition(7)
    got = items.assign_identifier(df, order_by=["t", F.col("v").desc()]).collect()
    expected = sorted(((r.t, -r.v) for r in got))
    assert [(r.t, -r.v) for r in sorted(got, key=lambda r: r.Identifier)] == expected
    assert sorted(r.Identifier for r in got) == list(range(1, 1001))


def test_numbering_in_input_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5000, 1, 5).write.parquet(path)
    scan = spark.read.parquet(path)
    got = items.assign_identifier(scan, id_col="absent").collect()
    assert sorted((r.Identifier, r.id) for r in got) == [(i + 1, i) for i in range(5000)]


def test_identifier_column_and_missing_content(spark):
    df = spark.createDataFrame([("x", 5)], "`a.id` string, text int")
    assert items.assign_identifier(df, "a.id").first()["Identifier"] == "x"
    assert items.project_content(df, "text").first()["Content"] == "5"
    with pytest.raises(ValueError, match="no content column"):
        items.project_content(df, "nothing")


def wide(spark):
    columns = ["id"] + [reshape.label(r, m) for r in (1, 2) for m in MODELS]
    return spark.createDataFrame([(1, "a", "b", "c", "d"), (2, None, "x", "y", "z")], columns)


def test_wide_long_wide(spark):
    long = reshape.unpivot_responses(wide(spark), ["id"])
    back = reshape.pivot_responses(long, ["id"], MODELS, 2)
    assert sorted(back.collect()) == sorted(wide(spark).collect()) and back.columns == wide(spark).columns


def test_discovery():
    names = ["id", "RESPONSE_2 (m)", "Response 1", "response_3", "Response note", "Consensus (m)", "my response_1"]
    assert reshape.discover_responses(names) == [
        ("RESPONSE_2 (m)", 2, "m"), ("Response 1", 1, None), ("response_3", 3, None), ("Response note", None, None),
    ]
    assert reshape.numbered_responses(names) == ["RESPONSE_2 (m)", "response_3"]
    assert reshape.consensus_columns(names, ["other"]) == ["Consensus (m)"]
    assert reshape.consensus_columns([*names, "Consensus (b)"], ["b", "m"]) == ["Consensus (b)", "Consensus (m)"]


def test_column_order(spark):
    m = MODELS[0]
    df = wide(spark).withColumn(f"Consensus ({m})", F.lit("c")).withColumn("extra", F.lit(1))
    mixed = df.select(*[reshape.quoted(c) for c in reversed(df.columns)])
    got = reshape.reorder_columns(mixed, ["id"], MODELS, 2).columns
    assert got == ["id", *wide(spark).columns[1:], f"Consensus ({m})", "extra"]


def test_join_of_a_hot_identifier(spark):
    keys = ["hot"] * 500 + [None] * 100 + [f"k{i}" for i in range(50)]
    master = spark.createDataFrame(list(enumerate(keys)), "row int, key string").repartition(3)
    answers = spark.createDataFrame([(k, f"r-{k}") for k in dict.fromkeys(keys) if k != "k7"], "key string, r string")
    got = reshape.left_join_responses(master, answers, "key").collect()
    assert sorted((r.row, r.r) for r in got if r.r) == [(i, f"r-{k}") for i, k in enumerate(keys) if k != "k7"]
    assert len(got) == len(keys)


def test_join_by_identifier_matches_nulls(spark):
    master = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "row int, key string")
    answers = spark.createDataFrame([("a", "x"), (None, "n")], "key string, r string")
    assert sorted(tuple(r) for r in reshape.left_join_responses(master, answers, "key").select("row", "r").collect()) == [
        (1, "x"), (2, "n"), (3, None),
    ]


def test_shared_identifier_takes_first_rows_answers(spark):
    table = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "row int, key string").repartition(3)
    answers = spark.createDataFrame([(i, f"r{i}") for i in range(1, 5)], "row int, r string")
    got = reshape.shared_identifier_answers(table, answers, "key", "row")
    assert sorted((r["row"], r["r"]) for r in got.collect()) == [(1, "r1"), (2, "r1"), (3, "r3"), (4, "r3")]
    assert sorted(r["row"] for r in reshape.dedupe_identifier(table, "key", "row").collect()) == [1, 3]


def test_padding(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    said = spark.createDataFrame([(1, "m", 1, "x")], "id int, model string, run int, response string")
    got = reshape.pad_missing(ids, said, "id", ["m"], 2).collect()
    assert sorted((r.id, r.run, r.response) for r in got) == [
        (1, 1, "x"), (1, 2, reshape.NO_RESPONSE), (2, 1, reshape.NO_RESPONSE), (2, 2, reshape.NO_RESPONSE),
    ]


def test_fan_out(spark):
    df = tasks.fan_out_runs(tasks.fan_out_models(spark.range(2), ["a", "b"]), 3)
    assert df.count() == 12 and df.columns == ["id", "model_idx", "model", "run"]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_reports(spark):
    df = spark.createDataFrame([(1, "a", 0.7), (2, "b", 0.4), (3, "c", 0.333), (4, "d", 0.0)], "row int, id string, c double")
    assert {r.band: r.n_rows for r in report.confidence_bands(df, "c").collect()} == {"high": 1, "medium": 1, "low": 2}
    assert {r.band: r.n_rows for r in report.confidence_bands(df.where("c > 1"), "c").collect()} == {"high": 0, "medium": 0, "low": 0}
    lines = [r.line for r in report.review_list(df, "row", "id", "c").orderBy("row_number").collect()]
    assert lines == ["Row 3: c (confidence: 33.3%)", "Row 4: d (confidence: 0.0%)"]
    assert report.duration_text(3725.26) == "1h 2m 5.3s"
    run = report.run_metadata(df, "c", prompt="p", models=["m"], runs=2, within_mode="fuzzy", between=False, duration_s=61).first()
    assert (run.n_high, run.n_medium, run.n_low, run.within_threshold, run.between_mode) == (1, 1, 2, 85.0, "fuzzy")
    assert run.duration == "0h 1m 1.0s"


def test_numbering_any_table(spark):
    df = spark.range(500).repartition(6).union(spark.range(500, 520))
    got = items.assign_identifier(df).collect()
    assert sorted(r["Identifier"] for r in got) == list(range(1, 521)) and len({r["id"] for r in got}) == 520


def test_joins_take_any_row(spark):
    """Equal rows of a hot key, map columns, dotted names, orders that are null."""
    master = spark.createDataFrame([("a", {"x": 1})] * 300 + [("b", {"y": 2})], "`k.1` string, m map<string,int>")
    answers = spark.createDataFrame([("a", "A")], "`k.1` string, r string")
    planned = reshape.left_join_responses(master, answers, "k.1")._jdf.queryExecution().executedPlan().toString()
    assert planned.count("Exchange hashpartitioning") <= 2
    joined = reshape.left_join_responses(master, answers, "k.1")
    assert sorted((r["k.1"], r["r"]) for r in joined.collect()) == [("a", "A")] * 300 + [("b", None)]
    table = spark.createDataFrame([("a", None, 1), ("a", 3, 2), ("b", None, 3), ("b", None, 3)], "`i.d` string, `o.r` int, v int")
    assert sorted(tuple(r) for r in reshape.dedupe_identifier(table, "i.d", "o.r").collect()) == [("a", 3, 2), ("b", None, 3)]


def test_padding_takes_the_smallest_of_several_answers(spark):
    said = spark.createDataFrame([(1, "m", 1, "y"), (1, "m", 1, "x")], "id int, model string, run int, response string")
    got = reshape.pad_missing(spark.createDataFrame([(1,)], "id int"), said, "id", ["m"], 1).collect()
    assert [r["response"] for r in got] == ["x"]


def test_a_failed_call_is_not_asked_again(spark):
    calls = spark.sparkContext.accumulator(0)

    def open_responder():
        def respond(model, run, batch):
            calls.add(len(batch["key"]))
            raise RuntimeError("down")

        return respond

    df = spark.createDataFrame([(i, "p") for i in range(9)], "id long, prompt string").coalesce(1)
    got = an.annotate(df, ["m"], 2, open_responder, key="id").collect()
    assert calls.value == 18 and all(r["failed"] == [True, True] for r in got)


@pytest.mark.parametrize("vote", ["consensus_exact", "consensus_set", "consensus_fuzzy", "consensus_words", "consensus_simple"])
def test_votes_take_keys_of_any_name(spark, vote):
    from replivote.operators import consensus

    said = spark.createDataFrame([("k", i, "a b" if i else "a, b") for i in range(5)], "`my.key` string, run int, response string")
    got = getattr(consensus, vote)(said, ["my.key"]).collect()
    assert len(got) == 1 and got[0]["my.key"] == "k"


def test_batches_of_long_prompts_are_bounded_by_bytes(spark):
    def open_responder():
        def respond(model, run, batch):
            return [f"{k}:{sum(map(len, batch['prompt']))}" for k in batch["key"]]

        return respond

    prompts = ["x" * 300, "x" * 300, None, "x" * 300, "x" * 5000, "", "x" * 1000]
    df = spark.createDataFrame(list(enumerate(prompts)), "id long, prompt string").coalesce(1)
    got = an.annotate(df, ["a", "b"], 2, open_responder, key="id", batch_bytes=4000).orderBy("id").collect()
    # 1,000 bytes of prompts for each of four answers; a longer one stands alone
    assert [r["answers"][0] for r in got] == ["0:900", "1:900", None, "3:900", "4:5000", "5:1000", "6:1000"]
    assert all(len(set(r["answers"])) == 1 for r in got)
