import pytest
from pyspark.sql import functions as F

from checks import replay
from replivote.operators.items import assign_identifier
from replivote.plans import abstracts
from replivote.plans.analysis import run_analysis, text_analysis
from replivote.plans.voting import Voting
from tests import plain

MODELS = ["m1", "m2", "m3"]
TEXTS = ["Oak, elm trees", "Ash fir", "yew box tree", "Oak oaks grow", "one"]


def table(spark):
    return spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(TEXTS * 4)], "key string, body string")


def analysed(spark, voting, runs=4):
    return text_analysis(
        table(spark), id_col="key", content_col="body", prompt="Say:", models=MODELS, runs=runs,
        open_responder=replay.replay_texts("Say:"), voting=voting,
    )


def expected(row, voting, runs=4):
    said = [[row[f"Response_{r} ({m})"] for r in range(1, runs + 1)] for m in MODELS]
    pooled = [row[f"Response_{r} ({m})"] for r in range(1, runs + 1) for m in MODELS]

    def heard(answers):
        return answers if voting.errors_vote else [a for a in answers if not a.startswith("Error: ")]

    within = [plain.vote(heard(a), voting.within_mode, voting.within_threshold) for a in said]
    between = plain.vote([w[0] for w in within], voting.mode_between, voting.threshold_between)
    return within, plain.vote(heard(pooled), voting.mode_pooled, voting.threshold_pooled), between


@pytest.mark.parametrize("errors_vote", [False, True])
@pytest.mark.parametrize("within", ["exact", "set", "fuzzy"])
@pytest.mark.parametrize("between", [None, "set", "fuzzy"])
def test_every_mode_together(spark, within, between, errors_vote):
    voting = Voting(within_mode=within, between_mode=between, between_threshold=60, aggregate=True, errors_vote=errors_vote)
    rows = analysed(spark, voting).collect()
    assert len(rows) == 20
    for row in rows:
        own, pooled, across = expected(row, voting)
        assert [(row[f"Consensus ({m})"], row[f"Consensus_Confidence ({m})"]) for m in MODELS] == own
        assert (row["Aggregated_Consensus"], row["Aggregated_Consensus_Confidence"]) == pooled
        assert (row["BetweenModel_Consensus"], row["BetweenModel_Consensus_Confidence"]) == across


def test_columns_and_no_shuffle(spark):
    wide = analysed(spark, Voting(aggregate=True), runs=2)
    assert wide.columns == [
        "Identifier", "Content", *[f"Response_{r} ({m})" for r in (1, 2) for m in MODELS],
        *[c for m in MODELS for c in (f"Consensus ({m})", f"Consensus_Confidence ({m})")],
        "Aggregated_Consensus", "Aggregated_Consensus_Confidence", "BetweenModel_Consensus", "BetweenModel_Consensus_Confidence",
    ]
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    bare = analysed(spark, Voting(within=False, between=False), runs=1)
    assert bare.columns == ["Identifier", "Content", *[f"Response_1 ({m})" for m in MODELS]]


def test_between_follows_within_unless_told(spark):
    assert Voting(within_mode="set").mode_between == "set" and Voting(within_threshold=70).threshold_between == 70
    assert Voting(within_threshold=70, between_threshold=0).threshold_between == 0
    with pytest.raises(ValueError):
        Voting(between_mode="nearly")


def test_stored_run_calls_the_annotator_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def open_responder():
        def respond(model, run, batch):
            calls.add(len(batch["key"]))
            return ["a" if int(k) % 2 else f"{model}{run}" for k in batch["key"]]

        return respond

    path = str(tmp_path / "in")
    table(spark).coalesce(1).write.parquet(path)
    numbered = assign_identifier(spark.read.parquet(path)).withColumn("row_id", F.col("Identifier"))
    voting = Voting(aggregate=True)
    wide = text_analysis(
        numbered, id_col="row_id", content_col="body", prompt="p", models=MODELS, runs=4, open_responder=open_responder, voting=voting
    )
    stored = run_analysis(
        spark, wide, str(tmp_path / "out"), identifier="Identifier", prompt="p", models=MODELS, runs=4, voting=voting, delay=0.5
    )
    assert {r.band: r.n_rows for r in stored.bands.collect()} == {"high": 10, "medium": 0, "low": 10}
    lines = [r.line for r in stored.review.orderBy("row_number").collect()]
    assert lines[0] == "Row 2: 2 (confidence: 8.3%)" and len(lines) == 10
    meta = stored.metadata.first()
    assert (meta.n_high, meta.n_low, meta.models, meta.runs, meta.delay, meta.within_threshold) == (10, 10, MODELS, 4, 0.5, None)
    assert calls.value == 20 * 3 * 4
    none = run_analysis(
        spark, wide, str(tmp_path / "out2"), identifier="Identifier", prompt="p", models=MODELS, runs=4, append_metadata=False
    )
    assert none.metadata is None


def test_null_content_is_not_asked(spark):
    df = spark.createDataFrame([(1, None), (2, "x y")], "id int, body string")
    rows = text_analysis(
        df, id_col="id", content_col="body", prompt="Say:", models=["m"], runs=1, open_responder=replay.replay_texts("Say:")
    ).orderBy("Identifier").collect()
    assert rows[0]["Response_1 (m)"] is None and (rows[0]["Consensus (m)"], rows[0]["Consensus_Confidence (m)"]) == ("", 0.0)
    assert "BetweenModel_Consensus" not in rows[0].asDict()


def test_aggregated_outputs(spark):
    a = spark.createDataFrame([(1, "red car", "Red bus")], ["id", "Response 1", "Response 2"])
    b = spark.createDataFrame([(2, "x", "y", 3)], ["id", "Response 1", "Response 3", "Other"])
    got = {r["id"]: r for r in abstracts.aggregate_outputs([a, b]).collect()}
    assert (got[1]["Consensus Result"], got[1]["Consensus over Total"]) == ("red", 1 / 3)
    assert (got[2]["Consensus Result"], got[2]["Consensus over Total"], got[2]["Other"]) == ("no consensus", 0.0, 3)


def test_abstract_presets(spark):
    export = spark.createDataFrame([tuple(f"c{i}" for i in range(11)), (*(f"d{i}" for i in range(10)), None)], [f"f{i}" for i in range(11)])

    def open_responder():
        return lambda model, run, batch: [f" {model} {run} {p[-3:]}\n" for p in batch["prompt"]]

    got = abstracts.abstract_presets(export, open_responder, runs=2).where("theme = 'methods'").orderBy("Title").collect()
    assert tuple(got[0]) == ("methods", "c2", "c3", "c4", "c10", " gemma2 1 c10\n", " gemma2 2 c10\n")
    assert got[1]["Response 1"] == "Error: No response"
