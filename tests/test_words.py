import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replivote.functions import text, words
from replivote.operators import consensus as con
from replivote.plans.abstracts import aggregate_outputs
from tests import plain


def test_words_are_cut_as_columns_cut_them(spark):
    local = random.Random(3)
    pieces = ["a", "B", "\u00c9", "\u0130x", "\u03a3", "\u200b", "\u180e", *text.WHITE_SPACE]
    said = ["", " ", "\u3000\u3000", *["".join(local.choices(pieces, k=local.randint(1, 9))) for _ in range(300)]]
    said += [f"a{c}b" for c in map(chr, range(0x3100)) if not 0xD800 <= ord(c) < 0xE000]
    df = spark.createDataFrame([(s,) for s in said], "said string").select(F.lower("said").alias("low"), text.tokenize(F.col("said")).alias("cut"))
    for low, cut in df.collect():
        assert words.split_words(low) == cut
        assert words.split_all(pa.array([low])).to_pylist() == [cut]


def test_equal_answers_are_cut_once(monkeypatch):
    cut = []
    split = words.split_words
    monkeypatch.setattr(words, "split_words", lambda t: cut.append(t) or split(t))
    assert words._repeated(["x y", "z x", "x y", "", ""]) == ("x y ", 3, 4)
    assert cut == ["x y", "z x", ""]


def test_finished_tables_are_counted_without_sorting_words(spark):
    said = [("a b", "b  c", None), (None, None, None), ("one", "two", "three"), ("w " * 5000, "", "W")]
    table = spark.createDataFrame([(i, *row) for i, row in enumerate(said)], "id int, Response_1 string, Response_2 string, Response_3 string")
    voted = aggregate_outputs([table])
    plan = voted._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "sort_array" not in plan
    got = {r["id"]: (r["Consensus Result"], r["Consensus over Total"]) for r in voted.collect()}
    assert got == {i: plain.words([a for a in row if a is not None]) for i, row in enumerate(said)}


def _votes(spark):
    local = random.Random(9)
    pieces = ["red car", "Red  car", "car", "", " ", None, "tree\tbush", "bush tree", " a", "b "]
    rows = [(k, run, local.choice(pieces)) for k in range(60) for run in range(local.randint(1, 9))]
    rows += [(100, 3, "x y"), (100, 3, "y x"), (101, None, "b a"), (101, 1, "a b"), (None, 1, "n n"), (None, 1, "m")]  # tied, without order
    return spark.createDataFrame(rows, "id int, run int, response string").repartition(3)


@pytest.mark.parametrize("vote", [con.consensus_words, con.consensus_words_documented])
def test_word_votes_of_few_and_of_many_answers_agree(spark, monkeypatch, vote):
    votes_ = _votes(spark)
    found = []
    for most in (256, 4, 0):
        monkeypatch.setattr(con, "GATHERED", most)
        found.append(sorted((tuple(r) for r in vote(votes_, ["id"]).collect()), key=repr))
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("vote", [con.consensus_words, con.consensus_words_documented])
def test_words_of_few_answers_are_no_rows(spark, vote):
    plan = vote(_votes(spark).where("id < 100"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "ArrowEvalPython" in plan


def test_set_votes_of_few_and_of_many_answers_agree(spark, monkeypatch):
    local = random.Random(13)
    pieces = ["oak, elm", "elm; oak", "Oak", "", None, "fir, oak, fir", "yew", ",;", "ash; yew, elm"]
    rows = [(k, run, local.choice(pieces), local.choice(["ok", "ok", "error"])) for k in range(60) for run in range(local.randint(1, 9))]
    rows += [(100, 3, "x, y", "ok"), (100, 3, "y; x", "ok"), (101, None, "b, a", "ok"), (101, 1, "a; c", "ok"), (None, 1, "n", "ok")]
    votes_ = spark.createDataFrame(rows, "id int, run int, response string, status string").repartition(3)
    for errors_vote in (True, False):
        found = []
        for most in (256, 4, 0):
            monkeypatch.setattr(con, "GATHERED", most)
            voted = con.consensus_set(votes_, ["id"], errors_vote=errors_vote)
            found.append(sorted((tuple(r) for r in voted.collect()), key=repr))
        assert found[0] == found[1] == found[2]
    monkeypatch.setattr(con, "GATHERED", 256)
    few = con.consensus_set(votes_.where("id < 100"), ["id"])
    assert "posexplode" not in few._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("order, size", [("int", 100), ("long", 1 << 20), ("decimal(28,0)", 300)])
def test_words_are_counted_in_tasks_as_rows_are(spark, monkeypatch, order, size):
    monkeypatch.setattr(words, "_BYTES", size)
    local = random.Random(17)
    pieces = ["a", "b", "c c", " d", "", "e f g", "a b ", "h"]
    rows = [(local.choice("xyz"), local.choice([None, *range(-3, 12)]), local.choice([None, " ".join(local.choices(pieces, k=4))])) for _ in range(400)]
    rows += [(None, 1, "z"), ("w", 1, None)]
    df = spark.createDataFrame(rows, "k string, o int, _said string").repartition(3)
    answers = df.select("k", F.col("o").cast(order).alias("_order"), "_said")
    assert words.countable(answers, ["k"])
    counted = con._word_items(answers, ["k"], text.tokenize)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    listed = con._items(answers, ["k"], F.coalesce(text.tokenize(F.col("_said")), F.array().cast("array<string>")))
    as_rows = lambda d: sorted((tuple(r) for r in d.select("k", "_item", "_ct", F.when(F.col("_item").isNotNull(), F.col("_first"))).collect()), key=repr)
    assert as_rows(counted) == as_rows(listed)
