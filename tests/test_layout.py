"""What is moved and how finely it is dealt, read from plans."""

import random

from pyspark.sql import functions as F

from checks import replay
from checks.queries import QUERIES
from replivote import session
from replivote.operators import consensus
from replivote.sources import tables

TABLES = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_answers_are_named_without_a_join(spark):
    plan = _plan(QUERIES["pair_similarity"](spark, TABLES))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_rows_of_answers_are_not_dealt_by_key(spark):
    plan = _plan(QUERIES["reorder_columns"](spark, TABLES))
    assert "hashpartitioning" not in plan
    # where one file is dealt over the cores, its texts move, not the answers made of them
    assert "variant" not in plan[plan.index("Exchange") :]


def test_long_answers_move_as_texts(spark):
    plan = _plan(replay.responses(spark, TABLES))
    assert "variant" not in plan[plan.index("Exchange hashpartitioning") :]



def test_shares_follow_the_bytes_of_the_files(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(path)
    scan = spark.read.parquet(path).select("id", "text")
    assert session.spread(scan, "id").rdd.getNumPartitions() == 4
    monkeypatch.setattr(session, "SHARE", 10_000)
    assert session.spread(scan, "id").rdd.getNumPartitions() > 10
    assert session.spread(spark.createDataFrame([(1, "a")], "id int, text string"), "id").rdd.getNumPartitions() < 10


def test_stored_results_are_packed(spark, tmp_path):
    local = random.Random(1)
    said = [" ".join(local.choices(["oak", "elm", "fir", "yew", "ash", "box"], k=400)) for _ in range(200)]
    table = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "id int, `Response_1 (a.b)` string").repartition(1)
    size = lambda p: sum(f.stat().st_size for f in p.glob("*.parquet"))
    table.write.parquet(str(tmp_path / "plain"))
    tables.write_table(table, str(tmp_path / "sink"))
    assert size(tmp_path / "sink") < 0.8 * size(tmp_path / "plain")
    assert sorted(spark.read.parquet(str(tmp_path / "sink")).collect()) == sorted(table.collect())


def test_words_of_sources_are_counted_where_texts_are_read(spark, monkeypatch):
    monkeypatch.setattr(consensus, "GATHERED", 0)  # so few documents would vote in rows
    plan = _plan(QUERIES["consensus_words_by_source"](spark, TABLES))
    assert "hashpartitioning(doc_id" not in plan and "MapInArrow" in plan
