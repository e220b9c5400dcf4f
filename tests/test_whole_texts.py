"""Fuzzy votes on whole texts under a hot key, against a plain statement of the greedy grouping."""

import random

import __spark_entry__ as entry
from checks import replay, workbook_files
from tests import plain


def test_fuzzy_votes_of_a_hot_source(spark, tmp_path):
    local = random.Random(8)
    words = [a + b for a in ("oak", "elm", "ash", "fir", "yew", "box", "bay") for b in ("", "s", "en", "wood", "leaf", "tree")]
    texts = ["\n".join(" ".join(local.choices(words, k=5)) for _ in range(3)) for _ in range(34)]
    texts += [t.replace(" ", " new ", 1) for t in texts[:6]]  # near copies
    rows = [(i, t, "rare" if i % 20 == 7 else "hot") for i, t in enumerate(texts)] + [(len(texts), None, "rare")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    said = replay.responses(spark, str(tmp_path), "source").orderBy("doc_id", "run", "model_idx").collect()
    answers = {s: [r["response"] for r in said if r["source"] == s] for s in ("hot", "rare")}
    assert len({plain.norm(a) for a in answers["hot"]}) > 128  # more than one block
    got = entry.queries()["consensus_fuzzy_by_source_texts"](spark, str(tmp_path)).collect()
    assert {r["source"]: (r["consensus"], r["confidence"]) for r in got} == {s: plain.vote(a, "fuzzy") for s, a in answers.items()}


def test_every_registered_table_vote():
    assert {f"block_{mode}" for mode in ("exact", "set", "fuzzy")} <= set(entry.oracle_sql())


def test_workbooks_of_a_run_are_several(spark, monkeypatch):
    """A multi-file numbered run keeps item order; its SQL is in test_queries."""
    made, write = [], workbook_files.write_workbooks

    def counted(df, folder):
        made.append(df.rdd.getNumPartitions())
        return write(df, folder)

    monkeypatch.setattr(workbook_files, "write_workbooks", counted)
    for name in ("run_analysis", "aggregate_folder"):
        entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert len(made) == 3 and min(made) > 1
