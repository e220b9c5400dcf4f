"""The registered queries on text against their SQL, and the stages of the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from replivote.llm.common import stored, table
from replivote.llm.queries import ORACLES, QUERIES
from tests.llm import plain

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    answer = con.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    rows = QUERIES[name](spark, SF)
    assert sorted(rows.columns) == sorted(columns)
    want = answer.fetchall()
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in rows.collect()))) == sorted(map(str, want)) and want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_of_every_document(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.count() == got.select("doc_id").distinct().count() == 200


def test_every_stage(spark):
    """Each stage on what the one before kept, against plain statements of what it must do."""
    docs = table(spark, SF, "documents")
    columns, labels = docs.columns, {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        gone = set(before) - set(after)
        if name == "toxicity":
            assert sum(labels.get(d) == 0 for d in gone) == 0 and sum(labels.get(d) == 1 for d in gone) >= sum(labels.get(d) == 1 for d in after)
        elif name == "near_duplicates":
            component = plain.near_duplicates([(k, r["text"]) for k, r in before.items()], 5)
            assert gone == {k for k, c in component.items() if c != k}
        elif name == "decontamination":
            assert gone == {d for d, *_ in plain.contaminated([(k, r["text"]) for k, r in before.items()], items)}
        elif name == "personal_data":
            assert not gone
            for k, r in before.items():
                found = [s for spans in plain.personal(r["text"]).values() for s in spans]
                assert all(r["text"][a:b] not in after[k]["text"] for a, b in found)
                assert found or after[k]["text"] == r["text"] or "<" in after[k]["text"]
                assert after[k]["n_chars"] == len(after[k]["text"])
        else:
            counts = {k: sum(r["doc_id"] == k for r in rows) for k in before}
            assert max(counts.values()) <= 2 and all(r == before[r["doc_id"]] for r in rows)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_stages_take_awkward_rows(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "a", None), (2, "", None, None, 0), (3, "x " * 3000, "en", "a", 6000), (3, "x " * 3000, "en", "a", 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).count() == len(rows), name
        assert stage(spark, docs.where(F.lit(False)), SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns == docs.columns
