"""The parts that the model of personal data is trained on."""

from replivote.llm import pii


def test_copies_of_a_part_count_once(spark):
    parts = [f"write to user{i}@mail{i}.example.com today" for i in range(30)] + [f"host 10.0.{i}.7 is down" for i in range(30)]
    rows = [(p,) for p in parts] + [(parts[i],) for i in (3, 40) for _ in range(2000)]
    got = pii.labelled_parts(spark.createDataFrame(rows, "text string").repartition(5), sample=50).collect()
    once = pii.labelled_parts(spark.createDataFrame([(p,) for p in parts], "text string"), sample=50).collect()
    assert len({r["text"] for r in got}) == 50
    assert [(r["text"], r["spans"]) for r in got] == [(r["text"], r["spans"]) for r in once]
