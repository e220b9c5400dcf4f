"""A broken run is taken up where it stopped, and no stored answer is asked for again."""

import os
from collections import Counter

import pytest

from replivote.operators.answer_store import annotate_resumable, pending_units


def counting(folder, broken=None):
    """A responder that notes every call on disk, and fails the whole job for one model's key."""

    def open_responder():
        def respond(model, run, batch):
            with open(f"{folder}/{os.getpid()}", "a") as f:
                f.writelines(f"{model}|{k}|{run}\n" for k in batch["key"])
            if broken and model == broken[0] and broken[1] in batch["key"]:
                os._exit(1)
            return [f"{p} by {model}, run {run}" for p in batch["prompt"]]

        return respond

    return open_responder


def calls(folder):
    return Counter(line.strip() for name in os.listdir(folder) for line in open(f"{folder}/{name}"))


def test_a_broken_run_is_resumed(spark, tmp_path):
    rows = [(i, f"p{i}", "x") for i in range(40)] + [(7, "p7", "again"), (None, "none", "x"), (50, None, "x")]
    tasks = spark.createDataFrame(rows, "id long, prompt string, more string").repartition(3)
    store, noted = str(tmp_path / "store"), tmp_path / "calls"
    noted.mkdir()
    args = dict(key="id", keep=["more"], buckets=3)
    with pytest.raises(Exception):
        annotate_resumable(tasks, ["a", "b"], 2, counting(noted, ("b", 11)), store, **args)
    before = calls(noted)
    left = {(r["model"], r["bucket"]) for r in pending_units(spark, store, ["a", "b"], 3).collect()}
    assert left and all(m == "b" for m, _ in left)
    again = tmp_path / "again"
    again.mkdir()
    nothing = tasks.where("false")  # the stored rows are asked, whatever is handed over now
    got = annotate_resumable(nothing, ["a", "b"], 2, counting(again), store, **args).collect()
    want = Counter((k, more, m, run, None if p is None else f"{p} by {m}, run {run}", "missing" if p is None else "ok") for k, p, more in rows for m in "ab" for run in (1, 2))
    assert Counter((r["id"], r["more"], r["model"], r["run"], r["response"], r["status"]) for r in got) == want
    asked = calls(again)
    assert asked and all(c.startswith("b|") for c in asked) and not any(c.startswith("a|") for c in asked)
    assert all(n == (2 if "|7|" in c else 1) for c, n in before.items() if c.startswith("a|"))
    third = tmp_path / "third"
    third.mkdir()
    assert annotate_resumable(nothing, ["a", "b"], 2, counting(third), store, **args).count() == len(got) and not calls(third)
    with pytest.raises(ValueError):
        annotate_resumable(tasks, ["a", "b"], 3, counting(third), store, **args)


def test_units_by_and_by(spark, tmp_path):
    tasks = spark.createDataFrame([(i, f"p{i}") for i in range(10)], "id long, prompt string")
    noted, store = tmp_path / "calls", str(tmp_path / "store")
    noted.mkdir()
    sizes = [annotate_resumable(tasks, ["a", "b"], 1, counting(noted), store, key="id", buckets=2, units=1).count() for _ in range(4)]
    assert sizes == sorted(sizes) and sizes[-1] == 20 and set(calls(noted).values()) == {1}
    empty = annotate_resumable(tasks.where("false"), ["a"], 1, counting(noted), str(tmp_path / "none"), key="id", buckets=2)
    assert empty.count() == 0
