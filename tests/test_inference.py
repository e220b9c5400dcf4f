"""Lookup tables, F and t tests, digit codes and grades against closed forms and plain code."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from replivote.operators import digits, grading, inference


def col(spark, rows, names):
    return spark.createDataFrame(rows, names).coalesce(1)


def test_beta_share_is_a_binomial_sum(spark):
    cases = [(x, a, b) for x in (Fraction(1, 64), Fraction(1, 4), Fraction(1, 2), Fraction(7, 8), Fraction(63, 64)) for a, b in ((1, 1), (2, 5), (30, 4), (3, 200), (150, 170))]
    want = [float(sum(math.comb(a + b - 1, j) * x**j * (1 - x) ** (a + b - 1 - j) for j in range(a, a + b))) for x, a, b in cases]
    df = col(spark, [(i, float(x), float(a), float(b)) for i, (x, a, b) in enumerate(cases)], "i int, x double, a double, b double")
    got = {r["i"]: r["s"] for r in df.select("i", inference.beta_share(F.col("x"), F.col("a"), F.col("b")).alias("s")).collect()}
    assert all(abs(got[i] - w) < 1e-11 for i, w in enumerate(want))


def test_tails_have_their_closed_forms(spark):
    fs = [(f, d) for f in (0.0, 0.01, 0.5, 1.0, 3.7, 40.0) for d in (1.0, 4.0, 33.0, 5000.0, 1e7)]
    df = col(spark, fs, "f double, d double").select("f", "d", inference.f_tail(F.col("f"), F.lit(2.0), F.col("d")).alias("p"))
    for r in df.collect():
        assert abs(r["p"] - math.exp(-r["d"] / 2 * math.log1p(2 * r["f"] / r["d"]))) < 1e-9
    ts = [(t,) for t in (-30.0, -2.5, 0.0, 0.3, 1.0, 12.0)]
    df = col(spark, ts, "t double").select("t", *[inference.t_tails(F.col("t"), F.lit(d)).alias(n) for n, d in (("one", 1.0), ("two", 2.0), ("many", 4e6))])
    for r in df.collect():
        t = abs(r["t"])
        assert abs(r["one"] - (1 - 2 / math.pi * math.atan(t))) < 1e-9 and abs(r["two"] - (1 - t / math.sqrt(2 + t * t))) < 1e-9
        assert abs(r["many"] - math.erfc(t / math.sqrt(2))) < 1e-6


def groups_of(seed):
    local = random.Random(seed)
    rows = [(g, local.gauss(0.3 * (g or 0), 1 + (g or 0) / 3)) for g in (0, 1, 2, 3, None) for _ in range(local.randint(3, 30))]
    return rows + [(4, 2.0), (1, None)]


def test_anova_and_welch_against_plain_code(spark):
    rows = groups_of(5)
    df = spark.createDataFrame(rows, "g int, x double").repartition(4)
    by = {}
    for g, x in rows:
        if x is not None:
            by.setdefault(g, []).append(x)
    every = [x for v in by.values() for x in v]
    mean = lambda v: sum(v) / len(v)
    var = lambda v: sum((x - mean(v)) ** 2 for x in v) / (len(v) - 1)
    between = sum(len(v) * (mean(v) - mean(every)) ** 2 for v in by.values()) / (len(by) - 1)
    within = sum((x - mean(v)) ** 2 for v in by.values() for x in v) / (len(every) - len(by))
    r = inference.one_way_anova(df, "g", "x").first()
    assert (r["n"], r["groups"]) == (len(every), len(by)) and r["f"] == pytest.approx(between / within, rel=1e-12) and 0 < r["p"] < 1
    tests = {r["g"]: r for r in inference.against_the_rest(df, "g", "x").collect()}
    assert set(tests) == set(by) and tests[4]["t"] is None and tests[4]["p_holm"] is None
    able = sorted((r for r in tests.values() if r["p"] is not None), key=lambda r: r["p"])
    worst = 0.0
    for i, r in enumerate(able):
        own = by[r["g"]]
        rest = [x for g, v in by.items() if g != r["g"] for x in v]
        a, b = var(own) / len(own), var(rest) / len(rest)
        assert r["t"] == pytest.approx((mean(own) - mean(rest)) / math.sqrt(a + b), rel=1e-9)
        assert r["df"] == pytest.approx((a + b) ** 2 / (a * a / (len(own) - 1) + b * b / (len(rest) - 1)), rel=1e-9)
        worst = max(worst, min(1.0, (len(able) - i) * r["p"]))
        assert r["p_holm"] == pytest.approx(worst, rel=1e-9)


def test_tests_without_enough_values(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("b", 1, 1.0), ("b", 2, 1.0), ("c", 1, 5.0), ("c", 1, 5.0), ("c", 2, 5.0), ("c", 2, 5.0)], "k string, g int, x double")
    got = {r["k"]: r for r in inference.one_way_anova(df, "g", "x", ["k"]).collect()}
    assert {k: (r["n"], r["groups"], r["f"]) for k, r in got.items()} == {"a": (2, 1, None), "b": (2, 2, None), "c": (4, 2, None)}
    assert all(r["t"] is None and r["p_holm"] is None for r in inference.against_the_rest(df, "g", "x", ["k"]).collect())
    assert inference.one_way_anova(df.where("false"), "g", "x").count() == 0


def test_looked_up_words(spark):
    lookup = spark.createDataFrame([("red", 1.0), ("blue", 2.0)], "word string, value double")
    df = spark.createDataFrame([(1, "Red; blue, RED."), (2, "green"), (3, None), (4, " ,; ")], "id int, said string")
    assert [tuple(r) for r in inference.looked_up(df, "said", lookup).select("id", "word", "value").orderBy("id", "word").collect()] == [(1, "blue", 2.0), (1, "red", 1.0), (2, "green", None)]


def test_digit_codes_round_trip(spark):
    book = {"storeys": ["one", "two"], "style": [f"s{i}" for i in range(12)], "roof": ["flat"], "none": []}
    local = random.Random(1)
    rows = [(i, *[local.choice([None, *words]) if words else None for words in book.values()]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, storeys string, style string, roof string, none string")
    coded = digits.with_digits(df, book)
    assert coded.where("size(unknown) > 0").count() == 0
    assert sorted(map(str, digits.decoded(coded.select("id", "code"), book).drop("code").collect())) == sorted(map(str, df.collect()))
    one = spark.createDataFrame([(1, "two", "s4", "dome", None)], df.schema)
    r = digits.with_digits(one, book).first()
    assert (r["code"], r["unknown"]) == (2_05_0_0, ["roof"])
    with pytest.raises(ValueError):
        digits.places({"a": ["x", "x"]})
    with pytest.raises(ValueError):
        digits.places({f"c{i}": ["x"] for i in range(19)})


def judge():
    def respond(model, run, batch):
        return [ValueError("down") if "fail" in p else f"I say {len(p.rsplit('Response: ', 1)[1])} of 10" for p in batch["prompt"]]

    return respond


def test_grades_ranks_and_friedman(spark):
    local = random.Random(4)
    rows = [(i, m, "x" * local.choice(sizes), "ok") for i in range(30) for m, sizes in (("a", [1, 2, 3]), ("b", [2, 3, 4]), ("c", [5, 6]))]
    rows += [(40, "a", "fail", "ok"), (40, "b", "x", "ok"), (41, "a", "x" * 11, "ok"), (41, "b", None, "missing"), (42, "c", "Error", "error"), (42, "b", " ", "ok")]
    said = spark.createDataFrame([(f"{i}{m}", i, m, r, s) for i, m, r, s in rows], "key string, item int, model string, response string, status string")
    graded = grading.graded(said, F.lit("q"), "j", judge, key="key")
    assert graded.where("item >= 40 and grade is not null").select("item", "model", "grade").collect() == [(40, "b", 1.0)]
    ranks = grading.ranked_grades(graded, "item")
    got = {(r["item"], r["model"]): r for r in ranks.collect()}
    assert len(got) == 90
    total, ties = {"a": 0.0, "b": 0.0, "c": 0.0}, 0
    for i in range(30):
        mine = {m: len(r) for j, m, r, _ in rows if j == i}
        for m, g in mine.items():
            place = sum(x < g for x in mine.values()) + (sum(x == g for x in mine.values()) + 1) / 2
            assert got[i, m]["place"] == place
            total[m] += place
        ties += sum(t**3 - t for t in (list(mine.values()).count(g) for g in set(mine.values())))
    chi = (12 / (30 * 3 * 4) * sum(r * r for r in total.values()) - 3 * 30 * 4) / (1 - ties / (30 * 3 * 8))
    r = grading.friedman(ranks).first()
    assert r["chi_squared"] == pytest.approx(chi) and r["f"] == pytest.approx(29 * chi / (60 - chi)) and r["p"] < 1e-6
    even = spark.createDataFrame([(i, m, 1.0) for i in range(4) for m in "ab"], "item int, model string, grade double")
    r = grading.friedman(grading.ranked_grades(even, "item")).first()
    assert (r["chi_squared"], r["f"], r["p"]) == (None, None, None)
    found = {r["model"]: r for r in grading.bootstrap_differences(ranks, "a", "item").collect()}
    again = {r["model"]: r for r in grading.bootstrap_differences(ranks.repartition(7), "a", "item").collect()}
    assert {m: r["low"] for m, r in found.items()} == pytest.approx({m: r["low"] for m, r in again.items()})
    assert set(found) == {"b", "c"} and all(r["low"] <= r["difference"] <= r["high"] for r in found.values()) and found["c"]["low"] > found["b"]["high"]


def test_grade_of_a_reply(spark):
    df = spark.createDataFrame([("Grade: 7/10",), ("-3",), ("8.5",), ("none",), ("11",), (None,)], "r string")
    assert [r[0] for r in df.coalesce(1).select(grading.grade_of(F.col("r"))).collect()] == [7.0, None, 8.5, None, None, None]
