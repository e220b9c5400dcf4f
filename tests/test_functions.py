import random

import pytest
from pyspark.sql import functions as F

from replivote.functions import similarity, text
from replivote.functions.rounding import ratio3
from tests import plain

ODD = [
    "", " ", "\n", "???", "__x__", "  Red  Car. ", "a\r\nb", "½ cup½", "x²", "\xa0nbsp\xa0 in\xa0side\xa0",
    "ÉCOLE à la mode!", "-- a - b --", "\x1fx\x1f y", "ΣΑΣ", "a_b_", "1,2;3", "日本 語。", "(tree)", "\t tab\tbed \x0b",
    "a, b; ;, A", "ﬁn de ligne", "é" * 300 + "!" * 300 + "z" + "." * 300,
]


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_normalize(spark):
    assert column(spark, ODD, text.normalize) == [plain.norm(s) for s in ODD]


def test_split_set(spark):
    assert column(spark, ODD, text.split_set) == [plain.items(s) for s in ODD]


def test_strip_and_clean(spark):
    assert column(spark, ODD, text.strip) == [s.strip() for s in ODD]
    assert column(spark, ODD, text.clean_response) == [s.strip().replace("\r", " ").replace("\n", " ") for s in ODD]


def test_tokenize_and_light(spark):
    import re

    assert column(spark, ODD, text.tokenize) == [re.split(r"\s+", s.lower()) for s in ODD]
    assert column(spark, ODD, text.normalize_light) == [re.sub(r"\s+", " ", s.lower().strip()) for s in ODD]


def test_null_stays_null(spark):
    for f in (text.normalize, text.split_set, text.clean_response, text.tokenize, text.normalize_light):
        assert column(spark, [None], f) == [None]


def test_ratio_rounds_like_binary_floats(spark):
    pairs = [(k, n) for n in range(1, 260) for k in range(n + 1)]
    df = spark.createDataFrame(pairs, "k long, n long").select("k", "n", ratio3(F.col("k"), F.col("n")).alias("r"))
    assert all(r.r == round(r.k / r.n, 3) for r in df.collect())
    assert spark.range(1).select(ratio3(F.lit(0), F.lit(0))).first()[0] is None


def test_common_subsequence_of_long_strings():
    rng = random.Random(1)
    for size in (1, 5, 59, 60, 61, 64, 65, 200, 700):
        a = "".join(rng.choice("abcdé ") for _ in range(size))
        b = "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, size + 20)))
        assert similarity.common_subsequence(a, b) == plain.lcs(a, b) == similarity.common_subsequence(b, a)


def test_token_set_score():
    rng = random.Random(2)
    vocabulary = ["red", "car", "cars", "automobile", "a", "tree", "trees", "über"]
    for _ in range(500):
        a, b = (" ".join(rng.choices(vocabulary, k=rng.randint(0, 5))) for _ in "ab")
        assert similarity.token_set_score(a, b) == pytest.approx(plain.token_set(a, b), abs=1e-9)


def test_similarity_column(spark):
    pairs = [("a b", "b a"), ("", "x"), ("", ""), ("tree", "trees"), ("x", "x"), (None, "x"), ("long " * 40, "lung " * 39)]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    got = [r[0] for r in df.select(similarity.token_set_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [None if a is None else similarity.token_set_score(a, b) for a, b in pairs]
    assert got[3] == pytest.approx(88.888888, abs=1e-5)


def test_every_white_space_collapses(spark):
    texts = [f"a{c}{d}b{c}c, {c} d" for c in text.WHITE_SPACE for d in ("", " ", "\u2013")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", text.normalize(F.col("t")).alias("n"), F.array_join(text.split_set(F.col("t")), "|").alias("s")).collect()
    assert all(r["n"] == " ".join(r["t"].split()) and r["s"] == "|".join(" ".join(p.split()) for p in r["t"].split(",")) for r in got)


def test_split_set_of_odd_lists(spark):
    local = random.Random(2)
    alphabet = [*",;,;. -_'\n\u0391\u03a3\u0130\u00df", "a", "B", "9", "  ", "\u4e00"]
    lists = ["".join(local.choices(alphabet, k=local.randint(0, 14))) for _ in range(3000)] + ["-" * 200_000 + ",a", "a" + " ." * 100_000]
    df = spark.createDataFrame([(x,) for x in lists], "t string")
    cores = F.transform(F.split(text._collapse(F.col("t")), "[,;]+"), lambda p: F.regexp_extract(F.lower(p), text._CORE, 1))
    by_part = F.array_distinct(F.filter(cores, lambda p: p != ""))
    assert df.where(~text.split_set(F.col("t")).eqNullSafe(by_part)).count() == 0


def test_ends_of_long_texts(spark):
    """Ends are cut as bytes where they hold a letter or digit; elsewhere, and in short texts, by the whole pattern."""
    far, near = "\u3000" * 70, " \u2003\U0001f600."
    cores = ["Straße  \t\u3000Ο∆ΟΣ " * 20 + "ΟΔΟΣ", "漢" * 100, "𝐀" + " x" * 150, "a", "½" + "-" * 300 + "²"]
    texts = [a + c + b for c in cores for a in ("", near, far) for b in ("", near, far)] + [far, near * 80, "\ufffd" * 90, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", text.normalize(F.col("t")).alias("n"), text.is_blank(F.col("t")).alias("b"), F.octet_length("t").alias("o")).collect()
    assert len(got) == len(texts) and max(r["o"] or 0 for r in got) > 4 * text._END
    for r in got:
        assert r["b"] == (r["t"] is None or not r["t"].strip())
        assert r["n"] == (None if r["t"] is None else plain.norm(r["t"]))


def test_blanks_at_the_ends_replace_nothing(spark):
    """White space at the ends alone sends no whole text through the replacing of white space."""
    df = spark.createDataFrame([("  " + "Long text. " * 60 + " \t",)], "t string")
    cut = text._bound(F.lower("t"), text._core)
    uneven = df.select(F.contains(cut, F.lit("  ")) | F.rlike(cut, F.lit(text._PERHAPS_UNEVEN))).collect()
    assert uneven == [(False,)]
    plan = df.select(text.normalize(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert "regexp_replace(" in plan and "regexp_replace(t#" not in plan  # what is replaced is the cut text
