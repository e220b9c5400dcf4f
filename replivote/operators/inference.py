"""Words coded by a lookup table, and tests of whether groups of the values differ."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replivote.functions.text import split_set


def looked_up(df: DataFrame, words: str, lookup: DataFrame, *, word: str = "word", value: str = "value") -> DataFrame:
    """One row per word of an answer, in alphabetical order: the columns of ``df``, ``word``, ``value``.

    Words are the normalised parts of a comma list, each taken once. ``lookup`` holds each word once,
    as it is normalised; what it does not hold has a null value. Rows without a word are left out.
    """
    each = df.withColumn("word", F.explode(F.array_sort(split_set(F.col(words)))))
    known = lookup.select(F.col(word).alias("_word"), F.col(value).alias("value"))
    return each.drop("value").join(known, each["word"] == known["_word"], "left").drop("_word")


def _series(z: Column) -> Column:
    """What Stirling's formula adds to its main part, exact to the last digits from ten on."""
    return 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) + 1 / (1188 * z**9)


def _log_gamma(x: Column) -> Column:
    """Stirling's formula, ten steps up."""
    z, down = x + 10, F.lit(0.0)
    for i in range(10):
        down = down + F.log(x + i)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + _series(z) - down


def _log_beta(a: Column, b: Column) -> Column:
    """Logarithm of the beta function. The larger parameter enters by a difference that keeps its digits."""
    low, high = F.least(a, b), F.greatest(a, b)
    z, down = high + 10, F.lit(0.0)
    for i in range(10):
        down = down + F.log1p(low / (high + i))
    rise = low * F.log(z + low) + (z - 0.5) * F.log1p(low / z) - low + _series(z + low) - _series(z) - down
    return _log_gamma(low) - rise


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """Continued fraction of the incomplete beta function, for ``x`` up to ``(a + 1) / (a + b + 2)``.

    It takes about the root of the larger parameter in terms, so that is how many are taken.
    """
    tiny = F.lit(1e-300)
    off = lambda v: F.when(F.abs(v) < 1e-300, tiny).otherwise(v)
    terms = (F.lit(60) + 6 * F.ceil(F.sqrt(F.greatest(a, b)))).cast("int")
    d0 = 1 / off(1 - (a + b) * x / (a + 1))

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d1, c1 = 1 / off(1 + even * s["d"]), off(1 + even / s["c"])
        d2, c2 = 1 / off(1 + odd * d1), off(1 + odd / c1)
        return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d1 * c1 * d2 * c2).alias("h"))

    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
    places = F.transform(F.sequence(F.lit(1), terms), lambda m: m.cast("double"))
    return F.aggregate(places, start, step, lambda s: s["h"])


def beta_share(x: Column, a: Column, b: Column, rest: Column | None = None) -> Column:
    """The regularised incomplete beta function. ``rest`` is ``1 - x``, for where that is known to more digits."""
    rest = 1 - x if rest is None else rest
    log_x, log_rest = (F.when(v > 0.5, F.log1p(-w)).otherwise(F.log(v)) for v, w in ((x, rest), (rest, x)))
    front = F.exp(a * log_x + b * log_rest - _log_beta(a, b))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b), F.when(swap, rest).otherwise(x)
    share = front * _beta_fraction(y, p, q) / p
    inner = F.when(swap, 1 - share).otherwise(share)
    return F.when(x <= 0, 0.0).when(rest <= 0, 1.0).otherwise(inner)


def f_tail(f: Column, between: Column, within: Column) -> Column:
    """Chance of an F value this large or larger."""
    whole = within + between * f
    return beta_share(within / whole, within / 2, between / 2, between * f / whole)


def t_tails(t: Column, df: Column) -> Column:
    """Chance of a t value this far from zero or farther, on both sides."""
    return beta_share(df / (df + t * t), df / 2, F.lit(0.5), t * t / (df + t * t))


def group_moments(df: DataFrame, group: str, value: str, within: Sequence[str] = ()) -> DataFrame:
    """``within, group, n, mean, m2``: size, mean and summed squared distance from it. Null values are left out.

    Moments are combined before the shuffle, so a group of any size leaves a task as one row.
    """
    x = F.col(value).cast("double")
    sums = df.where(x.isNotNull()).groupBy(*within, group)
    return sums.agg(F.count("*").alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count("*")).alias("m2"))


def _totals(moments: DataFrame, within: Sequence[str]) -> DataFrame:
    """Moments with the size, mean and squared distances of all groups together; a row per group is moved."""
    every = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    sized = moments.withColumn("_n", F.sum("n").over(every)).withColumn("_mean", F.sum(F.col("n") * F.col("mean")).over(every) / F.col("_n"))
    apart = F.col("n") * (F.col("mean") - F.col("_mean")) ** 2
    return sized.withColumns({"_between": F.sum(apart).over(every), "_within": F.sum("m2").over(every)})


def one_way_anova(df: DataFrame, group: str, value: str, within: Sequence[str] = ()) -> DataFrame:
    """``within, n, groups, df_between, df_within, f, p``: do the groups' means differ?

    A null group is one of its own. With one group, or no more values than groups, or equal
    values inside every group, ``f`` and ``p`` are null. Without values there is no row.
    """
    every = _totals(group_moments(df, group, value, within), within)
    sums = every.groupBy(*within).agg(
        F.sum("n").alias("n"), F.count("*").alias("groups"), F.max("_between").alias("_between"), F.max("_within").alias("_within")
    )
    sums = sums.where(F.col("groups") > 0).withColumns({"df_between": F.col("groups") - 1, "df_within": F.col("n") - F.col("groups")})
    able = (F.col("df_between") > 0) & (F.col("df_within") > 0) & (F.col("_within") > 0)
    f = F.when(able, F.try_divide(F.try_divide("_between", "df_between"), F.try_divide("_within", "df_within")))
    named = sums.withColumn("f", f)
    p = F.when(F.col("f").isNotNull(), f_tail(F.col("f"), F.col("df_between").cast("double"), F.col("df_within").cast("double")))
    return named.select(*within, "n", "groups", "df_between", "df_within", "f", p.alias("p"))


def against_the_rest(df: DataFrame, group: str, value: str, within: Sequence[str] = ()) -> DataFrame:
    """Welch's t-test of every group against all others: ``within, group, n, mean, rest_n, rest_mean, t, df, p, p_holm``.

    A row per group, whatever their number, as the others' moments are what all have without the
    group's own. ``p_holm`` is corrected for the number of tests by Holm's steps. Groups with fewer
    than two values, or facing fewer than two, or without any spread, have a null ``t``.
    """
    n, all_n = F.col("n"), F.col("_n")
    rest_n = all_n - n
    every = _totals(group_moments(df, group, value, within), within).withColumn("rest_n", rest_n)
    every = every.withColumn("rest_mean", F.try_divide(all_n * F.col("_mean") - n * F.col("mean"), F.col("rest_n")))
    gap = F.col("mean") - F.col("rest_mean")
    rest_m2 = F.greatest(F.lit(0.0), F.col("_between") + F.col("_within") - F.col("m2") - gap * gap * n * F.col("rest_n") / all_n)
    able = (n > 1) & (F.col("rest_n") > 1)
    own, other = (F.when(able, F.try_divide(F.try_divide(m, k - 1), k)) for m, k in ((F.col("m2"), n), (rest_m2, F.col("rest_n"))))
    every = every.withColumns({"_a": own, "_b": other})
    spread = F.when(F.col("_a") + F.col("_b") > 0, F.col("_a") + F.col("_b"))
    freedom = F.try_divide(spread * spread, F.try_divide(F.col("_a") ** 2, n - 1) + F.try_divide(F.col("_b") ** 2, F.col("rest_n") - 1))
    tested = every.withColumns({"t": gap / F.sqrt(spread), "df": freedom})
    tested = tested.withColumn("p", F.when(F.col("t").isNotNull(), t_tails(F.col("t"), F.col("df"))))
    keys = list(within) or [F.lit(0)]
    rising = Window.partitionBy(*keys).orderBy(F.col("p").asc_nulls_last(), F.col(group))
    tests = F.count("p").over(Window.partitionBy(*keys))
    step = F.least(F.lit(1.0), F.col("p") * (tests - F.row_number().over(rising) + 1))
    stepped = tested.withColumn("_step", step)
    holm = F.max("_step").over(rising.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    corrected = F.when(F.col("p").isNotNull(), holm)
    return stepped.select(*within, group, "n", "mean", "rest_n", "rest_mean", "t", "df", "p", corrected.alias("p_holm"))
