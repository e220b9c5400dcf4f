"""URL filters: rules first, then trust and distrust carried over the links between hosts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.llm.common import ascii_lower, quoted, stored


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, where the path starts with ``path``."""

    verdict: str  # "allow" or "block"
    host: str
    path: str


#: The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: The host of an absolute link of an anchor tag.
LINK = r"""(?i)<a(?:\s[^<>]*?)?\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""
UNIT = 10**12  # mass of a host all of whose pages a rule decides
SLOT = 10_000  # links of one host that are joined together
_SALTS = 32


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z folded) and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits, or nulls; the first of equal length."""
    rule, verdict = [], []
    for r in sorted(rules, key=lambda r: -len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule.append(F.when(fits, F.lit(r.host + r.path)))
        verdict.append(F.when(fits, F.lit(r.verdict)))
    none = F.lit(None).cast("string")
    return F.coalesce(*rule, none), F.coalesce(*verdict, none)


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, weight``: pages of a host that link to another host. Links to itself are left out."""
    src, _ = host_and_path(F.col("url"))
    found = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), ascii_lower))
    each = pages.where("html is not null").select(src.alias("src"), F.explode(found).alias("dst"))
    return each.where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def steps_of(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How mass moves: ``kind, frm, slot, into, weight, total``, and per start ``kind, frm, slots``.

    Trust follows links, distrust goes against them, each link by its share of its
    start's weight. A start with many links has them split into slots of about
    ``SLOT``, so that no join gathers all links of a popular host.
    """
    forth = links.select(F.lit("trust").alias("kind"), F.col("src").alias("frm"), F.col("dst").alias("into"), "weight")
    back = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("frm"), F.col("src").alias("into"), "weight")
    both = forth.union(back)
    starts = both.groupBy("kind", "frm").agg(F.sum("weight").alias("total"), F.ceil(F.count("*") / SLOT).cast("long").alias("slots"))
    starts = stored(starts, "starts")
    slot = F.pmod(F.xxhash64("into"), F.col("slots"))
    return both.join(starts, ["kind", "frm"]).select("kind", "frm", slot.alias("slot"), "into", "weight", "total"), starts.drop("total")


def host_scores(seeds: DataFrame, links: DataFrame, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """``host, trust, distrust`` (whole numbers): personalised PageRank of every host that mass reaches.

    ``seeds (host, trust, distrust)`` hold the starting mass. In each round a host
    passes ``damping`` times what it got in the last one along its links; a score is
    the sum over the rounds, which end when nothing is left to pass. A share is rounded
    down to a whole number, so that sums do not depend on their order and reruns
    agree. A host without links keeps what it has. Null and empty hosts are ignored; hosts
    that repeat add up.
    """
    pair = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("long").alias("mass")) for k in ("trust", "distrust")])
    known = seeds.where("host <> ''").select("host", F.explode(pair).alias("m")).select("m.kind", "host", "m.mass")
    mass = stored(known.groupBy("kind", "host").agg(F.sum("mass").alias("mass")).where("mass > 0"), "mass")
    steps, starts = steps_of(links)
    steps = stored(steps, "steps")
    all_mass = mass
    for _ in range(rounds):
        here = mass.withColumnRenamed("host", "frm").join(starts, ["kind", "frm"])
        here = here.select("kind", "frm", "mass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"))
        share = F.floor(F.col("mass").cast("double") * F.lit(damping) * F.col("weight").cast("double") / F.col("total").cast("double"))
        moved = here.join(steps, ["kind", "frm", "slot"]).select("kind", F.col("into").alias("host"), share.alias("mass"))
        mass = stored(moved.groupBy("kind", "host").agg(F.sum("mass").alias("mass")).where("mass > 0"), "mass")
        if mass.isEmpty():
            break
        all_mass = all_mass.union(mass)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0)).cast("long").alias(kind)
    return all_mass.groupBy("host").agg(of("trust"), of("distrust"))


def judged_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    *,
    damping: float = 0.85,
    rounds: int = 20,
    ratio: float = 1.0,
    least: float = 0.05,
) -> DataFrame:
    """``pages`` without ``html``, with ``host, path, rule, verdict, trust, distrust``.

    The longest fitting rule decides. Other pages go by their host: seeds are the hosts
    that rules know, with the share of their pages that rules allow as trust and the share
    that they block as distrust. Both spread over the links in the pages' html, and a host is
    blocked if its distrust exceeds ``ratio`` times its trust and is ``least`` of a whole
    seed or more; else it is allowed, so hosts that nothing reaches are too.

    ``trust`` and ``distrust`` are in shares of a whole seed, 0 where nothing arrived. Urls
    that are null or without ``://`` have an empty host and path, and are allowed unless a
    rule fits. Null and empty html has no links. Rows stay as they are, repeated
    ones too, which count as pages of their own; input columns with the names of results are
    replaced. ``rules`` are a short list, tested one by one.
    """
    results = ("host", "path", "rule", "verdict", "trust", "distrust")
    kept = [c for c in pages.columns if c.lower() not in (*results, "html")]
    host, path = host_and_path(F.col("url"))
    rule, verdict = fitting(rules, F.col("host"), F.col("path"))
    placed = pages.select(*[F.col(quoted(c)) for c in kept], host.alias("host"), path.alias("path"))
    placed = placed.withColumns({"rule": rule, "verdict": verdict})
    share = lambda v: F.floor(F.lit(float(UNIT)) * F.count(F.when(F.col("verdict") == v, 1)) / F.count("*"))
    seeds = placed.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    links = stored(host_links(pages.select("url", "html")), "links")
    scores = host_scores(seeds, links, damping, rounds).select(F.col("host").alias("_host"), F.col("trust"), F.col("distrust"))
    # every host's row once per salt, so that a host with a third of all pages is spread over as many tasks
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    scores = stored(scores, "scores").withColumn("_salt", salts)
    salted = placed.withColumn("_salt", F.pmod(F.xxhash64("url", *[quoted(c) for c in kept[:1]]), F.lit(_SALTS)).cast("int"))
    joined = salted.join(scores, (F.col("host") == F.col("_host")) & (salted["_salt"] == scores["_salt"]), "left").drop("_salt")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0)) for c in ("trust", "distrust"))
    bad = (distrust > trust * F.lit(ratio)) & (distrust >= F.lit(least * UNIT))
    return joined.select(
        *[F.col(quoted(c)) for c in kept],
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        (trust / UNIT).alias("trust"),
        (distrust / UNIT).alias("distrust"),
    )
