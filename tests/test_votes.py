import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from replivote.functions import votes
from replivote.functions import similarity
from replivote.operators import consensus as con
from replivote.operators import fuzzy
from replivote.operators.block import between_consensus, consensus_for_block, pooled_consensus
from tests import plain

CASES = {
    1: ["b", "a", "a", "b"],
    2: ["a, b", "b; a"],
    3: ["???"],
    4: ["x y", "y z"],
    5: ["a a", "b"],
    6: ["a", "b", "c"],
    7: ["", " ", None],
    8: ["one"],
    9: ["???", "!", "a b", "b a"],
    10: ["tree", " Trees. ", None, "tree"],
}
rng = random.Random(7)
PARTS = ["red car", "Red Car.", "car", "cars", "tree", "trees, bush", "bush; tree", "", " ", "???", "blue  car", "a red car", None]
for k in range(11, 120):
    CASES[k] = [rng.choice(PARTS) for _ in range(rng.randint(1, 16))]
CASES[200] = ["a"] + [f"b{i}" for i in range(15)]  # 1/16 rounds down to 0.062


def rows(spark):
    return spark.createDataFrame(list(CASES.items()), "id int, answers array<string>")


def long(spark, parts=3):
    each = rows(spark).select("id", F.posexplode("answers").alias("run", "response"))
    return each.withColumn("status", F.lit("ok")).repartition(parts, "response")


def found(df):
    return {r["id"]: (r["consensus"], r["confidence"]) for r in df.collect()}


@pytest.mark.parametrize("mode", votes.MODES)
def test_votes_in_a_row(spark, mode):
    got = found(rows(spark).select("id", votes.vote(votes.prepare(F.col("answers"), mode), mode).alias("v")).select("id", "v.*"))
    assert got == {k: plain.vote(a, mode) for k, a in CASES.items()}


@pytest.mark.parametrize("mode", votes.MODES)
@pytest.mark.parametrize("bound", [None, 20])
def test_votes_over_a_long_table(spark, mode, bound):
    got = found(con.consensus(long(spark), ["id"], mode, max_votes=bound))
    assert got == {k: plain.vote(a, mode) for k, a in CASES.items()}


@pytest.mark.parametrize("threshold", [0, 50, 100, 101])
def test_thresholds(spark, threshold):
    expected = {k: plain.vote(a, "fuzzy", threshold) for k, a in CASES.items()}
    ready = votes.prepare(F.col("answers"), "fuzzy")
    assert found(rows(spark).select("id", votes.vote(ready, "fuzzy", threshold).alias("v")).select("id", "v.*")) == expected
    assert found(fuzzy.consensus_fuzzy(long(spark), ["id"], threshold=threshold, max_votes=20)) == expected
    assert found(fuzzy.consensus_fuzzy(long(spark), ["id"], threshold=threshold, block=4)) == expected


def test_partitioning_does_not_matter(spark):
    results = [sorted(con.consensus_set(long(spark, n), ["id"]).collect()) for n in (1, 5)]
    assert results[0] == results[1]


def hot(spark):
    """One key owns most rows; its answers have many distinct values."""
    local = random.Random(3)
    words = [f"{a}{b}" for a in ("oak", "elm", "ash", "fir", "yew", "box") for b in ("", "s", " tree", " wood", "en", " leaf")]
    answers = [(0, i, ", ".join(local.sample(words, local.randint(1, 3)))) for i in range(600)]
    answers += [(k, i, local.choice(words)) for k in range(1, 20) for i in range(5)]
    df = spark.createDataFrame(answers, "id int, run int, response string").repartition(4)
    by_key = {}
    for k, _, a in answers:
        by_key.setdefault(k, []).append(a)
    return df, by_key


@pytest.mark.parametrize("block", [10, 512])
def test_fuzzy_groups_of_a_hot_key(spark, block):
    df, by_key = hot(spark)
    got = found(fuzzy.consensus_fuzzy(df, ["id"], threshold=80, block=block))
    assert got == {k: plain.vote(a, "fuzzy", 80) for k, a in by_key.items()}


def one_by_one(answers, threshold):
    """Leader of each distinct answer, every pair scored in full."""
    leaders, of = [], {}
    for a in answers:
        hit = next((x for x in leaders if similarity.token_set_score(x, a) >= threshold), None)
        if hit is None:
            leaders.append(a)
        of[a] = hit or a
    return of


def test_groups_of_two_thousand_answers(spark):
    """Long and short answers, word orders and near copies of one key, in rounds."""
    local = random.Random(11)
    stems = ["".join(local.choice("aeioubdgklmnprst") for _ in range(local.randint(2, 7))) for _ in range(900)]
    base = [local.sample(stems, local.choice([1, 2, 5, 12, 40])) for _ in range(700)]

    def near(words):
        words = list(words)
        local.shuffle(words)
        at = local.randrange(len(words))
        words[at] += local.choice(["", "s", "en", "x"])
        return " ".join(words + local.choice([[], [], [local.choice(stems)]]))

    answers = list(dict.fromkeys(" ".join(w) if i < 700 else near(w) for i, w in enumerate(base * 3)))
    assert len(answers) > 1900
    df = spark.createDataFrame([("hot", i, a) for i, a in enumerate(answers)], "id string, run int, response string").repartition(5)
    got = {r["answer"]: r["leader"] for r in fuzzy.greedy_groups(df, ["id"], block=400).collect()}
    assert got == one_by_one(answers, 85)


def test_greedy_groups_in_rounds_equal_one_pass(spark):
    df, _ = hot(spark)
    one = sorted(fuzzy.greedy_groups(df, ["id"], max_votes=512).collect())
    assert sorted(fuzzy.greedy_groups(df, ["id"], block=14).collect()) == one


def test_near_forms_of_a_long_answer_share_their_refusals(monkeypatch):
    """What a text is found to share at most with a leader spares its near forms the comparison; the groups stay the same."""
    local = random.Random(31)
    ends = ["the", "er", "ing", "an", "on", "tion", "ed", "re", "st", "ha", "es", "ly"]
    texts = [["".join(local.choices(ends, k=local.randint(1, 4))) for _ in range(150)] for _ in range(30)]
    forms = [[t, [*t[:-1], t[-1] + ","], [*t, "variant"], [t[0] + ";", *t[1:]], t[: local.randint(90, 150)]] for t in texts]
    answers = list(dict.fromkeys(" ".join(f) for of_text in forms for f in of_text))
    compared, places = [], similarity._places
    monkeypatch.setattr(similarity, "_places", lambda a: compared.append(a) or places(a))
    lead = similarity.ordered_leaders(answers, 85)
    few = len(compared)
    of = one_by_one(answers, 85)
    assert [answers[i] for i in lead] == [of[a] for a in answers]
    leaders = sorted(set(lead))
    later = answers[::-1] + [a.replace("tion", "st", 3) for a in answers]
    found = similarity.first_leaders([answers[i] for i in leaders], later, 85)
    for a, i in zip(later, found):
        assert i == next((k for k, j in enumerate(leaders) if similarity.token_set_score(answers[j], a) >= 85), None)
    alone = [similarity._Opened(85) for _ in answers]  # every answer for itself, without what was found before
    del compared[:]
    for at, (opened, a) in enumerate(zip(alone, answers)):
        for j in leaders:
            if j < at:
                opened.add(j, similarity._Profile(answers[j]))
        opened.first_match(similarity._Profile(a))
    assert len(texts) - 5 < len(leaders) and 2 * few < len(compared)


def test_short_answers_of_a_hot_key_take_few_rounds(spark, monkeypatch):
    """Short sets of words are grouped many at a time; long ones among them and equal orders keep the answer order."""
    local = random.Random(23)
    answers = ["".join(local.choice("aeiostn") for _ in range(local.randint(3, 9))) for _ in range(600)]
    answers += [f"{local.choice(answers)}, {local.choice(answers)}" for _ in range(500)]
    answers += [" ".join(local.sample(answers[:600], 14)) for _ in range(12)]
    answers = sorted(dict.fromkeys(answers))
    rounds, write = [], fuzzy.written

    def counted(df, name):
        rounds.append(name)
        assert rounds.count("heads") <= 6
        return write(df, name)

    monkeypatch.setattr(fuzzy, "written", counted)
    df = spark.createDataFrame([("hot", 3, a) for a in answers], "id string, run int, response string").repartition(5)
    got = {r["answer"]: r["leader"] for r in fuzzy.greedy_groups(df, ["id"], block=8).collect()}
    assert rounds.count("heads") > 1
    assert got == one_by_one(answers, 85)


def test_set_vote_of_a_hot_key(spark):
    df, by_key = hot(spark)
    expected = {k: plain.vote(a, "set") for k, a in by_key.items()}
    assert found(con.consensus_set(df, ["id"])) == expected
    assert found(con.consensus_set(df, ["id"], max_votes=1000)) == expected


def test_set_vote_by_long_numbers_sorts_no_items(spark):
    df, by_key = hot(spark)
    numbered = df.withColumn("order", (F.col("run") + F.lit(Decimal(10**26))).cast("decimal(28,0)"))
    voted = con.consensus_set(numbered, ["id"], order="order")
    assert found(voted) == {k: plain.vote(a, "set") for k, a in by_key.items()}
    plan = voted._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    # a key none of whose answers names an item keeps its count
    empty = spark.createDataFrame([(7, 0, ";"), (7, 1, ","), (8, 0, None)], "id int, run int, response string")
    assert sorted(tuple(r) for r in con.consensus_set(empty, ["id"]).collect()) == [(7, "", 0.0, 2), (8, "", 0.0, 0)]


def test_null_keys_form_one_key(spark):
    df = spark.createDataFrame([(None, i, "a") for i in range(30)] + [(1, 0, "b")], "id int, run int, response string")
    assert found(con.consensus_set(df, ["id"])) == {None: ("a", 1.0), 1: ("b", 1.0)}
    assert found(fuzzy.consensus_fuzzy(df, ["id"], block=1)) == {None: ("a", 1.0), 1: ("b", 1.0)}


def test_words(spark):
    expected = {k: plain.words(a) for k, a in CASES.items()}
    assert found(con.consensus_words(long(spark), ["id"])) == expected
    assert found(rows(spark).select("id", votes.vote_words(F.col("answers")).alias("v")).select("id", "v.*")) == expected
    assert expected[4] == ("y", 1 / 3) and expected[5] == ("a", 1 / 2)


def test_words_documented(spark):
    in_row = found(rows(spark).select("id", votes.vote_words_documented(F.col("answers")).alias("v")).select("id", "v.*"))
    assert found(con.consensus_words_documented(long(spark), ["id"])) == in_row
    assert in_row[8] == ("one", 1.0) and in_row[6] == ("a", 0.333) and in_row[7] == ("no consensus", 0.0)


@pytest.mark.parametrize("documented, order", [(False, "long"), (True, "int"), (False, "string")])
def test_words_in_parts(spark, documented, order):
    vote = con.consensus_words_documented if documented else con.consensus_words
    df, _ = hot(spark)
    everything = long(spark).select("id", "run", "response").unionByName(df.withColumn("id", F.col("id") + 100))
    everything = everything.unionByName(df.where("id = 0").withColumn("id", F.lit(None).cast("int")))
    everything = everything.withColumn("run", F.col("run").cast(order))
    joined, most = {}, 0
    for row in con.consensus_words_in_parts(everything, ["id"], size=40, documented=documented).orderBy("part").collect():
        text, score = joined.get(row["id"], (None, row["confidence"]))
        assert score == row["confidence"] and (len(row["consensus"]) <= 50 or text is None)
        joined[row["id"]] = (row["consensus"] if text is None else f"{text} {row['consensus']}", score)
        most = max(most, row["part"])
    assert joined == found(vote(everything, ["id"])) and most > 3


def test_simple(spark):
    expected = {k: plain.simple(a) for k, a in CASES.items()}
    assert found(con.consensus_simple(long(spark), ["id"])) == expected
    assert found(rows(spark).select("id", votes.vote_simple(F.col("answers")).alias("v")).select("id", "v.*")) == expected


def test_errors_may_abstain(spark):
    df = spark.createDataFrame(
        [(1, 1, "Error: x", "error"), (1, 2, "Error: x", "error"), (1, 3, "a", "ok"), (2, 1, "Error: x", "error")],
        "id int, run int, response string, status string",
    )
    assert found(con.consensus_exact(df, ["id"])) == {1: ("error: x", 0.667), 2: ("error: x", 1.0)}
    assert found(con.consensus_exact(df, ["id"], errors_vote=False)) == {1: ("a", 1.0), 2: ("", 0.0)}


def test_unknown_mode():
    with pytest.raises(ValueError, match="is no way to vote"):
        votes.check_mode("loose")


GOLDEN = [
    ("img1", "chair, table", "Chair and table", "chair, lamp", "chair; lamp"),
    ("img2", "red car", "red automobile", "car", "vehicle"),
    ("img3", "tree", "trees", "plant", "tree"),
    ("img4", "", "", "Error: something went wrong", ""),
]
MODELS = ["gemma3:12b", "llava:13b"]


def golden(spark, errors_vote):
    names = ["Image"] + [f"Response_{r} ({m})" for m in MODELS for r in (1, 2)]
    wide = spark.createDataFrame(GOLDEN, names)
    for m in MODELS:
        wide = consensus_for_block(
            wide, [f"Response_{r} ({m})" for r in (1, 2)], "fuzzy", 80,
            consensus=f"Consensus ({m})", confidence=f"Consensus_Confidence ({m})", errors_vote=errors_vote,
        )
    return between_consensus(wide, MODELS, "fuzzy", 80, errors_vote=errors_vote)


def test_golden_table(spark):
    got = {r[0]: tuple(r[5:]) for r in golden(spark, True).collect()}
    assert got == {
        "img1": ("chair, table", 1.0, "chair, lamp", 1.0, "chair, table", 0.5),
        "img2": ("red car", 0.5, "car", 0.5, "red car", 1.0),
        "img3": ("tree", 1.0, "plant", 0.5, "tree", 0.5),
        "img4": ("", 0.0, "error: something went wrong", 1.0, "error: something went wrong", 1.0),
    }
    assert tuple(golden(spark, False).where("Image = 'img4'").first()[5:]) == ("", 0.0) * 3


def test_golden_pooled(spark):
    pooled = pooled_consensus(golden(spark, True), "exact").select("Image", "Aggregated_Consensus", "Aggregated_Consensus_Confidence")
    assert [tuple(r) for r in pooled.orderBy("Image").collect()] == [
        (r[0], *plain.vote(r[1:], "exact")) for r in GOLDEN
    ]


def test_answers_are_taken_apart_once_and_compared_once(monkeypatch):
    made, compared = [], []
    profile, within = similarity._Profile, similarity._within

    class Counted(profile):
        def __init__(self, answer):
            made.append(answer)
            super().__init__(answer)

    monkeypatch.setattr(similarity, "_Profile", Counted)
    monkeypatch.setattr(similarity, "_within", lambda *a: compared.append(a) or within(*a))
    said = ["red car", "red cat", "", "blue car red", "tree"]
    got = similarity._leaders_among(said, [[0, 1], [0, 1, 3, 4, 2], [1, 0], [4], []], 85)
    assert got == [[0, 0], [0, 0, 0, 3, 4], [0, 0], [0], []]
    assert sorted(made) == sorted(said) and len(compared) == len(set(compared))


@pytest.mark.parametrize("threshold", [0, 50, 85, 100, 101])
def test_pairs_and_an_index_find_the_same_leaders(monkeypatch, threshold):
    local = random.Random(11)
    pieces = ["oak", "oaks", "elm", "elms", "ash wood", "fir", "yew", "box tree", "\u00e9t\u00e9"]
    lists = [list(dict.fromkeys(" ".join(local.choices(pieces, k=local.randint(0, 5))) for _ in range(30))) for _ in range(40)]
    few = [similarity.ordered_leaders(a, threshold) for a in lists]
    monkeypatch.setattr(similarity, "_FEW", 0)
    assert few == [similarity.ordered_leaders(a, threshold) for a in lists]


def test_equal_answers_are_prepared_once(spark):
    for mode in votes.MODES:
        both = rows(spark).select(votes.prepare(F.col("answers"), mode).alias("a"), votes.prepare_once(F.col("answers"), mode).alias("b"))
        assert both.where("not (a <=> b)").count() == 0


def test_set_votes_count_many_kinds_of_sets(spark):
    local = random.Random(5)
    items = [f"w{i}" for i in range(12)]
    many = {k: [", ".join(local.sample(items, local.randint(0, 9))) for _ in range(n)] for k, n in enumerate([5, 32, 33, 34, 60])}
    df = spark.createDataFrame(list(many.items()), "id int, answers array<string>")
    got = found(df.select("id", votes.vote(votes.prepare_once(F.col("answers"), "set"), "set").alias("v")).select("id", "v.*"))
    assert got == {k: plain.vote(a, "set") for k, a in many.items()}
