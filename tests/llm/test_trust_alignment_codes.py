"""Link trust, tokenizer alignment and vector codes against SQL and plain code."""

import math
import random
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from replivote.llm import alignment, codes, trust
from replivote.llm.queries import ORACLES, TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"

# trust


@pytest.fixture(scope="module")
def linked():
    """Hosts that link to each other: good ones, a farm around a blocked host, and awkward pages."""
    rng = random.Random(7)
    farm = [f"farm{i}.example.net" for i in range(6)]
    good = [f"good{i}.example.net" for i in range(6)]
    rows = [("http://seed.org/x", "".join(f'<A class="x" HREF = "https://{h}/a?b">l</a>' for h in good))]
    rows += [(f"https://{h}/p", f"<a href='//{rng.choice(good)}/q'>x</a><a href=/local>y</a>") for h in good]
    rows += [(f"http://{h}/p{i}", f"<a href=http://bad.com/de/1 rel=x>x</a> <a href='http://{rng.choice(farm)}'>y") for h in farm for i in range(3)]
    rows += [("http://bad.com/de/1", '<a href="http://GOOD1.example.net/">x</a>'), ("http://bad.com/en/2", None), ("http://alone.example.net/", "")]
    rows += [(None, None), ("", ""), ("no host", "<a href=http://x.y>z</a>"), ("http://", "<a"), ("http://ORG", None), ("http://a.org/en/1#/fr/", None)]
    rows += [("http://sub.Example.org/en/12?x=://y", None), ("x://example.org/es/\nz", None), ("http://com/fr/", "<a " * 20_000), ("http://com/fr/", None)]
    rows += [("http://notexample.org/es/", None), ("http://good0.example.net:80/de/", None)]
    return [(i, u, h, "mine") for i, (u, h) in enumerate(rows)] + [(3, *rows[3], "again"), (None, "http://bad.com/x", None, None)]


def test_trust_equals_sql(spark, linked, tmp_path):
    pages = spark.createDataFrame(linked, "page_id long, url string, html string, verdict string").repartition(3)
    got = trust.judged_urls(pages.drop("verdict"))
    con = duckdb.connect()
    pages.drop("verdict").write.parquet(str(tmp_path / "p"))
    con.execute(f"create view pages as select * from '{tmp_path}/p/*.parquet'")
    want = con.execute(ORACLES["op11_trust"])
    columns = [d[0] for d in want.description]
    rows = sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect())))
    assert rows == sorted(map(str, want.fetchall()))


def test_farm_is_blocked_by_links_only(spark, linked):
    pages = spark.createDataFrame(linked, "page_id long, url string, html string, `Verdict` string")
    out = trust.judged_urls(pages)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "trust", "distrust"]
    got = {(r["url"], r["page_id"]): r for r in out.collect()}
    assert len(got) == len({(u, i) for i, u, *_ in linked})
    for (url, _), r in got.items():
        if url and "//farm" in url:
            assert r["verdict"] == "block" and r["rule"] is None and r["distrust"] > r["trust"]
        if url and "//good" in url:
            assert r["verdict"] == "allow"
    by = {u: r for (u, _), r in got.items()}
    assert by["http://bad.com/en/2"]["verdict"] == "block" and by["http://alone.example.net/"]["verdict"] == "allow"
    assert (by["http://sub.Example.org/en/12?x=://y"]["rule"], by["http://sub.Example.org/en/12?x=://y"]["verdict"]) == ("example.org/en/1", "block")
    assert by["http://ORG"]["host"] == "org" and by["http://ORG"]["rule"] is None and by["http://notexample.org/es/"]["rule"] == "org/"
    assert (by[None]["host"], by[None]["path"], by["no host"]["host"], by["http://"]["host"]) == ("", "", "", "")
    assert trust.judged_urls(pages.where("false")).count() == 0


def test_scores_are_the_series(spark):
    """Scores against matrix powers; a popular host split into slots gives the same."""
    rng = random.Random(3)
    edges = Counter((f"h{rng.randrange(12)}", f"h{rng.choice([0, rng.randrange(12)])}") for _ in range(120))
    edges = {e: n for e, n in edges.items() if e[0] != e[1]}
    links = spark.createDataFrame([(*e, n) for e, n in edges.items()], "src string, dst string, weight long")
    seeds = spark.createDataFrame([("h1", trust.UNIT, 0), ("h2", 0, trust.UNIT), ("h3", trust.UNIT // 2, trust.UNIT // 4), ("h3", 5, 0), (None, 9, 9)], "host string, trust long, distrust long")
    names = [f"h{i}" for i in range(12)]
    m = np.array([[edges.get((a, b), 0) for b in names] for a in names], dtype=float)
    want = {}
    for kind, step in (("trust", m), ("distrust", m.T)):
        step = step / np.maximum(step.sum(axis=1, keepdims=True), 1)
        mass = np.array([{"trust": {1: 1.0, 3: 0.5}, "distrust": {2: 1.0, 3: 0.25}}[kind].get(i, 0.0) for i in range(12)])
        total = np.zeros(12)
        for _ in range(21):
            total, mass = total + mass, 0.85 * mass @ step
        want[kind] = dict(zip(names, total))
    got = {r["host"]: r for r in trust.host_scores(seeds, links).collect()}
    for kind in want:
        assert all(abs(got[h][kind] / trust.UNIT - v) < 1e-6 for h, v in want[kind].items() if v)
    slot, trust.SLOT = trust.SLOT, 2
    try:
        assert {r["host"]: r for r in trust.host_scores(seeds, links).collect()} == got
    finally:
        trust.SLOT = slot
    assert trust.host_scores(seeds, links.where("false")).count() == 3


# alignment


def plain_alignment(texts):
    """Every token of whole texts, overlaps by comparing byte ranges one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment._byte_letters()
    links, counts, out = [], Counter(), []
    for text in texts:
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i in (second.encode(text) if text else []) for p in [second.id_to_piece(i)]]
        whole = (" " + text).encode() if text else b""
        if b"".join(p for _, p in a) != whole or b"".join(p for _, p in b) != whole:
            a = b = []
        ranges = []
        for side in (a, b):
            at, spans = 0, []
            for i, p in side:
                spans.append((i, at, at + len(p)))
                at += len(p)
            ranges.append(spans)
        ends = sorted({e for *_, e in ranges[0]} & {e for *_, e in ranges[1]})
        groups, last = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if last <= s and e <= end) for side in ranges))
            last = end
        mine = [(i, j) for i, s, e in ranges[0] for j, t, f in ranges[1] if s < f and t < e]
        counts.update(mine)
        links.append(mine)
        out.append([len(a), len(b), len(groups), len(mine), sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    return [(*o[:4], sum(counts[p] == most[p[1]] for p in mine), sum(counts[p] for p in mine), o[4]) for o, mine in zip(out, links)]


@pytest.fixture(scope="module")
def written():
    rng = random.Random(5)
    letters = "abcdé ñ\n\t ß中文🙂'st 12  ▁<|endoftext|>\u0301\x85\xa0 "
    texts = [None, "", " ", "  ", "a", "a ", " a", "a\n b", "a \n  b \n", "x▁y", "<s> </s> <|endoftext|> <0x41>", "ﬁ① é", "\x00\x1f \x7f", "a" * 3000, " " * 200, "la " * 500, "don't they're", "日本語のテキスト " * 20]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(120)]
    texts += [" ".join(rng.choice(["the", "of", "thinking", "Überraschung", "naïve", "x=1;", "re%%%"]) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    return texts + texts[20:40]


def test_alignment_equals_plain_code(spark, written, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 2000)
    monkeypatch.setattr(alignment, "LEARNED", 300)
    rows = [(i if i % 9 else None, t, "mine") for i, t in enumerate(written)] + [(1, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    out = alignment.scored_alignment(docs, A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = Counter((r["doc_id"], *(r[n] for n in names)) for r in out.collect())
    assert got == Counter((k, *w) for (k, *_), w in zip(rows, plain_alignment([t for _, t, _ in rows])))
    none = alignment.scored_alignment(docs.where("text is null or text in ('', 'x▁y')"), A, B).collect()
    assert len(none) == 3 and all(r["n_a"] == r["count_sum"] == 0 and r["groups_sha256"] == "" for r in none)
    assert alignment.scored_alignment(docs.where("false"), A, B).count() == 0


def test_groups_spell_their_texts(spark, written):
    from tokenizers import Tokenizer

    docs = spark.createDataFrame(list(enumerate(written)), "doc_id long, text string")
    first = Tokenizer.from_file(A)
    digests = {r["doc_id"]: r["groups_sha256"] for r in alignment.scored_alignment(docs, A, B).collect()}
    seen = 0
    for r in alignment.alignment(docs, A, B).collect():
        text = written[r["doc_id"]]
        cuts = list(zip([0, *r["a_cuts"]], r["a_cuts"], [0, *r["b_cuts"]], r["b_cuts"]))
        said = ";".join(",".join(map(str, r["a_ids"][s:e])) + "|" + ",".join(map(str, r["b_ids"][t:f])) for s, e, t, f in cuts)
        assert digests[r["doc_id"]] == (sha256(said.encode()).hexdigest() if said else "")
        if r["a_ids"]:
            assert first.decode(r["a_ids"]) == " " + text and r["a_cuts"][-1] == len(r["a_ids"]) and r["b_cuts"][-1] == len(r["b_ids"])
            seen += 1
    assert seen > 100


def test_galloping_finds_every_place():
    rng = random.Random(2)
    for _ in range(500):
        long = np.array(sorted(rng.sample(range(200), rng.randrange(1, 60))))
        short = np.array(sorted(rng.sample(range(long[-1] + 1), min(rng.randrange(1, 20), long[-1] + 1))))
        start = np.array([rng.randrange(-5, 70) for _ in short])
        got = alignment.ranks(short, long, start, np.zeros(len(short), int), np.full(len(short), len(long)))
        assert got.tolist() == [sum(x < s for x in long.tolist()) for s in short.tolist()]


def test_packed_counts():
    for place, times in (([], []), ([0], [1]), ([3, 70_000], [1, 2]), ([0, 1, 99_999, 100_000], [1, 999, 2, 1])):
        back = alignment.unpacked_counts(alignment.packed_counts(np.array(place, dtype=np.int64), np.array(times, dtype=np.int64)))
        assert [x.tolist() for x in back] == [place, times]


# codes


def plain_codes(rows, parts, entries, rounds):
    sound = [(k, l, [math.floor(256 * x) for x in v]) for k, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((k, x) for k, _, x in sound if k is not None)[:entries]
    width = len(first[0][1]) // parts
    cut = lambda x, p: x[p * width : (p + 1) * width]
    books = [[cut(x, p) for _, x in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    sound = [(k, l, x) for k, l, x in sound if len(x) == len(first[0][1])]

    def assigned():
        return [[min((far(cut(x, p), e), i) for i, e in enumerate(books[p])) for p in range(parts)] for _, _, x in sound]

    for _ in range(rounds):
        found, new = assigned(), [[list(e) for e in b] for b in books]
        for p in range(parts):
            for i in range(len(books[p])):
                mine = [cut(x, p) for (_, _, x), f in zip(sound, found) if f[p][1] == i]
                if mine:
                    new[p][i] = [sum(c) // len(mine) for c in zip(*mine)]
        books = new
    errors = Counter()
    for (_, label, _), f in zip(sound, assigned()):
        errors[label] += sum(d for d, _ in f)
    digest = sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return Counter((k, label, "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), errors[label], digest) for (k, label, _), f in zip(sound, assigned()))


@pytest.mark.parametrize("parts,dims,entries", [(4, 12, 8), (16, 64, 64), (2, 2, 3), (1, 5, 4)])
def test_codes_equal_plain_code(spark, parts, dims, entries):
    rng = random.Random(dims)
    vec = lambda: [rng.choice([rng.gauss(0, 0.1), rng.gauss(0, 0.1), 0.25, -0.25]) for _ in range(dims)]
    rows = [(i, [float(np.float32(x)) for x in vec()], rng.choice([0, 1, None])) for i in range(90)]
    rows += [(i + 200, rows[i % 7][1], 1) for i in range(60)] + [(5, vec(), 2), (5, rows[5][1], 2), (None, vec(), None)]
    rows += [(300, None, 1), (-1, [None] * dims, 1), (-2, [math.nan] * dims, 1), (-3, [math.inf] + [0.0] * (dims - 1), 1), (301, [0.0] * (dims + 1), 1), (302, [0.0] * dims, None), (303, [1000.0, -1000.0] * (dims // 2) + [0.5] * (dims % 2), 7)]
    rows = [(k, v and [None if x is None else float(np.float32(x)) for x in v], l) for k, v, l in rows]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, codes string").repartition(3)
    out = codes.vector_codes(df, parts=parts, entries=entries).withColumn("code", codes.hex_code())
    got = Counter((r["vec_id"], r["label"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in out.collect())
    assert got == plain_codes(rows, parts, entries, 2)
    assert codes.vector_codes(df.where("false"), parts=parts).count() == 0


def test_search_is_exact_at_any_size():
    """Early elimination against all distances, in machine words and beyond them."""
    rng = np.random.default_rng(1)
    for top in (3, 1000, 2**26, 2**40):
        for width in (1, 3, 4, 7, 8):
            parts, entries = rng.integers(-top, top + 1, (200, width)), rng.integers(-top, top + 1, (17, width))
            entries[9] = entries[4]
            parts[:17] = entries
            far = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e)) for e in entries] for p in parts]
            found, error = codes.nearest(parts, entries)
            assert found.tolist() == [f.index(min(f)) for f in far] and [int(e) for e in error] == [min(f) for f in far]


def test_transform_keeps_distances_and_orders_by_sign_changes():
    rows = np.random.default_rng(2).integers(-9, 10, (5, 8))
    assert ((codes.walsh_hadamard(rows) ** 2).sum(axis=1) == 8 * (rows**2).sum(axis=1)).all()
    signs = codes.walsh_hadamard(np.eye(8, dtype=np.int64))[:, codes.sequency_order(8)].T
    assert [(r[1:] != r[:-1]).sum() for r in signs] == list(range(8))


def test_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        codes.vector_codes(df, parts=2).collect()
    with pytest.raises(ValueError):
        codes.vector_codes(df.withColumn("embedding", F.array(F.lit(1.0))), parts=2)
