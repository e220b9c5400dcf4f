"""The operators of this package as queries over the whole tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replivote.llm import (
    alignment,
    archives,
    codes,
    contamination,
    extraction,
    minhash,
    mixing,
    pii,
    randomness,
    subspace,
    suffix,
    toxicity,
    trust,
)
from replivote.llm.common import table


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pii.fit(pii.labelled_parts(docs))
    return pii.personal_data(docs, model, drop=("text",))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = toxicity.judged(docs, toxicity_chain(docs, table(spark, sf_dir, "labels")), drop=("text",))
    return judged.select("doc_id", "p_junk", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def toxicity_chain(docs: DataFrame, labels: DataFrame) -> toxicity.Chain:
    """Junk first, then toxic texts, from the two labels given."""
    known = labels.select("doc_id", (1 - F.col("quality")).alias("junk"), F.col("toxic").alias("toxic"))
    return toxicity.train_chain(toxicity.labelled_sample(docs, known), ["junk", "toxic"])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.copies(docs, mixing.source_rates(docs))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents"), least=50)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archives.archived_pages(table(spark, sf_dir, "pages"))
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return randomness.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = trust.judged_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


#: Where the public tokenizers are installed.
TOKENIZERS = "/opt/tokenizers"


def op12_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.scored_alignment(docs, f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", codes.hex_code().alias("code"), "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_personal_data, op2_main_text, op3_toxicity, op4_mixing, op5_minhash, op6_suffix,
        op7_warc, op8_contamination, op9_secrets, op10_vectors, op11_trust, op12_alignment, op13_vector_codes,
    )
}

WORD = r"[^\x20\x09-\x0D]+"


def _folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _grams(table: str, key: str, width: int, short: bool) -> str:
    """Distinct shingles as text; ``short`` keeps a text of fewer words as one shingle."""
    tokens = f"SELECT {key} AS id, regexp_extract_all({_folded('text')}, '{WORD}') AS w FROM {table} WHERE {key} IS NOT NULL"
    first = f"greatest(len(w) - {width} + 1, 1)" if short else f"len(w) - {width} + 1"
    return (
        f"SELECT DISTINCT id, array_to_string(list_slice(w, i, i + {width - 1}), ' ') AS g FROM "
        f"(SELECT id, w, unnest(range(1, {first} + 1)) AS i FROM ({tokens}) WHERE len(w) > 0)"
    )


def _rules_sql() -> tuple[str, str]:
    """Rule and verdict of the longest rule that fits, as CASE expressions over ``host, path``."""
    rules = sorted(trust.RULES, key=lambda r: -len(r.host + r.path))
    fits = [f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN " for r in rules]
    return tuple(f"CASE {' '.join(f + repr(v) for f, v in zip(fits, values))} END" for values in ([r.host + r.path for r in rules], [r.verdict for r in rules]))


def _trust_sql(rounds: int = 20) -> str:
    rule, verdict = _rules_sql()
    fold = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    link = trust.LINK.replace("'", "''")
    chain = "".join(
        f"""
m{i} AS MATERIALIZED (SELECT kind, host, sum(mass)::BIGINT AS mass FROM (SELECT s.kind, s.into_host AS host,
  floor(mass::DOUBLE * 0.85e0 * weight::DOUBLE / total::DOUBLE)::BIGINT AS mass
  FROM m{i - 1} m JOIN s ON s.kind = m.kind AND s.frm = m.host) GROUP BY 1, 2 HAVING sum(mass) > 0),"""
        for i in range(1, rounds + 1)
    )
    every = " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(rounds + 1))
    return f"""
WITH r AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, {fold("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
d AS MATERIALIZED (SELECT *, {rule} AS rule, {verdict} AS ruled FROM p),
l AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, '{link}', 1), lambda h: {fold("h")}))) AS dst
  FROM d WHERE host <> '' AND html IS NOT NULL),
e AS (SELECT src, dst, count(*) AS weight FROM l WHERE src <> dst GROUP BY 1, 2),
b AS (SELECT 'trust' AS kind, src AS frm, dst AS into_host, weight FROM e UNION ALL SELECT 'distrust', dst, src, weight FROM e),
s AS MATERIALIZED (SELECT *, sum(weight) OVER (PARTITION BY kind, frm)::BIGINT AS total FROM b),
h AS (SELECT host, floor(1e12 * count(*) FILTER (ruled = 'allow') / count(*))::BIGINT AS t,
  floor(1e12 * count(*) FILTER (ruled = 'block') / count(*))::BIGINT AS u FROM d WHERE host <> '' GROUP BY host),
m0 AS MATERIALIZED (SELECT 'trust' AS kind, host, t AS mass FROM h WHERE t > 0 UNION ALL SELECT 'distrust', host, u FROM h WHERE u > 0),{chain}
g AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0)::BIGINT AS t, coalesce(sum(mass) FILTER (kind = 'distrust'), 0)::BIGINT AS u
  FROM ({every}) GROUP BY host),
j AS (SELECT page_id, d.host, path, rule, ruled, coalesce(t, 0) AS t, coalesce(u, 0) AS u FROM d LEFT JOIN g ON g.host = d.host)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN u > t * 1e0 AND u >= 0.05e0 * 1e12 THEN 'block' ELSE 'allow' END) AS verdict,
  t / 1e12 AS trust, u / 1e12 AS distrust FROM j"""


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    def nearest(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (SELECT k, c.p, c.v, min(list_sum(list_transform(list_zip(c.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + e) AS de
  FROM c JOIN b{i} b ON b.p = c.p GROUP BY ALL)"""

    def moved(i: int) -> str:
        return f"""
s{i} AS (SELECT p, de % {entries} AS e, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM a{i}) GROUP BY 1, 2, 3),
n{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY 1, 2),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM b{i} b LEFT JOIN n{i} n ON n.p = b.p AND n.e = b.e)"""

    steps = ",".join(f"{nearest(i)},{moved(i)}" for i in range(rounds)) + f",{nearest(rounds)}"
    return f"""
WITH x AS (SELECT vec_id, label, row_number() OVER () AS k, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
c AS MATERIALIZED (SELECT k, vec_id, p, list_slice(x, p * len(x) // {parts} + 1, (p + 1) * len(x) // {parts}) AS v
  FROM (SELECT *, unnest(range({parts})) AS p FROM x)),
f AS (SELECT k, row_number() OVER (ORDER BY vec_id, x) - 1 AS e FROM x WHERE vec_id IS NOT NULL ORDER BY e LIMIT {entries}),
b0 AS MATERIALIZED (SELECT p, e, v FROM c JOIN f USING (k)),{steps},
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
o AS (SELECT k, string_agg(format('{{:02x}}', de % {entries}), '' ORDER BY p) AS code, sum(de // {entries})::BIGINT AS error FROM a{rounds} GROUP BY k)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM o JOIN x USING (k), h"""


ORACLES: dict[str, str] = {
    "op11_trust": _trust_sql(),
    "op13_vector_codes": _codes_sql(),
    "op4_mixing": f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight,
  2e0 * source_size AS most FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS k FROM w),
f AS (SELECT a.k, (1.5e0 * (SELECT sum(source_size) FROM s)::DOUBLE
    - coalesce((SELECT sum(most) FROM o b WHERE b.k < a.k), 0e0)) / (SELECT sum(weight) FROM o b WHERE b.k >= a.k) AS level FROM o a),
l AS (SELECT arg_min(level, f.k) AS level FROM f JOIN o ON f.k = o.k WHERE o.weight * f.level < o.most),
t AS (SELECT source, source_size, least(weight * level, most) AS target FROM o, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS rate FROM t),
c AS (SELECT doc_id, size, source_size, target, (floor(rate)::BIGINT + CASE WHEN
    ('0x' || substr(md5(concat_ws(':', '20', doc_id::VARCHAR)), 1, 12))::BIGINT / 281474976710656e0 < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM c""",
    "op5_minhash": f"""
WITH RECURSIVE g AS MATERIALIZED ({_grams("documents", "doc_id", 2, True)}),
n AS MATERIALIZED (SELECT id, count(*) AS n FROM g GROUP BY id),
x AS MATERIALIZED (SELECT a.id AS a, b.id AS b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.id <> b.id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM x JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
r AS (SELECT id AS a, id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component FROM r GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n ON n.id = doc_id LEFT JOIN c ON c.a = doc_id""",
    "op2_main_text": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'), '<[^>]*$', '') AS t FROM a),
c AS (SELECT page_id, url, regexp_replace(replace(replace(t, '&quot;', '"'), '&amp;', '&'), '&amp$', '&') AS t FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d""",
    "op7_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
  4 * (instr('0123456789abcdef', substr(h, i, 1)) - 1) + 1, 4)), '') AS bits FROM p),
d AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
  + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest FROM b),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to FROM m""",
    "op10_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op8_contamination": f"""
WITH d AS ({_grams("documents", "doc_id", 5, False)}), i AS ({_grams("benchmark", "item_id", 5, False)}),
n AS (SELECT id, count(*) AS n_item FROM i GROUP BY id),
x AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM d JOIN i USING (g) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared FROM x JOIN n ON n.id = item_id WHERE n_shared >= ceil(n_item * 0.8 - 1e-9)""",
}
