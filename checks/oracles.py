"""The SQL counterpart of every query, for DuckDB over the same tables."""

from __future__ import annotations

import re

from checks.replay import MARK, MODELS, RUNS
from replivote.functions import prompts
from replivote.operators import grading

WS = r"[\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def round3(x: str) -> str:
    """Three places of the exact binary value; only sixteenths lie half-way and go to the even side."""
    exact_value = f"round(printf('%.30f', {x})::decimal(38, 30), 3)::double"
    return f"case when ({x}) * 16 = floor(({x}) * 16) then round_even({x}, 3) else {exact_value} end"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def spaces(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def norm(x: str) -> str:
    return spaces(rf"regexp_replace(lower({x}), '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')")


def light(x: str) -> str:
    return spaces(strip(f"lower({x})"))


def clean(x: str) -> str:
    return f"replace(replace({strip(x)}, chr(13), ' '), chr(10), ' ')"


def parts(x: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({x}, '[,;]+'), lambda p: {norm('p')}), lambda p: p <> '')"


def words(x: str) -> str:
    return f"regexp_split_to_array(lower({x}), '{WS}+')"


def answer(w1: str, w2: str, error: str = "'Error: timeout'") -> str:
    return f"""case k when 0 then '' when 1 then {error}
      when 2 then upper(substr({w1}, 1, 1)) || substr({w1}, 2) || '.'
      when 6 then '  ' || {w1} || ' ' when 7 then {w2}
      when 8 then {w1} || ', ' || {w2} when 9 then {w2} || '; ' || {w1} else {w1} end"""


def kind(*parts_: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts_)})), 1, 8))::bigint % 10"


_MODELS = "(values " + ", ".join(f"({i}, {q(m)})" for i, m in enumerate(MODELS)) + ") m(model_idx, model)"
_RUNS = f"(select unnest(range(1, {RUNS + 1}))::int as run)"

def both_ways(text: str) -> str:
    """w1 and w2 of a whole text."""
    lines = f"string_split({text}, chr(10))"
    return (
        f"replace({text}, chr(10), ' ') as w1, array_to_string(list_append(list_reverse("
        f"list_slice({lines}, 1, greatest(len({lines}) - 1, 1))), {q(MARK)}), ' ') as w2"
    )


R = f"""
r as (
  select doc_id, source, model_idx, model, run, {answer('w1', 'w2')} as response,
         case when k = 1 then 'error' else 'ok' end as status
  from (select *, {kind('doc_id', 'model', 'run')} as k
        from (select doc_id, source, {both_ways("coalesce(text, '')")} from documents)
        cross join {_MODELS} cross join {_RUNS}))"""

#: The same with two words chosen from each whole text.
SHORT_R = R.replace(
    both_ways("coalesce(text, '')"),
    "list_max(list_transform(string_split(replace(coalesce(text, ''), chr(10), ' '), ' '), lambda w: {'n': length(w), 'w': w})).w as w1, "
    "list_max(string_split(replace(coalesce(text, ''), chr(10), ' '), ' ')) as w2",
)

M = """
names as (
  select page_id, 'p' || page_id || (['.jpg', '.JPEG', '.png', '.bmp', '.tiff', '.GIF', '.webp', '.txt', ''])[page_id % 9 + 1]
         as image from pages),
manifest as (
  select distinct image from names where regexp_matches(image, '(?i)\\.(jpg|jpeg|png|bmp|tiff|gif|webp)$'))"""

IMAGE_R = f"""{M},
r as (
  select image, model_idx, model, run, {clean(answer('w1', 'w2'))} as response,
         case when k = 1 then 'error' else 'ok' end as status
  from (select *, {kind('image', 'model', 'run')} as k
        from (select image, split_part(image, '.', 1) as w1, md5(html) as w2 from names join pages using (page_id)
              where image in (select image from manifest))
        cross join {_MODELS} cross join {_RUNS}))"""


def with_(*ctes: str, then: str) -> str:
    return "with " + ",\n".join(c.strip() for c in ctes) + "\n" + then


# --- votes: each function returns CTEs that end in a table `name` (keys, consensus, confidence, n_responses).
# `source` selects keys, ord, response from earlier CTEs; null or blank responses abstain.


def _spoken(name: str, keys: str, source: str) -> str:
    return f"""{name}_all as ({source}),
{name}_v as (select * from {name}_all where response is not null and {strip('response')} <> '')"""


def _counted(name: str, keys: str, value: str) -> str:
    return f"""{name}_c as (
  select {keys}, val, count(*) as ct, min(ord) as f
  from (select {keys}, ord, {value} as val from {name}_v) group by {keys}, val)"""


def _modal(name: str, keys: str, empty: str) -> str:
    return f"""{name}_t as (
  select *, row_number() over (partition by {keys} order by ct desc, f) as rn,
         (sum(ct) over (partition by {keys}))::bigint as n from {name}_c),
{name} as (
  select {keys}, coalesce(val, {q(empty)}) as consensus, coalesce({round3('ct::double / n')}, 0.0) as confidence,
         coalesce(n, 0)::bigint as n_responses
  from (select distinct {keys} from {name}_all) left join (select * from {name}_t where rn = 1) using ({keys}))"""


def exact(name: str, keys: str, source: str) -> str:
    return ",\n".join([_spoken(name, keys, source), _counted(name, keys, norm("response")), _modal(name, keys, "")])


def simple(name: str, keys: str, source: str) -> str:
    every = f"{name}_all as ({source}),\n{name}_v as (select * from {name}_all where response is not null)"
    return ",\n".join([every, _counted(name, keys, light("response")), _modal(name, keys, "no responses")])


def set_(name: str, keys: str, source: str) -> str:
    return f"""{_spoken(name, keys, source)},
{name}_n as (select {keys}, count(*) as n from {name}_v group by {keys}),
{name}_i as (
  select {keys}, ord, item, min(pos) as pos
  from (select {keys}, ord, unnest(ps) as item, unnest(range(len(ps))) as pos
        from (select {keys}, ord, {parts('response')} as ps from {name}_v))
  group by {keys}, ord, item),
{name}_c as (
  select {keys}, item, count(*) as ct, min(ord * 1000000 + pos) as f from {name}_i group by {keys}, item),
{name}_h as (
  select *, row_number() over (partition by {keys} order by ct desc, f) as rn,
         bool_or(ct * 2 >= n) over (partition by {keys}) as half from {name}_c join {name}_n using ({keys})),
{name}_r as (
  select {keys}, string_agg(item, ', ' order by f) as consensus,
         {round3('sum(ct)::double / (count(*) * any_value(n))')} as confidence
  from {name}_h where ct * 2 >= n or (not half and rn = 1) group by {keys}),
{name} as (
  select {keys}, coalesce(consensus, '') as consensus, coalesce(confidence, 0.0) as confidence,
         coalesce(n, 0)::bigint as n_responses
  from (select distinct {keys} from {name}_all) left join {name}_r using ({keys}) left join {name}_n using ({keys}))"""


def similarity(pairs: str) -> str:
    """CTEs ending in `scored` (a, b, score) for the distinct unequal non-empty pairs (a, b) of `pairs`."""
    return f"""
vals as (select row_number() over () as id, v from (select a as v from {pairs} union select b from {pairs})),
pid as (select x.id as i, y.id as j, a, b from {pairs} join vals x on x.v = a join vals y on y.v = b),
tok as (select distinct id, unnest(string_split(v, ' ')) as t from vals),
sides as (
  select i, j, t, true as l, false as r from pid join tok on id = i union all
  select i, j, t, false, true from pid join tok on id = j),
merged as (select i, j, t, bool_or(l) as l, bool_or(r) as r from sides group by i, j, t),
split as (
  select i, j, coalesce(string_agg(t, ' ' order by t) filter (l and r), '') as sect,
         coalesce(string_agg(t, ' ' order by t) filter (l and not r), '') as oa,
         coalesce(string_agg(t, ' ' order by t) filter (r and not l), '') as ob from merged group by i, j),
parts as (select a, b, sect, oa, ob from pid join split using (i, j)),
ordered as (
  select *, case when length(oa) <= length(ob) then oa else ob end as s,
         case when length(oa) <= length(ob) then ob else oa end as l from parts),
lcs as (
  select a, b, sect, oa, ob, case when s = '' then 0 else length(s) - bit_count(list_reduce(
    list_prepend(((1::bigint << length(s)) - 1), list_transform(string_split(l, ''), lambda ch: list_sum(list_transform(
      range(1, length(s) + 1), lambda i: case when s[i] = ch then 1::bigint << (i - 1)::int else 0::bigint end))::bigint)),
    lambda st, mk: ((st + (st & mk)) | (st - (st & mk))) & ((1::bigint << length(s)) - 1))) end as n from ordered),
sized as (
  select *, length(oa) as la, length(ob) as lb, length(sect) as ls, (sect <> '')::int as gap from lcs),
scored as (
  select a, b, case when sect <> '' and (oa = '' or ob = '') then 100.0::double else greatest(
    100::double - (100 * (la + lb - 2 * n))::double / (2 * (ls + gap) + la + lb),
    case when ls > 0 then 100::double - (100 * (1 + la))::double / (2 * ls + 1 + la) else 0 end,
    case when ls > 0 then 100::double - (100 * (1 + lb))::double / (2 * ls + 1 + lb) else 0 end) end as score
  from sized)"""


def groups(name: str, keys: str, source: str, threshold: int = 85) -> str:
    """CTEs ending in `{name}_g` (keys, val, ct, f, pos, lead)."""
    return f"""{_spoken(name, keys, source)},
{_counted(name, keys, norm('response'))},
{name}_p as (select *, row_number() over (partition by {keys} order by f) - 1 as pos from {name}_c),
{name}_pairs as (
  select {keys}, x.pos as i, y.pos as j, least(x.val, y.val) as a, greatest(x.val, y.val) as b
  from {name}_p x join {name}_p y using ({keys}) where x.pos < y.pos and x.val <> '' and y.val <> ''),
pairs as (select distinct a, b from {name}_pairs),
{similarity('pairs')},
{name}_pass as (
  select {keys}, list(i * 100000 + j) as ok
  from {name}_pairs join scored using (a, b) where score >= {threshold} group by {keys}),
{name}_lead as (
  select {keys}, list_reduce(list_prepend([]::bigint[], list_transform(range(count(*)), lambda x: [x])),
    lambda acc, x: case when len(list_filter(acc, lambda l: list_contains(coalesce(any_value(ok), []), l * 100000 + x[1]))) > 0
                        then acc else list_append(acc, x[1]) end) as heads
  from {name}_p left join {name}_pass using ({keys}) group by {keys}),
{name}_g as (
  select {keys}, p.val, p.ct, p.f, p.pos,
         list_min(list_filter(heads, lambda l: l = p.pos or (l < p.pos and list_contains(coalesce(ok, []), l * 100000 + p.pos)))) as lead
  from {name}_p p join {name}_lead using ({keys}) left join {name}_pass using ({keys}))"""


def fuzzy(name: str, keys: str, source: str, threshold: int = 85) -> str:
    return f"""{groups(name, keys, source, threshold)},
{name}_m as (
  select *, row_number() over (partition by {keys}, lead order by case when val = '' then 1 else ct end desc, f) as rn,
         sum(case when val = '' then 1 else ct end) over (partition by {keys}, lead) as size,
         (sum(ct) over (partition by {keys}))::bigint as n from {name}_g),
{name}_t as (
  select *, row_number() over (partition by {keys} order by size desc, lead) as top from {name}_m where rn = 1),
{name} as (
  select {keys}, coalesce(val, '') as consensus, coalesce({round3('size::double / n')}, 0.0) as confidence,
         coalesce(n, 0)::bigint as n_responses
  from (select distinct {keys} from {name}_all) left join (select * from {name}_t where top = 1) using ({keys}))"""


VOTES = {"exact": exact, "set": set_, "fuzzy": fuzzy}


def word_vote(name: str, keys: str, source: str, tokens: str, keep: str = "true") -> str:
    return f"""{name}_all as ({source}),
{name}_i as (
  select {keys}, ord, unnest(ws) as word, unnest(range(len(ws))) as pos
  from (select {keys}, ord, {tokens} as ws from {name}_all where {keep})),
{name}_c as (select {keys}, word, count(*) as ct, min(ord * 1000000 + pos) as f from {name}_i group by {keys}, word),
{name}_r as (
  select {keys}, string_agg(word, ' ' order by f) filter (ct > 1) as shared,
         (count(*) filter (ct > 1))::double / count(*) as share from {name}_c group by {keys}),
{name} as (
  select {keys}, coalesce(shared, 'no consensus') as consensus, coalesce(share, 0.0) as confidence
  from (select distinct {keys} from {name}_all) left join {name}_r using ({keys}))"""


WITHIN = "select doc_id, model, run as ord, response from r"
POOLED = "select doc_id, run * 10 + model_idx as ord, response from r"
BY_SOURCE = "select source, doc_id * 1000 + run * 10 + model_idx as ord, response from r"
BETWEEN = f"select doc_id, list_position({list(MODELS)}, model) as ord, consensus as response from w"


def wide(keys: str, table: str = "r") -> str:
    """Pivot CTE `wide`: keys and one column per answer."""
    columns = ", ".join(
        f"max(response) filter (run = {r} and model = {q(m)}) as \"Response_{r} ({m})\"" for r in range(1, RUNS + 1) for m in MODELS
    )
    return f"wide as (select {keys}, {columns} from {table} group by {keys})"


def numbered(keys: str, model: str, table: str = "r", separator: str = "_") -> str:
    columns = ", ".join(
        f"max(response) filter (run = {r} and model = {q(model)}) as \"Response{separator}{r}\"" for r in range(1, RUNS + 1)
    )
    return f"select {keys}, {columns} from {table} group by {keys}"


def pairs_by_model(key: str, struct: str) -> str:
    """CTE `{struct}_wide`: consensus pair columns per model."""
    columns = ", ".join(
        f'max(consensus) filter (model = {q(m)}) as "Consensus ({m})", '
        f'max(confidence) filter (model = {q(m)}) as "Consensus_Confidence ({m})"'
        for m in MODELS
    )
    return f"{struct}_wide as (select {key}, {columns} from {struct} group by {key})"


RESULT = "consensus, confidence, n_responses"
_BANDS = """select band, (count(*) filter (of = band))::bigint as n_rows
from (values ('high'), ('medium'), ('low')) b(band) cross join
     (select case when confidence >= 0.7 then 'high' when confidence >= 0.4 then 'medium' else 'low' end as of from w)
group by band"""

_PROMPT = prompts.text_prompt()
_IMAGE_PROMPT = prompts.image_prompt()
_LIBRARY = "(values " + ", ".join(f"({q(k)}, {q(t)})" for k, t in prompts.library().items()) + ") p(theme, template)"
_THEMES = "(values " + ", ".join(f"({q(k)})" for k in prompts.ABSTRACT_PROMPTS) + ") p(theme)"

ORACLES: dict[str, str] = {
    "scan_csv": "select * from documents",
    "scan_workbooks": "select * from conversations",
    "sink_workbooks": "select * from documents",
    "scan_folder": "select * from conversations",
    "scan_images": with_(
        M, then="select image, octet_length(encode(html))::bigint as length from names join pages using (page_id) "
        "where image in (select image from manifest)"
    ),
    "scan_csv_by_header": "select doc_id, text, case when lang <> 'en' then lang end as lang, source from documents",
    "union_by_name": "select doc_id, text, lang, source, n_chars, null::bigint as item_id from documents union all "
    "select null, text, null, null, null, item_id from benchmark",
    "filter_image_names": with_(M, then="select image from manifest"),
    "select_by_position": "select l_suppkey as publication_date, l_linenumber as author, l_quantity as title, "
    "l_linestatus as abstract from lineitem",
    "sink_roundtrip": with_(R, wide("doc_id"), then="select * from wide"),
    "run_metadata": with_(
        R,
        exact("w", "doc_id, model", WITHIN),
        then=f"""select {q(_PROMPT)} as prompt, {q(', '.join(MODELS))} as models, {RUNS}::int as runs, 0.0::double as delay,
       true as within_on, 'exact' as within_mode, null::double as within_threshold, true as between_on,
       'fuzzy' as between_mode, 85.0::double as between_threshold, false as pooled_on, 'exact' as pooled_mode,
       null::double as pooled_threshold, false as errors_vote,
       count(*) filter (confidence >= 0.7) as n_high,
       count(*) filter (confidence >= 0.4 and confidence < 0.7) as n_medium,
       count(*) filter (confidence < 0.4) as n_low from w""",
    ),
    "assign_identifier": "select doc_id, n_chars, row_number() over (order by n_chars desc, doc_id) as \"Identifier\" from documents",
    "assign_identifier_input_order": 'select l_orderkey, l_linenumber, l_partkey, row_number() over () as "Identifier" from lineitem',
    "project_content": 'select doc_id, text as "Content" from documents',
    "build_prompt": f"select doc_id, {q(_PROMPT)} || ' ' || text as prompt from documents",
    "prompt_library": f"select item_id, theme, template || ' ' || text as prompt from benchmark cross join {_LIBRARY}",
    "build_image_tasks": with_(M, then=f"select image, {q(_IMAGE_PROMPT)} as prompt, '/images/' || image as path from manifest"),
    "clean_response": f"select conv_id, turn, {clean('text')} as response from conversations",
    "normalize_text": f"select doc_id, {norm('text')} as normalized from documents",
    "normalize_light": f"select doc_id, {light('text')} as normalized from documents",
    "split_set": f"""select doc_id, count(*) filter (item is not null) as n_items, coalesce(string_agg(item, '|' order by pos), '') as items
from (select doc_id, item, min(pos) as pos
      from (select doc_id, unnest(ps) as item, unnest(range(len(ps))) as pos
            from (select doc_id, case when len(ps) = 0 then [null] else ps end as ps
                  from (select doc_id, {parts('text')} as ps from documents)))
      group by doc_id, item) group by doc_id""",
    "tokenize_words": f"select doc_id, len(ws)::bigint as n_words, array_to_string(ws, '|') as words "
    f"from (select doc_id, {words('text')} as ws from documents)",
    "filter_blank": with_(
        R, then=f"select doc_id, model, run, {strip('response')} as response from r where {strip('response')} <> ''"
    ),
    "discover_responses": with_(
        R,
        then="select 'Response_' || run || ' (' || model || ')' as label, run, model, count(*) as n_answers from r group by run, model",
    ),
    "error_capture": with_(R, then="select doc_id, model, run, response, status from r where status = 'error'"),
    "pad_missing": with_(
        R,
        then="select doc_id, model, run, case when status = 'ok' then response else 'Error: No response' end as response from r",
    ),
    "fan_out_runs": f"select doc_id, lang, run from documents cross join {_RUNS}",
    "fan_out_models": f"select doc_id, lang, model_idx, model from documents cross join {_MODELS}",
    "annotate_text": with_(R, then=f"select doc_id, model_idx, model, run, {clean('response')} as response, status from r"),
    "annotate_images": with_(IMAGE_R, then="select image, model_idx, model, run, response, status from r"),
    "pivot_responses": with_(R, wide("doc_id"), then="select * from wide"),
    "unpivot_responses": with_(
        R, then="select doc_id, 'Response_' || run || ' (' || model || ')' as label, run, model, response from r"
    ),
    "reorder_columns": with_(R, wide("doc_id"), then="select * from wide"),
    "left_join_responses": with_(
        R,
        f"one as ({numbered('doc_id', 'm2')})",
        then="select labels.*, "
        + ", ".join(f'"Response_{r}" as "Response_{r} (m2)"' for r in range(1, RUNS + 1))
        + " from labels left join one using (doc_id)",
    ),
    "dedupe_identifier": "select * from documents qualify row_number() over (partition by source order by doc_id) = 1",
    "shared_identifier_answers": with_(
        R,
        f"one as ({numbered('doc_id', 'm1')})",
        "firsts as (select source, min(doc_id) as first_id from documents group by source)",
        then="select d.doc_id, d.source, "
        + ", ".join(f'one."Response_{r}" as "Response_{r} (m1)"' for r in range(1, RUNS + 1))
        + " from documents d join firsts using (source) join one on one.doc_id = firsts.first_id",
    ),
    "consensus_exact": with_(R, exact("w", "doc_id, model", WITHIN), then=f"select doc_id, model, {RESULT} from w"),
    "consensus_set": with_(R, set_("w", "doc_id, model", WITHIN), then=f"select doc_id, model, {RESULT} from w"),
    "consensus_fuzzy": with_(R, fuzzy("w", "doc_id, model", WITHIN), then=f"select doc_id, model, {RESULT} from w"),
    "consensus_exact_by_source": with_(R, exact("w", "source", BY_SOURCE), then=f"select source, {RESULT} from w"),
    "consensus_set_by_source": with_(R, set_("w", "source", BY_SOURCE), then=f"select source, {RESULT} from w"),
    "consensus_fuzzy_by_source": with_(SHORT_R, fuzzy("w", "source", BY_SOURCE), then=f"select source, {RESULT} from w"),
    "consensus_words_by_source": with_(
        R, word_vote("w", "source", BY_SOURCE, words("response"), "response is not null"), then="select source, consensus, confidence from w"
    ),
    "consensus_words_in_parts": with_(
        R,
        word_vote("w", "source", BY_SOURCE, words("response"), "response is not null"),
        """p as (
  select source, word, f, sum(length(word) + 1) over (partition by source order by f) - length(word) - 1 as before_it from w_c where ct > 1),
l as (select source, (before_it // 1000)::bigint as part, string_agg(word, ' ' order by f) as words from p group by 1, 2)""",
        then="select source, coalesce(part, 0) as part, coalesce(words, consensus) as consensus, confidence from w left join l using (source)",
    ),
    "consensus_simple": with_(R, simple("w", "doc_id, model", WITHIN), then=f"select doc_id, model, {RESULT} from w"),
    "consensus_words": with_(
        R,
        word_vote("w", "doc_id, model", WITHIN, words("response"), "response is not null"),
        then="select doc_id, model, consensus, confidence from w",
    ),
    "consensus_words_documented": with_(
        R,
        f"said as (select doc_id, model, run, {light('response')} as response from r where {strip('response')} <> '')",
        word_vote("w", "doc_id, model", "select doc_id, model, run as ord, response from said", "string_split(response, ' ')"),
        simple("s", "doc_id, model", "select doc_id, model, run as ord, response from said"),
        then="""select g.doc_id, g.model,
       case when n_responses = 1 or w.confidence = 0 then coalesce(s.consensus, 'no consensus')
            else coalesce(w.consensus, 'no consensus') end as consensus,
       case when n_responses = 1 then 1.0 when w.confidence = 0 then s.confidence else coalesce(w.confidence, 0.0) end as confidence
from (select distinct doc_id, model from r) g left join w using (doc_id, model) left join s using (doc_id, model)""",
    ),
    "pair_similarity": with_(
        R,
        _spoken("w", "doc_id, model", WITHIN),
        _counted("w", "doc_id, model", norm("response")),
        "firsts as (select doc_id, model, arg_min(val, f) as leader from w_c group by doc_id, model)",
        "duo as (select doc_id, model, leader, val from w_c join firsts using (doc_id, model))",
        "pairs as (select distinct least(leader, val) as a, greatest(leader, val) as b from duo "
        "where leader <> val and leader <> '' and val <> '')",
        similarity("pairs"),
        then="""select doc_id, model, leader, val as norm,
       case when leader = '' or val = '' then 0.0 when leader = val then 100.0 else score end as score
from duo left join scored on a = least(leader, val) and b = greatest(leader, val)""",
    ),
    "greedy_groups": with_(
        R,
        groups("w", "doc_id, model", WITHIN),
        then="""select g.doc_id, g.model, g.val as answer, h.val as leader, g.ct as n_votes
from w_g g join w_g h on h.doc_id = g.doc_id and h.model = g.model and h.pos = g.lead""",
    ),
    "confidence_bands": with_(R, exact("w", "doc_id, model", WITHIN), then=_BANDS),
    "low_confidence_review": with_(
        R,
        exact("w", "doc_id", POOLED),
        then="select row_number, doc_id as identifier, round(confidence * 100, 1) as percent "
        "from (select *, row_number() over (order by doc_id) as row_number from w) where confidence < 0.4",
    ),
}

for _mode, _vote in VOTES.items():
    ORACLES[f"within_model_{_mode}"] = with_(
        R, _vote("w", "doc_id, model", WITHIN), then=f"select doc_id, model, {RESULT} from w"
    )
    ORACLES[f"pooled_{_mode}"] = with_(R, _vote("p", "doc_id", POOLED), then=f"select doc_id, {RESULT} from p")


def _renamed_helpers(ctes: str) -> str:
    """A second fuzzy vote in one statement needs its own names for the shared helper tables."""
    for helper in ("pairs", "vals", "pid", "tok", "sides", "merged", "split", "parts", "ordered", "lcs", "sized", "scored"):
        ctes = re.sub(rf"\b{helper}\b", f"{helper}2", ctes)
    return ctes


for _mode, _vote in VOTES.items():
    _between = _vote("b", "doc_id", BETWEEN)
    ORACLES[f"between_model_{_mode}"] = with_(
        R,
        _vote("w", "doc_id, model", WITHIN),
        _renamed_helpers(_between) if _mode == "fuzzy" else _between,
        then=f"select doc_id, {RESULT} from b",
    )

_OK = "case when status = 'ok' then response end"
ORACLES["text_analysis"] = with_(
    R,
    f"c as (select doc_id, model_idx, model, run, {clean('response')} as response, status from r)",
    wide("doc_id", "c"),
    set_("w", "doc_id, model", f"select doc_id, model, run as ord, {_OK} as response from c"),
    pairs_by_model("doc_id", "w"),
    set_("p", "doc_id", f"select doc_id, run * 10 + model_idx as ord, {_OK} as response from c"),
    exact("b", "doc_id", BETWEEN),
    then="""select d.doc_id as "Identifier", d.text as "Content", wide.* exclude (doc_id), w_wide.* exclude (doc_id),
       p.consensus as "Aggregated_Consensus", p.confidence as "Aggregated_Consensus_Confidence",
       b.consensus as "BetweenModel_Consensus", b.confidence as "BetweenModel_Consensus_Confidence"
from documents d join wide using (doc_id) join w_wide using (doc_id) join p using (doc_id) join b using (doc_id)""",
)
ORACLES["image_analysis"] = with_(
    IMAGE_R,
    wide("image"),
    exact("w", "image, model", f"select image, model, run as ord, {_OK} as response from r"),
    pairs_by_model("image", "w"),
    exact("p", "image", f"select image, run * 10 + model_idx as ord, {_OK} as response from r"),
    exact("b", "image", BETWEEN.replace("doc_id", "image")),
    then="""select image as "Image", wide.* exclude (image), w_wide.* exclude (image),
       p.consensus as "Aggregated_Consensus", p.confidence as "Aggregated_Consensus_Confidence",
       b.consensus as "BetweenModel_Consensus", b.confidence as "BetweenModel_Consensus_Confidence"
from wide join w_wide using (image) join p using (image) join b using (image)""",
)
ORACLES["abstract_presets"] = with_(
    f"""a as (
  select doc_id, theme, run, {answer('w1', 'w2', "'Error: No response'")} as response
  from (select *, {kind('doc_id', 'theme', 'run')} as k
        from (select doc_id, {both_ways("text")} from documents)
        cross join {_THEMES} cross join {_RUNS}))""",
    "n as (select doc_id, theme, "
    + ", ".join(f'max(response) filter (run = {r}) as "Response {r}"' for r in range(1, RUNS + 1))
    + " from a group by doc_id, theme)",
    then="""select theme, doc_id % 30 + 1990 as "Publication Date", source as "Author", split_part(text, chr(10), 1) as "Title",
       md5(text) as "Abstract", n.* exclude (doc_id, theme) from documents join n using (doc_id)""",
)
ORACLES["aggregate_outputs"] = with_(
    R,
    "f as (select * from r where model = 'm1' or (model = 'm2' and run <= 3))",
    word_vote("w", "doc_id, model", "select doc_id, model, run as ord, response from f", words("response")),
    "n as (select doc_id, model, "
    + ", ".join(f'max(response) filter (run = {r}) as "Response {r}"' for r in range(1, RUNS + 1))
    + " from f group by doc_id, model)",
    then='select n.*, consensus as "Consensus Result", confidence as "Consensus over Total" from n join w using (doc_id, model)',
)
ORACLES["aggregate_folder"] = with_(
    f"""r as (
  select doc_id, model_idx, model, run, {answer('w1', 'w2')} as response
  from (select *, {kind('doc_id', 'model', 'run')} as k
        from (select item_id as doc_id, {both_ways('text')} from benchmark)
        cross join {_MODELS} cross join {_RUNS}))""",
    "f as (select * from r where model = 'm1' or (model = 'm2' and run <= 3))",
    word_vote("w", "doc_id, model", "select doc_id, model, run as ord, response from f", words("response")),
    "n as (select doc_id, model, "
    + ", ".join(f'max(response) filter (run = {r}) as "Response {r}"' for r in range(1, RUNS + 1))
    + " from f group by doc_id, model)",
    then='select n.*, consensus as "Consensus Result", confidence as "Consensus over Total" from n join w using (doc_id, model)',
)
ORACLES["single_model_analysis"] = with_(
    R,
    f"c as (select doc_id, model, run, case when status = 'ok' then {clean('response')} else 'Error occurred' end as response "
    "from r where model = 'm1')",
    f"n as ({numbered('doc_id', 'm1', 'c')})",
    simple("s", "doc_id", "select doc_id, run as ord, response from c"),
    then="""select doc_id as "Identifier", text as "Content", n.* exclude (doc_id), consensus as "Consensus_Result",
       confidence as "Consensus_Confidence" from documents join n using (doc_id) join s using (doc_id)""",
)

_EVENTS = "select user_id, event_id as ord, event_type as response from events"
_TURNS = "select conv_id, turn as ord, text as response from conversations"
ORACLES["consensus_exact_events"] = "with " + exact("w", "user_id", _EVENTS) + f" select user_id, {RESULT} from w"
ORACLES["consensus_set_turns"] = "with " + set_("w", "conv_id", _TURNS) + f" select conv_id, {RESULT} from w"
ORACLES["consensus_words_turns"] = (
    "with " + word_vote("w", "conv_id", _TURNS, words("response"), "response is not null") + " select conv_id, consensus, confidence from w"
)
for _mode in VOTES:
    ORACLES[f"block_{_mode}"] = with_(
        R,
        VOTES[_mode]("p", "doc_id", POOLED),
        then='select doc_id, consensus as "Aggregated_Consensus", confidence as "Aggregated_Consensus_Confidence" from p',
    )
ORACLES["block_between"] = with_(
    R,
    exact("w", "doc_id, model", WITHIN),
    exact("b", "doc_id", BETWEEN),
    then='select doc_id, consensus as "BetweenModel_Consensus", confidence as "BetweenModel_Consensus_Confidence" from b',
)
ORACLES["run_analysis"] = with_(
    f"""r as (
  select doc_id, model_idx, model, run, {clean(answer('w1', 'w2'))} as response
  from (select *, {kind('doc_id', 'model', 'run')} as k
        from (select doc_id, {both_ways('text')} from (select row_number() over (order by item_id) as doc_id, text from benchmark))
        cross join {_MODELS} cross join {_RUNS}))""",
    exact("w", "doc_id", POOLED),
    then="select doc_id as row_number, doc_id as identifier, round(confidence * 100, 1) as percent from w where confidence < 0.4",
)

# --- words as values, digit codes, grades

_QUALITY = """
v as (select lang, source, quality::double as x from labels join documents using (doc_id)),
m as (select {keys} count(*) as n, avg(x) as mean, var_pop(x) * count(*) as m2 from v group by {groups})"""


def _totals(over: str) -> str:
    return f"""
a as (select *, sum(n) over ({over}) as nn, sum(n * mean) over ({over}) / sum(n) over ({over}) as mm from m),
t as (select *, sum(n * (mean - mm) * (mean - mm)) over ({over}) as between_, sum(m2) over ({over}) as within_ from a)"""


ORACLES["annotate_resumed"] = ORACLES["annotate_text"]
ORACLES["lookup_values"] = with_(
    "w as (select doc_id, unnest(list_distinct([x for x in [source, lang] if x is not null])) as word from documents)",
    "l as (select distinct lang as word, ascii(lang)::double as value from documents where lang is not null)",
    then="select doc_id, word, value from w left join l using (word)",
)
ORACLES["lookup_anova"] = with_(
    _QUALITY.format(keys="lang, source,", groups="1, 2"),
    _totals("partition by lang"),
    "s as (select lang, sum(n)::bigint as n, count(*) as groups, max(between_) as b, max(within_) as w from t group by lang)",
    then="""select lang, n, groups, groups - 1 as df_between, n - groups as df_within,
  case when groups > 1 and n > groups and w > 0 then round((b / (groups - 1)) / (w / (n - groups)), 6) end as f from s""",
)
ORACLES["lookup_t_tests"] = with_(
    _QUALITY.format(keys="source,", groups="1"),
    _totals(""),
    "r as (select *, (nn - n)::bigint as rest_n, case when nn > n then (nn * mm - n * mean) / (nn - n) end as rest_mean from t)",
    """d as (select *, greatest(0, between_ + within_ - m2 - (mean - rest_mean) * (mean - rest_mean) * n * rest_n / nn) as rest_m2 from r),
u as (select *, case when n > 1 and rest_n > 1 then m2 / (n - 1) / n end as va, case when n > 1 and rest_n > 1 then rest_m2 / (rest_n - 1) / rest_n end as vb from d)""",
    then="""select source, n, rest_n, round(mean, 6) as mean, round(rest_mean, 6) as rest_mean,
  case when va + vb > 0 then round((mean - rest_mean) / sqrt(va + vb), 6) end as t,
  case when va + vb > 0 then round((va + vb) * (va + vb) / (va * va / (n - 1) + vb * vb / (rest_n - 1)), 6) end as df from u""",
)
ORACLES["digit_codes"] = with_(
    """d as (select doc_id, lang, source, case when length(text) < 500 then 'short' when length(text) < 3000 then 'middle' else 'endless' end as size from documents),
p as (select *, coalesce(list_position(['en', 'fr', 'de'], lang), 0) as a,
  coalesce(list_position(list_transform(range(20), lambda i: 'src' || i), source), 0) as b, coalesce(list_position(['short', 'middle', 'long'], size), 0) as c from d)""",
    then="""select doc_id, (a * 1000 + b * 10 + c)::bigint as code,
  concat_ws(',', case when a = 0 and lang is not null then 'lang' end, case when b = 0 and source is not null then 'source' end, case when c = 0 then 'size' end) as unknown,
  case when a > 0 then lang end as lang, case when b > 0 then source end as source, case when c > 0 then size end as size from p""",
)
_JUDGE = f"{grading.TEMPLATE}\n\nPrompt: {prompts.text_prompt()}\n\nResponse: "
_GRADES = (
    R,
    f"""h as (select doc_id, model, ('0x' || substr(md5({q(_JUDGE)} || response), 1, 8))::bigint as h from r where status = 'ok' and trim(response) <> ''),
g as (select doc_id, model, avg(h % 10 + 1) as grade from h where h % 23 <> 0 group by 1, 2),
c as (select *, count(*) over (partition by doc_id) as of_all from g),
k as (select doc_id, model, grade, rank() over (partition by doc_id order by grade) + (count(*) over (partition by doc_id, grade) - 1) / 2 as place,
  count(*) over (partition by doc_id, grade) as same from c where of_all = {len(MODELS)}),
ranks as (select doc_id, model, grade, place, same * same - 1 as ties from k)""",
)
ORACLES["judge_grades"] = with_(*_GRADES, then="select * from ranks")
ORACLES["judge_friedman"] = with_(
    *_GRADES,
    """p as (select model, count(*) as n, sum(place) as r, sum(ties) as ties from ranks group by model),
s as (select max(n)::double as n, count(*)::double as k, sum(r * r) as r2, sum(ties) as ties from p),
f as (select *, (12 * r2 / (n * k * (k + 1)) - 3 * n * (k + 1)) / (1 - ties / (n * k * (k * k - 1))) as x from s)""",
    then="""select n::bigint as items, k::bigint as models, round(x, 6) as chi_squared, round((n - 1) * x / (n * (k - 1) - x), 6) as f,
  k - 1 as df_between, (k - 1) * (n - 1) as df_within from f""",
)
ORACLES["judge_bootstrap"] = with_(
    *_GRADES,
    f"""e as (select doc_id, a.model, a.grade - b.grade as d from ranks a join ranks b using (doc_id) where b.model = '{MODELS[0]}' and a.model <> '{MODELS[0]}'),
x as (select *, ('0x' || substr(md5(concat_ws('|', '7', doc_id, draw)), 1, 8))::bigint / 4294967296e0 as u from e cross join range(1, 41) s(draw)),
y as (select *, {' + '.join(f'(u >= {p!r})::int' for p in grading.POISSON)} as w from x),
z as (select model, draw, sum(w * d) / sum(w) as m from y group by 1, 2)""",
    then="""select z.model, round(any_value(o.difference), 6) as difference, round(quantile_cont(m, 0.025), 6) as low, round(quantile_cont(m, 0.975), 6) as high
from z join (select model, avg(d) as difference from e group by 1) o on o.model = z.model group by 1""",
)
