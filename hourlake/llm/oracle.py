"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from hourlake.llm import licences
from hourlake.llm.mixing import FULL_WORDS, LEAST_QUALITY, MOST_EPOCHS, WEIGHTS

WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP3 = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size from documents
), keyed as (
  select *, -ln((('0x' || substr(md5(concat('20:', coalesce(doc_id::varchar, ''))), 1, 13))::bigint + 0.5) / {float(1 << 52)!r}::double)
    / greatest({LEAST_QUALITY}::double, least(1.0::double, size / {float(FULL_WORDS)}::double)) as k
  from sized
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighted as (
  select *, list_extract([{', '.join(map(str, WEIGHTS))}], ((row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1)::int) as weight,
    source_size * {MOST_EPOCHS} as cap
  from sources
), placed as (
  select *, row_number() over w as place,
    ((sum(source_size) over ())::bigint - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0)::bigint)::double
    / ((sum(weight) over ())::bigint - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0)::bigint)::double as level
  from weighted window w as (order by cap::double / weight, source nulls last)
), targets as (
  select source, source_size, least(cap::double, (select arg_min(level, place) from placed where cap::double / weight >= level) * weight) as target
  from placed
), parts as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from targets
), ordered as (
  select k.*, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size as rest,
    coalesce(sum(k.size) over (partition by k.source order by k.k, k.doc_id, k.size rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from keyed k join parts p on k.source is not distinct from p.source
)
select doc_id, size, source_size, target,
  (case when size > 0 then least({MOST_EPOCHS}, epochs + case when before + size * 0.5::double <= rest then 1 else 0 end) else 0 end * size)::bigint as taken
from ordered
"""

OP7 = """
with hashed as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), grouped as (
  select *, max(page_id) over (partition by h) as largest from hashed
)
select page_id, strlen(html)::bigint as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(h, 1 + 10 * (i // 8)::int, 10))::bigint >> (35 - 5 * (i % 8))::int) & 31))::int, 1)), 'string_agg', '') as payload_digest,
  case when page_id is not distinct from largest then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from largest then largest end as refers_to
from grouped
"""


def _op9() -> str:
    def sentences(ends: str) -> str:
        cut = f"string_split(regexp_replace(t, '{ends}', chr(1), 'g'), chr(1))"
        return f"list_filter(list_transform({cut}, lambda s: trim(regexp_replace(s, '{licences.GAP}', ' ', 'g'))), lambda s: s <> '')"

    known = "map {" + ", ".join(f"{_quoted(s)}: {_quoted(i)}" for i, s in licences.SENTENCES.items()) + "}"
    ids = lambda c: f"list_filter(list_transform({c}, lambda s: {known}[s]), lambda i: i is not null)"
    steps, last = [], "r0"
    for k, (run, name) in enumerate(licences.RULES, 1):
        text = _quoted(f";{';'.join(run)};")
        steps.append(f"r{k} as (select doc_id, n_unknown, ids, replace(seq, {text}, ';') as seq, case when contains(seq, {text}) then list_append(found, {_quoted(name)}) else found end as found from {last})")
        last = f"r{k}"
    marks = " or ".join(f"contains(s, '{m}')" for m in licences.MARKS)
    return f"""
with lowered as (select doc_id, lower(coalesce(text, '')) as t from documents),
cut as (select doc_id, {sentences(licences.ENDS)} as a, {sentences(licences.ENDS_UNWRAPPED)} as b from lowered),
named as (select doc_id, a, {ids('a')} as ia, {ids('b')} as ib from cut),
r0 as (select doc_id, ids, ';' || array_to_string(ids, ';') || ';' as seq, []::varchar[] as found, n_unknown from (
  select doc_id, case when len(ib) > len(ia) then ib else ia end as ids,
    len(list_filter(a, lambda s: ({marks}) and {known}[s] is null))::bigint as n_unknown from named)),
{', '.join(steps)}
select doc_id, coalesce(array_to_string(list_sort(list_distinct(found)), ','), '') as licences, coalesce(array_to_string(ids, ','), '') as sentences, n_unknown from {last}
"""


OP4 = """
with recursive rows as (
  select vec_id, label, embedding::double[] as v from embeddings
), ok as (
  select vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) as size from rows
  where label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.98
), reach as (
  select vec_id as node, vec_id as root from rows
  union
  select links.b, reach.root from reach join links on links.a = reach.node where reach.root < links.b
), roots as (
  select node, min(root) as component_id from reach group by node
)
select vec_id, (select count(*) from links where a = vec_id)::bigint as n_links, component_id, vec_id = component_id as kept
from rows join roots on node = vec_id
"""

OP6 = rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then []::varchar[] when len(w) = 1 then [w[1]]
    else list_distinct(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) end as s from words
), items as (
  select doc_id, len(s) as n, unnest(s) as x from sets
), links as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach as (
  select doc_id as node, doc_id as root from sets
  union
  select links.b, reach.root from reach join links on links.a = reach.node where reach.root < links.b
), roots as (
  select node, min(root) as component_id from reach group by node
)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept from sets join roots on node = doc_id
"""

OP8 = rf"""
with texts as (
  select doc_id, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)) as ls from documents
), lines as (
  select doc_id, unnest(range(len(ls)))::bigint as line, unnest(ls) as t from texts
), sets as (
  select doc_id, line, list_sort(list_distinct(regexp_extract_all(t, '{WORD}'))) as w from lines
), filled as (
  select *, doc_id * 1000000 + line as place from sets where len(w) > 0
), firsts as (
  select w, len(w) as n, min(place) as first from filled group by w
), words as (
  select first, n, unnest(w) as x from firsts
), frequent as (
  select x, count(*) as f from words group by x
), ranked as (
  select first, n, x, row_number() over (partition by first order by f, x) as pos from words join frequent using (x)
), rare as (
  select * from ranked where pos <= n - ceil(n * 4 / 5.0) + 1
), pairs as (
  select distinct a.first as y, b.first as x from rare a join rare b on a.x = b.x and a.first < b.first and 5 * a.n >= 4 * b.n and 5 * b.n >= 4 * a.n
), gone as (
  select distinct pairs.x as first from pairs join firsts a on a.first = pairs.x join firsts b on b.first = pairs.y
  where 100 * len(list_intersect(a.w, b.w)) >= 80 * (a.n + b.n - len(list_intersect(a.w, b.w)))
), judged as (
  select doc_id, line, place <> firsts.first or gone.first is not null as goes from filled join firsts using (w) left join gone on gone.first = firsts.first
)
select doc_id, count(line)::bigint as n_lines, count(line) filter (goes)::bigint as n_removed, coalesce(string_agg(line::varchar, ',' order by line) filter (goes), '') as removed_lines
from documents left join judged using (doc_id) group by doc_id
"""

SQL = {"op8_line_dedup": OP8, "op3_mixing": OP3, "op4_embedding_dedup": OP4, "op6_minhash": OP6, "op7_warc": OP7, "op9_licences": _op9()}
