"""The operators' queries as DuckDB SQL, where SQL can say them."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

URLS = r"""
with p as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), h as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from p
), rules(verdict, rule_host, rule_path) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits as (
  select page_id, host, path, rule_host || rule_path as rule, verdict,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc) as k
  from h left join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule, coalesce(verdict, 'allow') as verdict
from fits where k = 1
"""

WARC = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (
  select page_id, strlen(html) as payload_bytes, sha1(html) as hex, min(page_id) over (partition by sha1(html)) as first from p
),
parts as (
  select hex, k, s, (('0x' || substr(hex, (k * 5 + 1)::int, 5))::bigint >> s) & 31 as digit
  from (select distinct hex from d), (select unnest(range(8)) as k), (select unnest([15, 10, 5, 0]) as s)
),
b as (
  select hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', digit::int + 1, 1), '' order by k, s desc) as payload_digest
  from parts group by hex
)
select page_id, payload_bytes, payload_digest, case when first < page_id then 'revisit' else 'response' end as record_type,
  case when first < page_id then first end as refers_to
from d join b using (hex)
"""

QUALITY = rf"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents
),
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
l as (select doc_id, line, regexp_extract_all(line, '{_WORD}') as w from lines),
dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from l where len(w) > 0 group by doc_id),
grams as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, w from d where len(w) >= 3
),
keyed as (select doc_id, i, w[i] || chr(0) || w[i + 1] || chr(0) || w[i + 2] as gram from grams),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, gram) as c from keyed) where c > 1),
covered as (
  select doc_id, count(distinct i + k) as n_repeat_words from twice, (select unnest([0, 1, 2]) as k) group by doc_id
),
marked as (
  select doc_id, line, w, len(w) as n, len(w) <= 30 as is_short,
    -- separators between words; a bullet or dash at either end separates nothing
    list_filter(range(1, len(w) - 1), lambda k: list_contains(['|', '»', '›', '·', '•', '/', '>', '>>', '::', '–', '—'], w[k + 1])) as places,
    len(list_filter(w, lambda x: regexp_matches(x, '(?:[!?]{{2,}}|[#*$%&|<>^~=_+\\]+)[.,;:]?$'))) as marks,
    list_max(map_values(list_aggregate(w, 'histogram'))) as most,
    regexp_matches(lower(line), '(^|[^\p{{L}}\p{{N}}_])(javascript|cookie policy|cookies policy|use of cookies|privacy policy|terms of use|terms of service|all rights reserved|lorem ipsum|sign in|log in|click here|read more|subscribe to our newsletter|skip to content)($|[^\p{{L}}\p{{N}}_])') as phrase
  from l where len(w) > 0
),
judged as (
  select doc_id, n, marks, most, is_short, phrase, len(places) as separators,
    -- two dashes enclose an aside, so a menu of dashes has three
    2 + (len(list_filter(places, lambda k: not list_contains(['–', '—'], w[k + 1]))) = 0)::int as least,
    list_max(list_transform(list_zip(list_concat([-1], places), list_concat(places, [n])), lambda x: x[2] - x[1] - 1)) as longest
  from marked
),
kept as (
  select doc_id, sum(n) as kept_words from judged
  where not ((separators >= least and separators > 0.15 * n and longest <= 4) or marks > 0.3 * n or (n >= 10 and most > 0.3 * n) or (is_short and phrase))
  group by doc_id
),
counts as (
  select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(kept_words, 0) as kept_words
  from d left join dup using (doc_id) left join covered using (doc_id) left join kept using (doc_id)
),
base as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and kept_words >= 0.5 * n_words as kept
from base
"""

JACCARD = rf"""
with recursive d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w
  from documents
),
grams as (
  select distinct doc_id, w[i] || chr(0) || w[i + 1] || chr(0) || w[i + 2] as gram
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)
  union all
  select doc_id, array_to_string(w, chr(0)) from d where len(w) between 1 and 2
),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from grams a join grams b on a.gram = b.gram and a.doc_id < b.doc_id
  group by all
),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)
),
edges as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, e.b from reach r join edges e on e.a = r.other
)
select doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
from reach left join sizes using (doc_id) group by doc_id
"""

def _change(old: str, new: str) -> str:
    """`old` with one document of each source on the other side, that whose size is nearest to the source's gap."""
    return f"""{old}_gap as (
  select source, none, any_value(rest) - sum(case when more then size else 0 end) as gap from {old} where rest > 0 group by source, none
),
{old}_best as (
  select source, none, doc_id as best from {old} join {old}_gap using (source, none)
  where more = (gap < 0) and abs(size - abs(gap)) < abs(gap)
  qualify row_number() over (partition by source, none order by abs(size - abs(gap)), bucket, ord) = 1
),
{new} as (
  select {old}.* replace (more <> coalesce(doc_id = best, false) as more) from {old} left join {old}_best using (source, none)
)"""


MIXING = rf"""
with docs as (
  select doc_id, coalesce(source, '') as source, source is null as none,
    len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size, md5('mix/' || doc_id) as ord
  from documents
),
sources as (
  select source, none, sum(size) as source_size, (row_number() over (order by none, source) - 1) % 3 + 1.0::double as weight
  from docs group by source, none
),
levels as (
  select *, 3.0 * source_size / weight as ratio,
    ((select sum(source_size) from sources) - coalesce(sum(3.0 * source_size) over before, 0)) / sum(weight) over after as level
  from sources
  window before as (order by 3.0 * source_size / weight, none, source rows between unbounded preceding and 1 preceding),
         after as (order by 3.0 * source_size / weight, none, source rows between current row and unbounded following)
),
targets as (
  select source, none, source_size, least(weight * (select level from levels where ratio >= level order by ratio, none, source limit 1), 3.0 * source_size) as target
  from sources
),
shares as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0) as whole, target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size as rest
  from targets
),
drawn0 as (
  select d.*, s.source_size, s.target, s.whole, s.rest, ('0x' || substr(ord, 1, 8))::bigint % 1024 as bucket from docs d join shares s using (source, none)
),
drawn as (
  select *, rest > 0 and sum(size) over (partition by source, none order by bucket, ord) - size / 2 <= rest as more from drawn0
),
{_change('drawn', 'second')},
{_change('second', 'third')}
select doc_id, size, source_size, target, cast(least(whole + more::int, 3) * size as bigint) as taken from third
"""

def _levels(table: str, most: int) -> tuple[str, str]:
    """CTEs that build trees of runs of three over `table` (tree, pos, d), and the name of the last: (tree, k, d, sides) of every
    row, with the siblings from the bottom up. A tree that has one node stays as it is; `most` levels are enough for 3 ** most rows."""
    steps = [f"{table}_0 as (select tree, pos, pos as place, d as node, [] as sides, count(*) over (partition by tree) as n from {table})"]
    for k in range(most):
        steps.append(f"""{table}_n{k} as (select distinct tree, place, node, n from {table}_{k}),
{table}_r{k} as (
  select tree, place // 3 as run, list(node order by place) as nodes, any_value(n) as n from {table}_n{k} group by all
),
{table}_{k + 1} as (
  select x.tree, pos, case when x.n = 1 then place else run end as place,
    case when x.n = 1 then node else sha256(array_to_string(nodes, '')) end as node,
    case when x.n = 1 then sides else list_append(sides, {{'l': array_to_string(nodes[: place % 3], ''), 'r': array_to_string(nodes[place % 3 + 2 :], '')}}) end as sides,
    (x.n + 2) // 3 as n
  from {table}_{k} x join {table}_r{k} y on x.tree = y.tree and place // 3 = run
)""")
    return ",\n".join(steps), f"{table}_{most}"


_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"

_ROWS, _LAST_ROWS = _levels("leaves", 13)
_TOPS, _LAST_TOPS = _levels("roots", 5)

# CRC-32 by a table of the remainders of all bytes
MERKLE = rf"""
with crc_table as (
  select list(list_reduce(list_concat([n::ubigint], [0::ubigint for i in range(8)]),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) order by n) as t
  from range(256) r(n)
),
numbered as (
  select *, row_number() over () as k,
    xor(list_reduce(list_concat([4294967295::ubigint], [ascii(x)::ubigint for x in string_split(doc_id::varchar, '')]),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::int + 1])), 4294967295::ubigint) % 2 = 0 as hit
  from documents, crc_table
),
digests as (
  select k, doc_id, coalesce('=' || source, '') as tree, {_LEAF.format(text='text')} as d,
    {_LEAF.format(text="(case when hit then replace(text, chr(10), '') else text end)")} as today
  from numbered
),
leaves as (select *, row_number() over (partition by tree order by doc_id nulls first, d) - 1 as pos from digests),
{_ROWS},
sub as (select tree, any_value(node) as d from {_LAST_ROWS} group by tree),
roots as (select '' as tree, tree as source, d, row_number() over (order by encode(tree)) - 1 as pos from sub),
{_TOPS},
whole as (
  select doc_id, l.d as leaf, today, roots.d as subroot, t.node as root, list_concat(a.sides, t.sides) as sides
  from leaves l join {_LAST_ROWS} a on l.tree = a.tree and l.pos = a.pos join roots on roots.source = l.tree
  join {_LAST_TOPS} t on t.pos = roots.pos
),
folded as (
  select *, list_reduce(list_concat([{{'l': '', 'r': today}}], sides),
    lambda x, s: {{'l': '', 'r': sha256(s.l || x.r || s.r)}}).r as folded_root from whole
)
select doc_id, leaf, subroot, root, sha256(array_to_string([s.l || s.r for s in sides], '')) as proof_sha256, folded_root,
  folded_root = root as verified
from folded
"""

_LEAK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LEAK_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + _LEAK_WORD + "')"

LEAKS = rf"""
with items as (select item_id::varchar as item, {_LEAK_WORDS} as w from benchmark where item_id is not null),
runs as (
  select distinct item, array_to_string(w[i : i + 9], ' ') as run, least(len(w), 10) as n
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)
),
d as (select doc_id, {_LEAK_WORDS} as w from documents),
found as (
  select doc_id, i, n, item from (
    select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as run
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from runs) where len(w) >= n)
  ) join runs using (run, n)
),
hit as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from found) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by encode(item)) as items from (select distinct doc_id, item from found) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join named using (doc_id)
"""

ORACLES = {
    "op4_jaccard": JACCARD, "op5_urls": URLS, "op6_warc": WARC, "op8_mixing": MIXING, "op10_quality": QUALITY, "op11_merkle": MERKLE,
    "op13_leaks": LEAKS,
}
