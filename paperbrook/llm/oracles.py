"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op1_decontamination"] = rf"""
with doc as (
  select doc_id, list_filter(regexp_split_to_array({ASCII_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from documents
), item as (
  select item_id, list_filter(regexp_split_to_array({ASCII_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from benchmark
), win as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i+9], ' ') as win
  from item, unnest(generate_series(1, greatest(len(w) - 9, 1))) t(i) where len(w) > 0
), sizes as (select distinct n from win
), spots as (
  select doc_id, i, n, array_to_string(w[i:i+n-1], ' ') as win
  from doc, sizes, unnest(generate_series(1, len(w) - n + 1)) t(i) where len(w) >= n
), hit as (select doc_id, i, spots.n, item_id from spots join win on spots.win = win.win and spots.n = win.n
), words as (select doc_id, count(distinct p) as n_hit from hit, unnest(generate_series(i, i + n - 1)) t(p) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hit) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (doc_id) left join items using (doc_id)
"""

ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
    r"[aA][pP][iI]_?[kK][eE][yY])[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
)


def positions(name: str, pattern: str, holds: str) -> str:
    return rf"""
{name}_cut as (
  select doc_id, regexp_extract_all(t, '{pattern}') as m, string_split_regex(t, '{pattern}') as g from doc
), {name} as (
  select doc_id, '{name}' as kind, m[i] as match,
         coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as s
  from {name}_cut, unnest(range(1, len(m) + 1)) r(i) where {holds}
)"""


ORACLES["op9_secrets"] = rf"""
with doc as (select doc_id, coalesce(text, '') as t from documents),
{positions("assign", ASSIGN, f"length(regexp_extract(m[i], '{ASSIGN}', 2)) >= 12")},
{positions("access", "AKIA[A-Z0-9]+", "length(m[i]) >= 18")},
{positions("hex", "[0-9a-f]+", "length(m[i]) >= 16")},
{positions("candidate", "[A-Za-z0-9+/_-]+={0,2}", "length(m[i]) >= 20")},
wanted as (
  select doc_id, s, rtrim(match, '=') as match, case when regexp_matches(match, '^[0-9A-Fa-f]+$') then 'entropy_hex'
    else 'entropy_base64' end as kind
  from candidate
  where regexp_matches(match, '[0-9]') and regexp_matches(match, '[A-Za-z]') and length(rtrim(match, '=')) >= 20
    and not regexp_matches(match, '^[0-9A-Fa-f]{{8}}(-[0-9A-Fa-f]{{4}}){{3}}-[0-9A-Fa-f]{{12}}$')
    and not regexp_matches(lower(match), 'example|sample|placeholder|changeme|dummy|xxxx|0123456789|1234567890|abcdefgh')
    and not regexp_matches(match, '^(data[:/]|iVBORw0KGgo)')
), hot as (
  select doc_id, kind, s, j from wanted, unnest(range(1, length(match) - 18)) r(j)
  where round(list_aggregate(string_split(substr(match, j, 20), ''), 'entropy'), 6)
        >= case kind when 'entropy_hex' then 2.9 else 3.6 end
), runs as (
  select *, sum(apart) over (partition by doc_id, s order by j) as run
  from (select *, case when j - lag(j) over (partition by doc_id, s order by j) <= 20 then 0 else 1 end as apart from hot)
), spans as (
  select doc_id, kind, s::bigint as s, (s + length(match))::bigint as e, k
  from (select *, 1 as k from assign union all select *, 2 from access union all select *, 3 from hex)
  union all
  select doc_id, kind, (s + min(j) - 1)::bigint, (s + max(j) + 19)::bigint,
         case kind when 'entropy_hex' then 4 else 5 end
  from runs group by doc_id, kind, s, run
), each as (
  select doc_id, count(*) filter (k = 1) as n_assign, count(*) filter (k = 2) as n_access, count(*) filter (k = 3) as n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, k, e) filter (k <= 3) as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, k, e) as spans
  from spans group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join each using (doc_id)
"""

BITS_40 = " || ".join(
    "array_to_string(list_transform(range(8), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"1 + ((('0x' || substr(h, {1 + 10 * part}, 10))::bigint >> (35 - 5 * i)::int) & 31)::int, 1)), '')"
    for part in range(4)
)
ORACLES["op6_warc"] = f"""
with page as (select page_id, coalesce(html, '') as p, sha1(coalesce(html, '')) as h from pages),
top as (select *, max(page_id) over (partition by p) as first from page)
select page_id, strlen(p)::bigint as payload_bytes, {BITS_40} as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from top
"""

# crc32 bit by bit: each byte is met, then eight steps (-1) follow.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
  string_split({0}, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, 3988292384 * (c & 1)) end))"""

ORACLES["op11_prefix_trie"] = rf"""
with own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
         sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as turn,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words
  from conversations where conv_id is not null
), convs as (select conv_id, {CRC32.format("conv_id::varchar")} % 4 as h from (select distinct conv_id from own)
), parts as (
  select convs.conv_id, 0 as part, pos, turn, words from convs join own on own.conv_id = convs.conv_id - convs.conv_id % 20 and pos <= h
  union all
  select convs.conv_id, 1, pos, turn, words from convs join own on own.conv_id = convs.conv_id and pos > h
), path as (
  select conv_id, row_number() over w as depth, string_agg(turn, '') over w as node, words,
         count(*) over (partition by conv_id) as n from parts window w as (partition by conv_id order by part, pos)
  union all
  select conv_id, 0, '', 0, (select count(*) from parts where parts.conv_id = convs.conv_id) from convs
), nodes as (
  select node, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
         string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = n) as ends
  from path group by node
), up as (select node, left(node, greatest(len(node) - 64, 0)) as parent from nodes where depth > 0
), kids as (select parent as node, count(*) as n_children from up group by parent
), pairs as (
  select distinct a.node, b.node as below from path a join path b on a.conv_id = b.conv_id and b.depth >= a.depth
), sums as (
  select pairs.node, count(*) filter (where kids.node is null) as n_leaves, sum((b.n_convs - 1) * b.words) as saved
  from pairs join nodes b on b.node = pairs.below left join kids on kids.node = pairs.below group by pairs.node
)
select nodes.conv_id, depth::bigint as depth, p.conv_id as parent_conv_id, nodes.n_convs, coalesce(n_children, 0)::bigint as n_children,
       n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(coalesce(ends, '')) as ends_sha256
from nodes join sums using (node) left join kids using (node) left join up using (node)
left join (select node as parent, conv_id from nodes) p using (parent)
"""
