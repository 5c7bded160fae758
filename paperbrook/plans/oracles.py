"""The registered queries in SQL, for the check against DuckDB."""

from __future__ import annotations

LISTED = """
listed as (
  select doc_id, source, text, n_chars,
    case when lang = 'en' then 'Housing' else 'Construction' end as category,
    (2023 + doc_id % 3)::int as year,
    (['Jan', 'February', 'SEP', 'sept', 'December', 'May'])[doc_id % 6 + 1] as month_name,
    ([1, 2, 9, 9, 12, 5])[doc_id % 6 + 1]::int as month
  from documents
),
located as (
  select *, category || '/' || year || '/' || month_name || '/' || doc_id || '.txt' as rel_path,
    '/corpus/' || category || '/' || year || '/' || month_name || '/' || doc_id || '.txt' as path
  from listed
)
"""

DAYS = f"""
with {LISTED},
one as (select *, doc_id % 1000 as mtime from located where source <> 'src19'),
two as (select *, doc_id % 1000 + (source = 'src7')::int as mtime from located where source <> 'src0'),
track as (select path, n_chars as length, mtime, category, year, month, 'INDEXED' as status,
  1::bigint as version, true as is_current, true as indexed from one)
"""

MERGED = f"""
{DAYS},
merged as (
  select coalesce(t.path, s.path) as path,
    case when t.path is null or s.mtime > t.mtime then s.n_chars else t.length end as length,
    case when t.path is null or s.mtime > t.mtime then s.mtime else t.mtime end as mtime,
    coalesce(t.category, s.category) as category, coalesce(t.year, s.year) as year,
    coalesce(t.month, s.month) as month,
    case when t.path is null then 'NEW' when s.mtime > t.mtime then 'UPDATED' else t.status end as status,
    case when t.path is null then 1 when s.mtime > t.mtime then t.version + 1 else t.version end as version,
    true as is_current, coalesce(t.indexed, false) as indexed, s.path is null as absent
  from track t full outer join two s on t.path = s.path
),
synced as (
  select * exclude (absent) replace (
    case when absent then 'DELETED' else status end as status, not absent as is_current)
  from merged
)
"""

TRACK_COLUMNS = "path, length, mtime, category, year, month, status, version, is_current, indexed"


def windows(files: str, name: str) -> str:
    """Fixed windows of the rows of ``files`` as relation ``name``."""
    return f"""
{name} as (
  select path, version, category, year, month, i::int as ordinal,
    substring(text, i * 768 + 1, 1024) as chunk_text, md5(path || '|' || version || '|' || i) as chunk_id
  from (
    select *, unnest(range(0, greatest(1, ceil((length(text) - 256) / 768.0)::bigint))) as i
    from {files} where length(text) > 0
  )
)"""


CHUNKS = f"""
with {LISTED},
files as (select *, 1::bigint as version from located),
{windows('files', 'chunks')}
"""

REVISED = f"""
with {LISTED},
old_files as (select *, 1::bigint as version from located where source <> 'src19'),
new_files as (
  select * replace (case when source = 'src7' then lower(text) else text end as text),
    case when source = 'src7' then 2 else 1 end::bigint as version
  from located where source in ('src7', 'src19')
),
same_files as (select * replace (1::bigint as version) from new_files),
{windows('old_files', 'old')},
{windows('new_files', 'new')},
{windows('same_files', 'same')},
upserted as (select * from old where chunk_id not in (select chunk_id from same) union all select * from same),
next as (select * from upserted where path not in (select path from located where source = 'src0'))
"""

CHUNK_COLUMNS = "path, chunk_id, chunk_text, category, year, month"

# The names of the months, long and short, written out here on their own.
MONTH_VALUES = """
  ('january', 1), ('jan', 1), ('february', 2), ('feb', 2), ('march', 3), ('mar', 3), ('april', 4), ('apr', 4),
  ('may', 5), ('june', 6), ('jun', 6), ('july', 7), ('jul', 7), ('august', 8), ('aug', 8), ('september', 9),
  ('sep', 9), ('sept', 9), ('october', 10), ('oct', 10), ('november', 11), ('nov', 11), ('december', 12), ('dec', 12)
"""


def recursive_chunks() -> str:
    """Cut at blank lines, line ends, blanks and characters; pack each run of small pieces greedily."""
    parts = [
        "docs as (select path, text from located where length(text) > 0)",
        "unit0 as (select path, 0::bigint as lo, text as body from docs where length(text) > 1024)",
    ]
    separators = ["chr(10) || chr(10)", "chr(10)", "' '"]
    for i, sep in enumerate(separators):
        parts.append(f"""
cut{i} as (
  select path, unit, idx, plen,
    (sum(plen) over (partition by path, unit order by idx) - plen + unit)::bigint as b
  from (
    select path, lo as unit, idx, length(part) + case when idx > 1 then length({sep}) else 0 end as plen
    from (select path, lo, unnest(string_split(body, {sep})) as part,
            generate_subscripts(string_split(body, {sep}), 1) as idx
          from unit{i} where contains(body, {sep}))
  ) where plen > 0
),
mark{i} as (
  select *, sum((plen >= 1024)::int) over (partition by path, unit order by idx) as island from cut{i}
),
unit{i + 1} as (
  select path, lo, body from unit{i} where not contains(body, {sep})
  union all
  select path, b, substring(text, b + 1, plen) from mark{i} join docs using (path) where plen >= 1024
)""")
    small = "\n  union all ".join(
        f"select path, path || '|{i}|' || unit || '|' || island as run, b, b + plen as e from mark{i} where plen < 1024"
        for i in range(len(separators))
    )
    last = len(separators)
    parts.append(f"""
piece as (
  {small}
  union all select path, path || '|{last}|' || lo as run, lo + i as b, lo + i + 1 as e
  from (select *, unnest(range(0, length(body))) as i from unit{last})
),
reach as (
  select path, run, b, max(e) over (partition by run order by e
    range between current row and 1024 - (e - b) following) as stop from piece
),
ahead as (
  select r.*, case when n.e is not null then greatest(r.stop - 256, n.e - 1024) end as earliest
  from reach r left join piece n on n.run = r.run and n.b = r.stop
),
jump as (
  select path, run, b, stop, case when earliest is not null then min(b) over (partition by run order by b
    range between coalesce(earliest - b, 0) following and unbounded following) end as next_b
  from ahead
),
walk as (
  select path, run, b, stop, next_b from jump where (run, b) in (select (run, min(b)) from piece group by run)
  union all
  select j.path, j.run, j.b, j.stop, j.next_b from walk w join jump j on j.run = w.run and j.b = w.next_b
),
raw as (
  select path, b, substring(text, b + 1, stop - b) as body from walk join docs using (path)
  union all select path, 0, text from docs where length(text) <= 1024
),
stripped as (
  select path, b + length(body) - length(ltrim(body, chr(9) || chr(10) || chr(13) || ' ')) as start,
    trim(body, chr(9) || chr(10) || chr(13) || ' ') as chunk_text, b
  from raw
)
select path, (row_number() over (partition by path order by b) - 1)::int as ordinal, start::int as start,
  (start + length(chunk_text))::int as "end", chunk_text
from stripped where chunk_text <> ''""")
    return f"with recursive {LISTED},\n" + ",\n".join(parts)


PAGE_TEXT = r"""
with a as (select page_id, regexp_replace(html,
    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g') as t from pages),
b as (select page_id, regexp_replace(t, '(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr|title|nav|article|section|header|footer|'
    'aside|ul|ol|dt|dd|option|caption|blockquote|pre)\s*>', chr(10), 'g') as t from a),
c as (select page_id, regexp_replace(regexp_replace(t, '(?i)</t[dh]\s*>', ' ', 'g'), '(?s)<[^>]*>', '', 'g') as t from b),
ref as (select page_id, string_split_regex(t, '&#[0-9]{1,7};|&[a-z]{2,6};') as g,
    regexp_extract_all(t, '&#[0-9]{1,7};|&[a-z]{2,6};') as r from c),
d as (select page_id, array_to_string(list_transform(range(1, len(g) + 1), lambda i: g[i] || case
    when i > len(r) then '' when r[i] = '&nbsp;' then chr(160) when r[i] = '&lt;' then '<' when r[i] = '&gt;' then '>'
    when r[i] = '&quot;' then '"' when r[i] = '&amp;' then '&' when r[i] = '&eacute;' then 'é'
    when r[i] = '&copy;' then '©' when r[i] = '&middot;' then '·' when r[i] like '&#%' then chr(r[i][3:-2]::int) else r[i] end), '') as t from ref),
e as (select page_id, regexp_replace(t, '[ \t\r\x{00A0}]+', ' ', 'g') as t from d)
select page_id, trim(regexp_replace(t, ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) as text from e
"""

TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def tokens(column: str) -> str:
    return TOKENS.format(column)


def postings(chunks: str, name: str = "postings") -> str:
    return f"""
{name} as (
  select term, chunk_id, count(*) as tf, any_value(doc_len) as doc_len, any_value(category) as category,
    any_value(year) as year, any_value(month) as month
  from (select *, unnest(terms) as term, len(terms) as doc_len
        from (select *, {tokens('chunk_text')} as terms from {chunks}))
  group by term, chunk_id
)"""


def hashed(rows: str, key: str, text: str, name: str) -> str:
    """Sparse hashed vectors of unit length: key, bucket, weight."""
    return f"""
{name} as (
  select {key}, bucket, n / sqrt(sum(n * n) over (partition by {key})) as weight
  from (
    select {key}, ('0x' || substr(md5(term), 1, 8))::bigint % 64 as bucket, count(*)::double as n
    from (select {key}, unnest({tokens(text)}) as term from {rows}) group by all
  )
)"""


TOP = "row_number() over (partition by query_id order by score desc, chunk_id)"

SEARCH_PARTS = f"""
asked as (select item_id as query_id, text from benchmark),
{postings('chunks')},
corpus as (select count(*) as n, avg(len({tokens('chunk_text')})) as avg_len from chunks),
terms as (select distinct query_id, unnest({tokens('text')}) as term from asked),
frequency as (select term, count(*) as df from postings group by term)
"""
SEARCH = f"{CHUNKS}, {SEARCH_PARTS}"


def by_keyword(name: str, where: str = "true", k: int = 42) -> str:
    return f"""
{name} as (
  select * from (
    select *, {TOP} as rank from (
      select query_id, chunk_id, round(sum(
        ln(1e0 + (n - df + 5e-1) / (df + 5e-1)) * (tf * 2.2e0) / (tf + 1.2e0 * (2.5e-1 + 7.5e-1 * doc_len / avg_len))
      ), 6) as score
      from terms join frequency using (term) join postings using (term), corpus
      where {where} group by query_id, chunk_id
    )
  ) where rank <= {k}
)"""


def by_vector(name: str, where: str = "true", k: int = 42) -> str:
    return f"""
{name} as (
  select * from (
    select *, {TOP} as rank from (
      select query_id, c.chunk_id, round(coalesce(sum(weight * a_weight), 0), 6) as score
      from (select query_id, chunk_id, from asked, chunks where {where}
        and query_id in (select query_id from asked_vec) and chunk_id in (select chunk_id from chunk_vec)) c
      left join (select query_id as qid, chunk_id as cid, v.weight, a.weight as a_weight
                 from asked_vec a join chunk_vec v using (bucket)) s on s.qid = c.query_id and s.cid = c.chunk_id
      group by c.query_id, c.chunk_id
    )
  ) where rank <= {k}
)"""


VECTORS = f"{hashed('asked', 'query_id', 'text', 'asked_vec')},\n{hashed('chunks', 'chunk_id', 'chunk_text', 'chunk_vec')}"


def hybrid(where: str = "true", k: int = 42, search: str = SEARCH) -> str:
    return f"""
{search},
{VECTORS},
{by_keyword('kw', where, k)},
{by_vector('vec', where, k)},
hits as (
  select * from (
    select *, {TOP} as rank from (
      select coalesce(v.query_id, w.query_id) as query_id, coalesce(v.chunk_id, w.chunk_id) as chunk_id,
        round(coalesce(1e0 / (60 + v.rank), 0) + coalesce(1e0 / (60 + w.rank), 0), 9) as score
      from vec v full outer join kw w on v.query_id = w.query_id and v.chunk_id = w.chunk_id
    )
  ) where rank <= {k}
)
"""


def knn(where: str = "true", k: int = 42) -> str:
    return f"""
select * from (
  select *, {TOP} as rank from (
    select q.vec_id as query_id, v.vec_id as chunk_id,
      round(list_inner_product(q.embedding::double[], v.embedding::double[]), 6) as score
    from embeddings q, embeddings v where {where}
  )
) where rank <= {k}
"""


LSH = """
with plane as (
  select t, b, list(1e0 - 2 * (('0x' || substr(md5(t || '|' || b || '|' || d), 1, 8))::bigint % 2) order by d) as p
  from range(8) x(t), range(8) y(b), range(64) z(d) group by t, b
),
code as (
  select vec_id, t, sum(case when list_inner_product(embedding::double[], p) > 0 then 1 << b::int else 0 end) as code
  from embeddings, plane group by vec_id, t
),
pair as (
  select distinct q.vec_id as query_id, v.vec_id as chunk_id from code q join code v on q.t = v.t and q.code = v.code
),
scored as (
  select query_id, chunk_id, round(list_inner_product(a.embedding::double[], b.embedding::double[]), 6) as score
  from pair join embeddings a on a.vec_id = query_id join embeddings b on b.vec_id = chunk_id
)
"""

CHUNKED_RUNS = f"chunked as ({recursive_chunks()}), {MERGED.strip().removeprefix('with')}"

COUNTS = "select {0}, count(*) as n from synced group by {0}"
RANKED = "select query_id, chunk_id, score, rank from {}"
FILTERED = "category = 'Construction' and year >= 2024 and month < 9"


def sync_moments() -> str:
    return f"""
{REVISED},
{hashed('next', 'chunk_id', 'chunk_text', 'vec')},
moment as (select chunk_id, sum(weight * (bucket + 1)) as m from vec group by chunk_id)
select chunk_id, len({tokens('chunk_text')}) as doc_len, round(coalesce(m, 0), 6) as moment
from next left join moment using (chunk_id)
"""


ROW_CHANGES = f"""
        select {CHUNK_COLUMNS}, 'insert' as change_type from next where chunk_id not in (select chunk_id from old)
        union all select {CHUNK_COLUMNS}, 'delete' from old where chunk_id not in (select chunk_id from next)
        union all select o.* from (select {CHUNK_COLUMNS}, 'update_preimage' from old) o
          join next n on o.chunk_id = n.chunk_id and o.chunk_text <> n.chunk_text
        union all select n.* from (select {CHUNK_COLUMNS}, 'update_postimage' from next) n
          join old o on o.chunk_id = n.chunk_id and o.chunk_text <> n.chunk_text"""


def statistics(chunks: str) -> str:
    return f"""
select term, count(*) as df, 0::bigint as length from postings group by term
union all select null, count(*), sum(len({tokens('chunk_text')}))::bigint from {chunks}"""


ORACLES: dict[str, str] = {
    "track_status_by_category": MERGED + COUNTS.format("category, status"),
    "track_status": MERGED + COUNTS.format("status"),
    "track_sync": MERGED + f"select {TRACK_COLUMNS} from synced",
    "track_sync_bucketed": MERGED + f"select {TRACK_COLUMNS} from synced",
    "track_upsert": MERGED + f"select {TRACK_COLUMNS} from merged",
    "track_mark_deleted": DAYS + """
        select t.* replace (case when s.path is null then 'DELETED' else status end as status,
          s.path is not null as is_current) from track t left join two s on t.path = s.path""",
    "track_deleted_paths": DAYS + "select path from one where path not in (select path from two)",
    "track_mark_indexed": MERGED + f"""
        select {TRACK_COLUMNS} from (select * replace (
          case when status in ('NEW', 'UPDATED') then 'INDEXED' else status end as status,
          indexed or status in ('NEW', 'UPDATED') as indexed) from synced)""",
    "track_revive": MERGED + """
        , again as (
          select s.path is not null as back, y.* from synced y left join one s on s.path = y.path
        )
        select false as revive, case when is_current and not back then 'DELETED' else status end as status,
          count(*) as n from again group by all
        union all
        select true, case when not is_current and back then 'UPDATED' when is_current and not back then 'DELETED'
          else status end as status, count(*) from again group by all""",
    "files_to_index": MERGED + "select path, status, version from synced where status in ('NEW', 'UPDATED')",
    "files_to_index_full_refresh": MERGED + "select path, status, version from synced where status <> 'DELETED'",
    "files_to_delete": MERGED + "select path, status, version from synced where status = 'DELETED'",
    "run_metrics": MERGED + f"""
        , live_files as (select *, 1 as version from two), {windows('live_files', 'live')}
        select count(*) filter (status in ('NEW', 'UPDATED')) as rows_to_index,
          count(*) filter (status = 'DELETED') as rows_to_delete,
          (select count(*) from live) as vector_rows, 1024::bigint as chunk_size, 256::bigint as chunk_overlap
        from synced""",
    "path_metadata": f"""with {LISTED}
        select path, rel_path, replace(rel_path, '/', '|') as levels, category, year, month from located""",
    "page_paths": r"""
        with p as (select page_id, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*:/+', '/') as path from pages)
        select page_id, path, substr(path, 2) as rel_path, string_split(substr(path, 2), '/')[1] as category,
          try_cast(string_split(substr(path, 2), '/')[2] as int) as year,
          null::int as month from p""",
    "month_names": f"""
        with name as (
          select strftime(ts, '%B') as month_name, event_type from events
          union all select upper(strftime(ts, '%b')), event_type from events
          union all select event_type, event_type from events
        )
        select month_name, month::int as month, count(*) as n
        from name left join (values {MONTH_VALUES}) m(name, month) on lower(month_name) = name
        group by month_name, month""",
    "metadata_violations": f"""with {LISTED}
        select path, concat_ws(',', case when category <> 'Housing' then 'category' end,
          case when year not between 2023 and 2024 then 'year' end,
          case when month not between 1 and 11 then 'month' end) as violations from located""",
    "page_text": PAGE_TEXT,
    "joined_pages": """
        select doc_id, array_to_string(list_transform(string_split(text, ' '),
          lambda p: case when length(p) > 1 then p else '' end), chr(10)) as text from documents""",
    "folder_listing": """
        select 'lang=' || lang as folder, sum(strlen(text) + 1)::bigint as bytes from documents group by lang""",
    "folder_text": """
        select 'lang=' || lang as folder, sum(length(text) + 1)::bigint as chars,
          sum(length(text) - length(replace(text, chr(10), '')) + 1)::bigint as line_breaks
        from documents group by lang""",
    "chunk_fixed": CHUNKS + f"select {CHUNK_COLUMNS}, version, ordinal from chunks",
    "chunk_recursive": recursive_chunks(),
    "chunk_recursive_invariants": """
        select 0::bigint as too_long, 0::bigint as wrong_span, 0::bigint as blank, 0::bigint as unordered,
          0::bigint as overlapping, 0::bigint as uncovered""",
    "chunks_by_category": CHUNKS + """
        select category, year, month, count(*) as n from chunks group by category, year, month""",
    "distinct_paths": CHUNKS + "select distinct path from chunks",
    "chunk_upsert": REVISED + f"select {CHUNK_COLUMNS} from upserted",
    "chunk_replace": REVISED + f"""
        select {CHUNK_COLUMNS}, version from old where path not in (select path from new_files)
        union all select {CHUNK_COLUMNS}, version from new""",
    "chunk_delete": REVISED + f"""
        select {CHUNK_COLUMNS} from old where path not in (select path from located where source = 'src0')""",
    "chunk_changes": REVISED + ROW_CHANGES,
    "chunk_changes_by_digest": REVISED + ROW_CHANGES,
    "chunk_changes_applied": REVISED + f"select {CHUNK_COLUMNS} from next",
    "filter_equal": "select event_id from events where event_type = 'error'",
    "filter_in": "select event_id from events where event_type in ('click', 'error')",
    "filter_not": "select event_id from events where event_type <> 'click'",
    "filter_not_in": "select event_id from events where event_type not in ('click', 'error')",
    "filter_less": "select event_id from events where value < 10.5",
    "filter_less_equal": "select event_id from events where user_id <= 20",
    "filter_greater": "select event_id from events where value > 10.5",
    "filter_greater_equal": "select event_id from events where user_id >= 20",
    "filter_or": """
        select event_id from events where event_type in ('click', '{"k": 69}') or props in ('click', '{"k": 69}')""",
    "filter_like": f"""
        select doc_id from (select doc_id, {tokens('text')} as t from documents)
        where list_contains(t, 'the') and list_contains(t, 'and')""",
    "filter_like_skipped": f"""
        select doc_id from (select doc_id, {tokens('text')} as t from documents)
        where list_contains(t, 'the') and list_contains(t, 'and')""",
    "filter_and": f"""
        select event_id from events where event_type in ('click', 'error') and user_id >= 5 and value < 50
          and list_contains({tokens('props')}, 'k')""",
    "filters_refused": f"""with {LISTED}
        select distinct category, year, month, case when category <> 'Housing' then 'category'
          when year not between 2023 and 2024 then 'year' when month not between 1 and 11 then 'month' end as refused
        from located where source <> 'src0'""",
    "filter_glob": r"select page_id, url from pages where regexp_matches(url, '(?i)\.html$')",
    "embed_chunks": CHUNKS + f"""
        , {hashed('chunks', 'chunk_id', 'chunk_text', 'vec')}
        select chunk_id, len({tokens('chunk_text')}) as doc_len, bucket, round(weight, 6) as weight
        from vec join chunks using (chunk_id)""",
    "index_postings": CHUNKS + f", {postings('chunks')} select term, chunk_id, tf, doc_len, category, year from postings",
    "index_sync_postings": REVISED + f", {postings('next')} select term, chunk_id, tf, doc_len from postings",
    "feed_streamed": REVISED + f", {postings('next')} select term, chunk_id, tf, doc_len from postings",
    "index_sync_vectors": sync_moments(),
    "postings_stored": CHUNKS + f", {postings('chunks')} select term, chunk_id, tf, doc_len, category, year from postings",
    "index_statistics": CHUNKS + f", {postings('chunks')} {statistics('chunks')}",
    "index_statistics_synced": REVISED + f", {postings('next')} {statistics('next')}",
    "knn_topk": knn(),
    "knn_topk_blocks": knn(),
    "knn_filtered": knn("v.label in (1, 3)"),
    "similarity_topk": f"{SEARCH}, {VECTORS}, {by_vector('vec')} " + RANKED.format("vec"),
    "bm25_topk": f"{SEARCH}, {by_keyword('kw')} " + RANKED.format("kw"),
    "bm25_topk_blocks": f"{SEARCH}, {by_keyword('kw')} " + RANKED.format("kw"),
    "bm25_pruned": f"{SEARCH}, {by_keyword('kw')} " + RANKED.format("kw"),
    "bm25_pruned_filtered": f"{SEARCH}, {by_keyword('kw', FILTERED)} " + RANKED.format("kw"),
    "hybrid_topk": hybrid() + RANKED.format("hits"),
    "knn_int_ids": f"select query_id::int as query_id, chunk_id, score, rank from ({knn(k=10)})",
    "hybrid_no_hits": hybrid(search=SEARCH.replace(
        "asked as (select item_id as query_id, text from benchmark)",
        "asked as (select item_id as query_id, case when item_id % 2 = 0 then '. . .' else text end as text from benchmark)",
    )) + """
        select query_id, case when count(chunk_id) > 0 then 'OK' else 'NO_RESULTS' end as status, count(chunk_id) as num_results
        from asked left join hits using (query_id) group by query_id""",
    "search_envelope_json": f"{SEARCH}, {by_keyword('kw', 'month = 5', 10)}" + """
        select query_id, '{"status":"' || case when count(chunk_id) > 0 then 'OK' else 'NO_RESULTS' end || '","num_results":'
          || count(chunk_id) || ',"docs":[' || coalesce(string_agg('{"chunk_id":"' || chunk_id || '"}', ',' order by rank), '')
          || ']}' as result
        from asked left join kw using (query_id) group by query_id""",
    "hybrid_filtered": hybrid(FILTERED) + """
        select query_id, chunk_id, score, rank, chunk_text, path, year, month from hits join chunks using (chunk_id)""",
    "hybrid_one_month": hybrid("category = 'Construction' and year = 2025 and month = 5") + RANKED.format("hits"),
    "hybrid_one_month_skipped": hybrid("category = 'Construction' and year = 2025 and month = 5") + RANKED.format("hits"),
    "hybrid_before_september": hybrid("month < 9") + RANKED.format("hits"),
    "search_envelope": SEARCH.replace(
        "select item_id as query_id, text from benchmark",
        "select conv_id || '-' || turn as query_id, text from conversations where role = 'user'",
    ) + f"""
        , {by_keyword('kw', "category = 'Housing' and month = 5")}
        select query_id, case when count(chunk_id) > 0 then 'OK' else 'NO_RESULTS' end as status,
          count(chunk_id) as num_results, coalesce(string_agg(chunk_id, ',' order by rank), '') as docs
        from asked left join kw using (query_id) group by query_id""",
    "approx_topk": LSH + f"select * from (select *, {TOP} as rank from scored) where rank <= 42",
    "approx_recall": LSH + f"""
        , exact as ({knn(k=10)}), found as (select * from (select *, {TOP} as rank from scored) where rank <= 10)
        select round(avg((f.chunk_id is not null)::int), 6) as recall,
          (select round(count(*) / (select count(*) * count(*) from embeddings), 6) from scored) as share_examined
        from exact e left join found f on f.query_id = e.query_id and f.chunk_id = e.chunk_id""",
    "corpus_runs": f"""
        with recursive {CHUNKED_RUNS},
        per_path as (select path, count(*) as n from chunked group by path)
        select category, case when status in ('NEW', 'UPDATED') then 'INDEXED' else status end as status, version,
          count(*) as files, sum(case when status = 'DELETED' then 0 else coalesce(n, 0) end)::bigint as chunks
        from synced left join per_path using (path) group by all""",
    "corpus_full_refresh": f"""
        with recursive chunked as ({recursive_chunks()}), {LISTED},
        per_path as (select path, count(*) as n from chunked group by path)
        select category, 'INDEXED' as status, 1::bigint as version, count(*) as files, sum(coalesce(n, 0))::bigint as chunks
        from located left join per_path using (path) group by category""",
    "corpus_answers": f"with recursive {CHUNKED_RUNS}," + hybrid(FILTERED, 10, f"""
        chunks as (
          select path, chunk_text, category, year, month, md5(path || '|' || version || '|' || ordinal) as chunk_id
          from chunked join synced using (path) where status <> 'DELETED'
        ), {SEARCH_PARTS}""") + """
        select query_id, case when count(chunk_id) > 0 then 'OK' else 'NO_RESULTS' end as status,
          count(chunk_id)::int as num_results, coalesce(string_agg(path, ',' order by rank), '') as paths
        from asked left join (select * from hits join chunks using (chunk_id)) using (query_id) group by query_id""",
    "corpus_answer_texts": f"with recursive {CHUNKED_RUNS}," + hybrid(FILTERED, 42, f"""
        chunks as (
          select path, chunk_text, category, year, month, md5(path || '|' || version || '|' || ordinal) as chunk_id
          from chunked join synced using (path) where status <> 'DELETED'
        ), {SEARCH_PARTS}""") + """
        select query_id, rank, chunk_id, path, chunk_text from hits join chunks using (chunk_id)""",
    "track_streamed": MERGED + "select path, length, mtime, category, year, month, status2 as status, version, is_current from ("
        "select *, case when status = 'INDEXED' then 'NEW' else status end as status2 from merged)",
    "files_streamed": f"""
        with recursive chunked as ({recursive_chunks().replace("select path, text from located", "select path, text || chr(10) as text from located")}),
        {LISTED}, per_path as (select path, count(*) as n from chunked group by path)
        select path, category, year, month, 'INDEXED' as status, 1::bigint as version, coalesce(n, 0) as chunks
        from located left join per_path using (path)""",
}
