"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

from folioflow.sources.tables import JUNK_SAMPLE, MARK_SAMPLE

WS = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}]"
JUNK = r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{fffd}\x{e000}-\x{f8ff}]"


def _codes(s: str) -> str:
    """A string by code points, as control characters do not stand well in SQL."""
    return " || ".join(f"chr({ord(c)})" for c in s)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'), ' ')"


def compact(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', '', 'g')"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def tokens(x: str) -> str:
    return f"greatest(1, length({x}) // 4)::int"


#: Documents by line; four lines are a page.
DOCS = """
docs as (select doc_id::varchar as doc_id, doc_id as k, string_split(text, chr(10)) as l from documents where doc_id is not null and text is not null)"""
PAGES = f"""{DOCS},
cut as (
  select doc_id, k, p as page, array_to_string(l[4 * p + 1 : 4 * p + 4], chr(10)) as t, false as short from (select *, unnest(range(0, (len(l) + 3) // 4)) as p from docs)
  union all select doc_id, k, (len(l) + 3) // 4, 'Short page', true from docs where k % 40 = 2),
pages as (
  select doc_id, page::int as page, 595.0 as width, 842.0 as height, case (k + page) % 40 when 0 then t || {_codes(JUNK_SAMPLE)} when 1 then t || {_codes(MARK_SAMPLE)} else t end as text,
    case (k + page) % 11 when 0 then 595.0 * 700 when 1 then 10000.0 end as image, 448.0 * (len(string_split(t, chr(10))) * 12) as block, case when short then (k % 3) * 80 else 5 end as n_drawings
  from cut)"""

MARKS = r"[\p{Mn}\p{Mc}]"
ANY_SCRIPT = r"[\x{300}-\x{36f}\x{1ab0}-\x{1aff}\x{1dc0}-\x{1dff}\x{20d0}-\x{20ff}\x{fe20}-\x{fe2f}]"
#: Expects pages(doc_id, page, text); gives scores(doc_id, page, junk, orphans, symbols).
SCORES = rf"""
ch as (
  select doc_id, page, i, t[i] as c from (select doc_id, page, string_split(text, '') as t, unnest(range(1, length(text) + 1)) as i from pages where regexp_matches(text, '{MARKS}'))),
based as (
  select *, last_value(case when regexp_matches(c, '^([\p{{Mn}}\p{{Mc}}]|\p{{Cf}})$') then null else c end ignore nulls)
    over (partition by doc_id, page order by i rows between unbounded preceding and 1 preceding) as base from ch),
orphan as (
  select doc_id, page, count(*) as n from based where regexp_matches(c, '^{MARKS}$') and (base is null or not regexp_matches(base, '^\p{{L}}$')
    or (not regexp_matches(c, '^{ANY_SCRIPT}$') and unicode(c) // 128 <> unicode(base) // 128)) group by all),
tok as (select doc_id, page, unnest(regexp_split_to_array(text, '{WS}+')) as w from pages),
sym as (
  select doc_id, page, sum(len(regexp_extract_all(w, '[\\\]\[=<>^_@#|~]'))) as n from tok
  where regexp_matches(regexp_replace(w, '[\x00-\x7f]', '', 'g'), '\p{{L}}') group by all),
scores as (
  select p.doc_id, p.page, {count(compact("p.text"), JUNK)}::int as junk, coalesce(o.n, 0)::int as orphans, coalesce(s.n, 0)::int as symbols, length({compact("p.text")}) as compact
  from pages p left join orphan o using (doc_id, page) left join sym s using (doc_id, page))"""

PROFILES = f"""{PAGES.replace("pages as (", "raw as (")},
pages as (select * replace ({strip("coalesce(text, '')")} as text) from raw),
{SCORES.strip()},
profiles as (
  select p.doc_id, p.page, length(p.text)::int as text_chars, s.compact::int as text_compact_chars, s.junk as junk_chars,
    case when s.compact > 0 then s.orphans + s.symbols else 0 end::int as mojibake_chars,
    round_even(coalesce(image, 0) / (595.0 * 842.0)::double, 3)::double as max_image_coverage, round_even(least(1.0, block / (595.0 * 842.0)::double), 3)::double as text_bbox_area_frac,
    case when length(p.text) < 50 then n_drawings end::int as vector_segments
  from pages p join scores s using (doc_id, page))"""

ROUTES = """
judged as (
  select *, max_image_coverage > 0.70 as raster, text_chars >= 50 as has_text,
    junk_chars >= 20 or junk_chars / greatest(1, text_compact_chars) >= 0.005 as junk, mojibake_chars >= 8 or mojibake_chars / greatest(1, text_compact_chars) >= 0.01 as moji
  from profiles),
routes as (
  select doc_id, page,
    case when raster then 'vlm' when has_text and (junk or moji) then 'vlm' when has_text then 'native' when coalesce(vector_segments >= 100, false) then 'drawing' else 'vlm' end as extractor,
    case when raster then ['raster covers the page']
      when has_text and (junk or moji) then list_filter([case when junk then printf('junk characters: %d', junk_chars) end, case when moji then printf('mojibake characters: %d', mojibake_chars) end], lambda x: x is not null)
      when has_text then [printf('clean text: %d characters', text_chars)] when coalesce(vector_segments >= 100, false) then [printf('drawing: %d vector items', vector_segments)]
      else [printf('little text: %d characters', text_chars)] end as reasons
  from judged)"""

LINES = """
ln as (select doc_id, i // 4 as page, i, l[i + 1] as line from (select *, unnest(range(0, len(l))) as i from docs))"""
UNITS = f"""{DOCS},{LINES},
units as (
  select doc_id, page, (page * 1000 + 2 + 2 * (i % 4))::bigint as seq, 72.0 + 14 * (i % 50) as y0, 72.0 + 14 * (i % 50) + 12 as y1, case when i % 6 = 0 then 'title' else 'text' end as type,
    case when i % 6 = 0 then case i % 4 when 0 then (i // 6 + 1) || '. ' || line when 2 then (i // 6 + 1) || '.2 ' || line else line end else line end as content,
    case when i % 6 = 0 and page % 5 = 3 and i % 12 = 0 then 1 + i % 4 end as level, case when i % 6 = 0 then 18.0 - 2 * (length(line) % 3) + [0.0, 0.4, -0.4, 0.5][i % 4 + 1] end as font_size,
    null::varchar as storage_key, case when page % 5 = 3 then 'gemini' else 'pymupdf' end as source
  from ln
  union all select doc_id, page, (page * 1000 + 3 + 2 * (i % 4))::bigint, 72.0 + 14 * (i % 50) + 13, 72.0 + 14 * (i % 50) + 25, 'figure', '', null, null, printf('figures/p%04d_f%02d.png', page, i), case when page % 5 = 3 then 'gemini' else 'pymupdf' end from ln where i % 17 = 5
  union all select distinct doc_id, page, (page * 1000)::bigint, 20.0, 32.0, 'text', 'Report ' || doc_id || '  page ' || page, null, null, null, case when page % 5 = 3 then 'gemini' else 'pymupdf' end from ln
  union all select distinct doc_id, page, (page * 1000 + 999)::bigint, 820.0, 832.0, 'text', 'Confidential', null, null, null, case when page % 5 = 3 then 'gemini' else 'pymupdf' end from ln where page % 2 = 0)"""

NORM = rf"regexp_replace({collapse('lower(content)')}, '\p{{Nd}}+', '#', 'g')"
FURNITURE = rf"""
furniture as (
  select doc_id, round_even(y0 / 8, 0)::bigint as bucket, {NORM} as norm, count(distinct page) as pages from units
  where type in ('text', 'title') and {strip("content")} <> '' and (y0 <= 842.0 * 0.2 or y1 >= 842.0 * (1 - 0.2)) group by all having count(distinct page) >= 3)"""
STRIPPED = rf"""
stripped as (
  select u.* from units u where not (type in ('text', 'title') and {strip("content")} <> '' and exists (
    select 1 from furniture f where f.doc_id = u.doc_id and f.bucket = round_even(u.y0 / 8, 0)::bigint and f.norm = {NORM.replace("content", "u.content")})))"""


def levels(of: str, out: str) -> str:
    """of(units) with the level resolved."""
    return rf"""
{out} as (
  select u.* replace (case when type = 'title' then least(6, coalesce(level, dep, rk, 1)) else level end::int as level) from (
    select *, case when regexp_extract(content, '^(\p{{Nd}}+(?:\.\p{{Nd}}+)*)\.?{WS}', 1) <> '' then len(regexp_extract_all(regexp_extract(content, '^(\p{{Nd}}+(?:\.\p{{Nd}}+)*)\.?{WS}', 1), '\.')) + 1 end as dep,
      case when type = 'title' and font_size > 0 then dense_rank() over (partition by doc_id, source, type = 'title' and coalesce(font_size, 0) > 0 order by round_even(font_size, 0) desc nulls last) end as rk from {of}) u)"""


_CUSTOMERS = "select n_name || ' ' || (c_custkey // 500) as doc_id, row_number() over (partition by n_name, c_custkey // 500 order by {}) - 1 as n, c_name, c_mktsegment, c_custkey from customer join nation on c_nationkey = n_nationkey"
FRAGMENTS = f"""
cust as (select *, [c_name, c_mktsegment, c_custkey::varchar] as row from ({_CUSTOMERS.format("c_custkey")})),
fragments as (
  select doc_id, (n // 10)::int as page, 72.0 as y0, case when (n // 10) % 4 = 3 then 500.0 else 800.0 end as y1, list_concat([['name', 'segment', 'key']], list(row order by n)) as cells from cust group by doc_id, n // 10)"""
#: Rows of the spanned tables one by one: the header of a chain's first page, then data; h is a page's rows of header.
SPANNED = f"""
sc as (select *, n // 10 as page, n // 40 as chain, n % 10 as j from ({_CUSTOMERS.format("c_mktsegment, c_custkey")})),
sp as (select doc_id, page, chain, case when page % 4 = 0 or page % 3 in (1, 2) then 1 else 0 end as h, count(*) as size from sc group by all),
sl as (select doc_id, page, c_mktsegment as last from sc where j = 9),
sr as (
  select sc.doc_id, sc.chain, 1 + n - 40 * sc.chain as r, case when sc.page % 4 <> 0 and c_mktsegment = sl.last then '' else c_mktsegment end as v, c_name, c_custkey, j = 0 and sc.page % 4 <> 0 as begins
  from sc left join sl on sl.doc_id = sc.doc_id and sl.page = sc.page - 1
  union all select distinct doc_id, chain, 0, 'segment', 'name', null, false from sc),
walked as (
  select doc_id, chain, r, v as w, null::varchar as above, false as act, null::varchar as val from sr where r = 0
  union all
  select s.doc_id, s.chain, s.r, case when s.v = '' and a.act then a.val else s.v end, a.w, a.act and s.v = '', a.val
  from (select w.doc_id, w.chain, s.r, s.v, w.w, case when s.begins then s.r >= 2 and w.w <> '' and w.above is not distinct from w.w else w.act end as act, case when s.begins then w.w else w.val end as val
    from walked w join sr s on s.doc_id = w.doc_id and s.chain = w.chain and s.r = w.r + 1) a join sr s on s.doc_id = a.doc_id and s.chain = a.chain and s.r = a.r),
sm as (
  select doc_id, chain, page, unnest(case when page % 4 = 0 then ['0-0-1-2', '0-2-2-1', '1-0-2-1'] when h = 0 then [(1 + 10 * (page % 4)) || '-0-2-1'] else [(1 + 10 * (page % 4)) || '-2-1-1', (1 + 10 * (page % 4)) || '-0-2-1'] end) as m,
    unnest(range(0, case when page % 4 = 0 then 3 when h = 0 then 1 else 2 end)) as i from sp)"""
CHAINS = """
linked as (
  select *, lag(page) over w as p0, lag(y1) over w as z0 from fragments window w as (partition by doc_id order by page)),
chained as (
  select *, sum(case when page = p0 + 1 and z0 >= 842.0 * 0.9 and y0 <= 842.0 * 0.12 then 0 else 1 end) over (partition by doc_id order by page rows unbounded preceding) - 1 as chain from linked),
chains as (select *, row_number() over (partition by doc_id, chain order by page) - 1 as link from chained)"""


def markdown(cells: str) -> str:
    row = "'| ' || array_to_string(list_transform({0}, lambda c: replace(c, '|', '\\|')), ' | ') || ' |'"
    return f"array_to_string(list_concat([{row.format(cells + '[1]')}, '|' || repeat('---|', len({cells}[1]))], list_transform({cells}[2:], lambda r: {row.format('r')})), chr(10))"


TABLES = f"""
merged as (
  select doc_id, chain, min(page) as first, list(page order by page) as pages, flatten(list(case when link = 0 then cells else cells[2:] end order by page)) as cells from chains group by doc_id, chain),
tables as (
  select *, printf('t%04d_%02d', first, row_number() over (partition by doc_id, first order by chain) - 1) as table_id, {markdown("cells")} as markdown from merged)"""

HEADING = rf"^(#{{1,6}}){WS}+(.*[^\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]){WS}*$"
ROW = r"^[\s\x{85}\p{Z}]*\|.*\|[\s\x{85}\p{Z}]*$"
DELIMITER = r"^[\s\x{85}\p{Z}]*\|([\s\x{85}\p{Z}]*:?-+:?[\s\x{85}\p{Z}]*\|)+[\s\x{85}\p{Z}]*$"
BREAK = r"\r\n|[\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
RESPONSES = r"""
turns as (select * from conversations where conv_id is not null and turn is not null),
responses as (
  select conv_id as doc_id, turn::int as page, case when turn % 3 = 0 then length(coalesce(text, '')) end as text_layer_chars,
    case turn % 4 when 0 then '# ' || coalesce(role, '') || ' one' || chr(10) || coalesce(text, '')
      when 1 then '| a | b\|c |' || chr(10) || '|---|:-:|' || chr(10) || '| ' || coalesce(role, '') || ' | ' || turn || ' |' || chr(10) || chr(10) || coalesce(text, '')
      when 2 then coalesce(text, '') || chr(10) || chr(10) || '## part' || chr(10) || '| lone row |' || chr(10) || '[ILLEGIBLE]' else coalesce(text, '') end as markdown
  from turns
  union all select conv_id, (turn + 1000000)::int, case when turn % 3 = 0 then length(coalesce(text, '')) end, '' from turns where turn % 8 = 3)"""
BLOCKS = rf"""
mdl as (
  select doc_id, page, ln, l[ln] as line from (select doc_id, page, regexp_split_to_array(markdown, '{BREAK}') as l, unnest(range(1, len(regexp_split_to_array(markdown, '{BREAK}')) + 1)) as ln from responses)
  where not (ln = len(l) and l[ln] = '')),
m1 as (
  select *, {strip("line")} = '' as blank, regexp_matches(line, '{HEADING}') as head, regexp_matches(line, '{ROW}') as row,
    coalesce(regexp_matches(lead(line) over (partition by doc_id, page order by ln), '{DELIMITER}'), false) as sep from mdl),
m2 as (select *, sum(case when row then 0 else 1 end) over (partition by doc_id, page order by ln rows unbounded preceding) as run from m1),
m3 as (select *, row and max(case when row and sep and not head then 1 else 0 end) over (partition by doc_id, page, run, row order by ln rows unbounded preceding) = 1 as tab from m2),
m4 as (select *, case when tab then 'table' when blank then 'blank' when head then 'title' else 'text' end as kind from m3),
m5 as (select *, case when kind = 'title' or coalesce(lag(kind) over (partition by doc_id, page order by ln), '') <> kind then 1 else 0 end as new from m4),
m6 as (select *, sum(new) over (partition by doc_id, page order by ln rows unbounded preceding) as island from m5),
m7 as (select doc_id, page, island, kind, string_agg(line, chr(10) order by ln) as raw from m6 where kind <> 'blank' group by all),
blocks as (
  select doc_id, page, (row_number() over (partition by doc_id, page order by island) - 1)::int as block, kind, case when kind = 'title' then length(regexp_extract(raw, '{HEADING}', 1)) end::int as level,
    case when kind = 'title' then regexp_extract(raw, '{HEADING}', 2) else raw end as content from m7)"""
REPEATS = f"""
norm as (select doc_id, page, {collapse("markdown")} as t from responses),
win as (select doc_id, page, substr(t, i, 20) as w from (select doc_id, page, t, unnest(range(1, length(t) - 18)) as i from norm where length(t) > 20)),
worst as (select doc_id, page, max(n) as worst from (select doc_id, page, w, count(*) as n from win group by all) group by all)"""
CHECKED = rf"""
per as (select doc_id, page, sum(case when kind = 'table' then 1 else 0 end) as tables, count(*) as blocks from blocks group by all),
checked as (
  select r.doc_id, r.page, list_filter([
      case when coalesce(w.worst, 0) > 10 then printf('repetition: a run of characters recurs %d times', w.worst) end,
      case when coalesce(text_layer_chars, 0) > 0 then case when length(n.t) < text_layer_chars * 0.3 or length(n.t) > text_layer_chars * 3.0 then printf('length %d against %d in the text layer', length(n.t), text_layer_chars) end
        when text_layer_chars is null and length(n.t) < 200 then printf('inked page, but %d characters', length(n.t)) end,
      case when regexp_matches(r.markdown, '{JUNK}') or regexp_matches(r.markdown, '{MARKS}') then 'mojibake in the response' end,
      case when r.page % 4 in (1, 2) and coalesce(p.tables, 0) = 0 then '1 table regions, no table' end,
      case when coalesce(p.blocks, 0) = 0 then 'empty response' end], lambda x: x is not null) as reasons
  from responses r join norm n using (doc_id, page) left join worst w using (doc_id, page) left join per p using (doc_id, page))"""

WALK = f"""
items as (
  select doc_id, type as kind, page::int as page, y0::double as y0, content, level, storage_key, source, null::varchar as table_id, null::int[] as pages, null::varchar[][] as cells, null::varchar as markdown, 0 as k, seq, '' as t from leveled
  union all select doc_id, 'table', first, 72.0, '', null, null, 'pymupdf', table_id, pages, cells, markdown, 1, 0, table_id from tables),
walk as (select *, row_number() over (partition by doc_id order by page, y0, k, seq, t) - 1 as pos from items)"""
_LAST = ", ".join(f"max(case when kind = 'title' and greatest(1, coalesce(level, 1)) = {k} then {{'p': pos, 'c': content}} end) over w as h{k}" for k in range(1, 7))
_PATH = ", ".join(f"case when h{k}.p > greatest(-1{''.join(f', coalesce(h{j}.p, -1)' for j in range(1, k))}) then h{k}.c end" for k in range(1, 7))
PATHS = f"""
tops as (select *, {_LAST} from walk window w as (partition by doc_id order by pos rows unbounded preceding)),
paths as (select *, list_filter([{_PATH}], lambda x: x is not null) as headings from tops)"""
CRUMB = "case when len(headings) > 0 then '[' || array_to_string(headings, ' > ') || ']' else '' end"
SECTIONS = f"""
s1 as (
  select *, sum(case when kind in ('title', 'table') then 1 else 0 end) over (partition by doc_id order by pos rows unbounded preceding) as section,
    coalesce(min(case when kind in ('title', 'table') then pos end) over (partition by doc_id order by pos rows between 1 following and unbounded following), 2147483647) as emit from paths),
sections as (
  select doc_id, emit, string_agg(content, chr(10) || chr(10) order by pos) as text, array_to_string(list_sort(list(distinct page + 1)), '|') as pages, max_by(source, pos) as source, false as needs_review, max_by(headings, pos) as headings
  from s1 where kind = 'text' group by doc_id, section, emit)"""
EMBED = "case when len(headings) > 0 then {} || chr(10) || chr(10) || {} else {} end"


def _embed(x: str) -> str:
    return EMBED.format(CRUMB, x, x)


#: Characters of a piece: a token is four of them, and a piece has at most 512.
ROOM = 4 * 512 + 3


def _cut_after(x: str) -> str:
    """A mark (U+E000) where a sentence ends: after one blank that follows its end, before what is not blank. Two passes find ends that
    touch; the mark is no blank and no beginning."""
    return rf"regexp_replace({x}, '([.!?][\s\p{{Z}}])([^\s\p{{Z}}\x{{e000}}])', '\1' || chr(57344) || '\2', 'g')"


CHUNKS = f"""
sent as (
  select doc_id, emit, unnest(range(1, len(s) + 1)) as i, unnest(s) as s, length(text) > {ROOM} as long
  from (select *, string_split({_cut_after(_cut_after("text"))}, chr(57344)) as s from sections)),
filled as (
  select doc_id, emit, i, length(s) as open, 0 as p from sent where i = 1 and long
  union all
  select s.doc_id, s.emit, s.i, case when f.open = 0 or f.open + length(s.s) <= {ROOM} then f.open + length(s.s) else length(s.s) end, case when f.open = 0 or f.open + length(s.s) <= {ROOM} then f.p else f.p + 1 end
  from filled f join sent s on s.doc_id = f.doc_id and s.emit = f.emit and s.i = f.i + 1),
joined as (
  select s.doc_id, s.emit, coalesce(f.p, 0) as p, {strip("string_agg(s.s, '' order by s.i)")} as content from sent s left join filled f using (doc_id, emit, i) group by s.doc_id, s.emit, coalesce(f.p, 0)),
piece as (
  select x.*, j.content, row_number() over (partition by x.doc_id, x.emit order by j.p) - 1 as part from sections x join joined j on j.doc_id = x.doc_id and j.emit = x.emit where j.content <> ''),
grp as (
  select p.*, unnest(range(0, greatest(len(cells) - 1, 0), 20)) as a from paths p where kind = 'table'),
rows_ as (select *, list_concat(cells[1:1], cells[a + 2 : a + 21]) as part from grp),
tab as (select *, {markdown("part")} as content_ from rows_),
made as (
  select doc_id, emit, 0 as rank, part, 'text' as type, content, {_embed("content")} as embedding_text, pages, source, {tokens("content")} + case when len(headings) > 0 then {tokens(CRUMB)} else 0 end as token_count, null::varchar as table_id, null::varchar as storage_key
  from piece where content <> ''
  union all select doc_id, pos, 1, 0, 'figure', '', e, (page + 1)::varchar, source, {tokens("e")}, null, storage_key from (select *, {_embed("printf('[figure on page %d]', page + 1)")} as e from paths where kind = 'figure')
  union all select doc_id, pos, 1, a, 'table', content_, e, array_to_string(list_transform(pages, lambda p: p + 1), '|'), 'pymupdf', {tokens("e")}, table_id, null from (select *, {_embed("content_")} as e from tab)),
chunks as (select *, doc_id || printf('_c%04d', row_number() over (partition by doc_id order by emit, rank, part) - 1) as chunk_id, false as needs_review from made)"""

def _with(*parts: str, then: str) -> str:
    return "with recursive " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n" + then


_DOC = (UNITS, levels("units", "leveled"), FRAGMENTS, CHAINS, TABLES, WALK, PATHS)
_BROKEN = """
broken as (
  select doc_id, page, case page % 6 when 0 then cells[1:1] when 1 then list_append(cells, ['x']) when 2 then list_concat([['', '', '']], cells[2:]) when 3 then list_concat(cells[1:1], list_transform(cells[2:], lambda r: ['', '', '']))
    when 4 then list_append(cells, ['a' || chr(1), chr(2367) || chr(2357), 'c']) else cells end as cells from fragments)"""
_DEFECT = f"""
marked as (
  select * replace (content || case (7 * page + seq) % 50 when 3 then chr(1) when 7 then {_codes(" िवभाग")} when 11 then ' [ILLEGIBLE]' else '' end as content) from units),
reasons as (
  select *, case when source = 'pymupdf' and type in ('text', 'title') then case when (7 * page + seq) % 50 = 3 then ['junk characters in native text'] when (7 * page + seq) % 50 = 7 then ['marks without their letter in native text'] else [] end
    when source = 'gemini' then list_concat(case when page % 5 = 3 and page % 2 = 0 then ['page reason'] else [] end, case when (7 * page + seq) % 50 = 11 then ['region marked illegible'] else [] end) else [] end as reasons
  from marked)"""
_OVERLAP = """
  case when least(ax1, bx1) > greatest(ax0, bx0) and least(ay1, by1) > greatest(ay0, by0)
    then (least(ax1, bx1) - greatest(ax0, bx0)) * (least(ay1, by1) - greatest(ay0, by0)) / least((ax1 - ax0) * (ay1 - ay0), (bx1 - bx0) * (by1 - by0)) else 0.0 end"""
BOXES = """
boxes as (
  select l_orderkey as order_key, n::int as line, (l_partkey % 400)::double as ax0, (l_suppkey % 600)::double as ay0, (l_partkey % 400 + 50 + l_suppkey % 90)::double as ax1, (l_suppkey % 600 + 40)::double as ay1,
    (l_partkey % 397)::double as bx0, (l_suppkey % 590)::double as by0, (l_partkey % 397 + 80)::double as bx1, (l_suppkey % 590 + 30 + l_partkey % 50)::double as by1
  from (select l_orderkey, l_partkey, l_suppkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as n from lineitem))"""
SPANS = f"""{DOCS},{LINES},
full_ as (select *, case when i % 5 = 1 then '3.1 ' || line else line end as t, case when i % 7 = 0 then 14.0 else 10.0 end as size from ln),
sp as (select doc_id, page, i, 0 as s, substr(t, 1, 10) as t, 9.0::double as size, 0 as flags from full_ union all select doc_id, page, i, 1, substr(t, 11), size, case when i % 5 = 1 then 16 else 0 end from full_),
sampled as (
  select sp.* from sp join (select doc_id, page, row_number() over (partition by doc_id order by page) - 1 as rn, count(*) over (partition by doc_id) as n from (select distinct doc_id, page from ln)) p using (doc_id, page)
  where rn % greatest(1, n // 60) = 0 and rn // greatest(1, n // 60) < 60),
sized as (select doc_id, round_even(size, 0) as size, sum(length({strip("t")})) as chars, min(page * 1000000 + i * 10 + s) as f from sampled where {strip("t")} <> '' group by all),
body as (select d.doc_id, coalesce(b.size, 10.0)::double as body_size from (select distinct doc_id from ln) d left join (select * from sized qualify row_number() over (partition by doc_id order by chars desc, f) = 1) b using (doc_id)),
dom as (select * from sp where {strip("t")} <> '' qualify row_number() over (partition by doc_id, page, i order by length(t) desc, s) = 1),
lines as (
  select f.doc_id, f.page, f.i, (f.i % 4) // 3 + case when f.page % 3 = 0 then 1 else 0 end as block, {collapse("f.t")} as text, dom.size, dom.size >= body_size * 1.15 or (dom.flags & 16 <> 0 and regexp_matches({collapse("f.t")}, '^\\p{{Nd}}+(\\.\\p{{Nd}}+)*\\.?{WS}+[^\\s]')) as head
  from full_ f join dom using (doc_id, page, i) join body using (doc_id) where {collapse("f.t")} <> ''),
isl as (select *, sum(case when head then 1 else 0 end) over (partition by doc_id, page, block order by i rows unbounded preceding) as island from lines),
made as (
  select doc_id, page, block, i, 'title' as type, text as content, round_even(size, 1)::double as font_size, 72.0 + 14 * (i % 4) as y0, 72.0 + 14 * (i % 4) + 12 as y1 from isl where head
  union all select doc_id, page, block, min(i), 'text', string_agg(text, ' ' order by i), null, min(72.0 + 14 * (i % 4)), max(72.0 + 14 * (i % 4) + 12) from isl where not head group by doc_id, page, block, island
  union all select distinct doc_id, page, 0, -1, 'figure', '', null::double, 100.0, 200.0 from ln where page % 3 = 0)"""

SQL: dict[str, str] = {
    "route_counts": _with(PROFILES, ROUTES, then="select doc_id, extractor, count(*) as pages from routes group by all"),
    "page_profiles": _with(PROFILES, then="select * from profiles"),
    "page_routes": _with(PROFILES, ROUTES, then="select doc_id, page, extractor, array_to_string(reasons, '|') as reasons from routes"),
    "page_routes_first_reason": _with(PROFILES.replace("round_even(coalesce(image, 0) / (595.0 * 842.0)::double, 3)::double as max_image_coverage", "(coalesce(image, 0) / (595.0 * 842.0)::double)::double as max_image_coverage"), ROUTES, then="select doc_id, page, extractor, reasons[1] as reasons from routes"),
    "text_layer_evidence": _with(PROFILES, ROUTES, then="select doc_id, page, case when text_chars >= 50 and max_image_coverage <= 0.70 then text_chars end as text_layer_chars from profiles join routes using (doc_id, page) where extractor = 'vlm'"),
    "text_scores": _with(PAGES, SCORES, then="select doc_id, page, junk, orphans, symbols, case when compact > 0 then junk / compact else 0.0 end as junk_ratio, case when compact > 0 then (orphans + symbols) / compact else 0.0 end as mojibake_ratio from scores"),
    "text_forms": _with(UNITS, then=rf"select doc_id, seq, {NORM} as furniture, case when regexp_extract(content, '^(\p{{Nd}}+(?:\.\p{{Nd}}+)*)\.?{WS}', 1) <> '' then len(regexp_extract_all(regexp_extract(content, '^(\p{{Nd}}+(?:\.\p{{Nd}}+)*)\.?{WS}', 1), '\.')) + 1 end::int as depth, regexp_matches(content, '^\p{{Nd}}+(\.\p{{Nd}}+)*\.?{WS}+[^\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]') as numbered, {tokens('content')} as tokens, substr(content, 1, 120) as excerpt, replace(content, '|', '\|') as escaped, {collapse('content')} as collapsed from units"),
    "page_sample": _with(PAGES, then="select doc_id, page from (select doc_id, page, row_number() over (partition by doc_id order by page) - 1 as rn, count(*) over (partition by doc_id) as n from pages) where rn % greatest(1, n // 60) = 0 and rn // greatest(1, n // 60) < 60"),
    "body_font_size": _with(SPANS, then="select * from body"),
    "native_units": _with(SPANS, then="select doc_id, page, row_number() over (partition by doc_id, page order by block, i) - 1 as seq, type, content, font_size, case when type = 'figure' then printf('figures/p%04d_f%02d.png', page, 0) end as storage_key, y0::double as y0, y1::double as y1 from made"),
    "drawing_units": _with(PROFILES, ROUTES, then="select doc_id, page, printf('figures/p%04d_page.png', page) as storage_key, 595.0::double as x1, 842.0::double as y1 from routes where extractor = 'drawing'"),
    "ruled_grids": """
with d as (
  select l_orderkey % 50 as doc_id, l_orderkey as page, l_suppkey % 2 = 0 as rect, (l_partkey % 20 * 10)::double as x0, l_linenumber * 20.0::double as y0,
    case when l_suppkey % 2 = 0 then l_partkey % 20 * 10 + 100 when l_linenumber % 2 = 0 then l_partkey % 20 * 10 else l_partkey % 20 * 10 + 200 end::double as x1,
    case when l_suppkey % 2 = 0 then l_linenumber * 20.0 + 15 when l_linenumber % 2 = 0 then l_linenumber * 20.0 + 300 else l_linenumber * 20.0 end::double as y1 from lineitem),
s as (
  select doc_id, page, x0, y0, x1, y1 from d where not rect union select doc_id, page, x0, y0, x1, y0 from d where rect union select doc_id, page, x0, y1, x1, y1 from d where rect
  union select doc_id, page, x0, y0, x0, y1 from d where rect union select doc_id, page, x1, y0, x1, y1 from d where rect),
k as (select *, case when y1 - y0 < 1 and x1 - x0 > 5 then 'h' when x1 - x0 < 1 and y1 - y0 > 5 then 'v' end as dir from s)
select doc_id, page::int as page, count(*) filter (dir = 'h') as h_segments, count(*) filter (dir = 'v') as v_segments, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1
from k where dir is not null group by doc_id, page having count(*) filter (dir = 'h') >= 4 and count(*) filter (dir = 'v') >= 4""",
    "markdown_blocks": _with(RESPONSES, BLOCKS, then="select * from blocks"),
    "markdown_table_cells": _with(RESPONSES, BLOCKS, then=rf"""
select doc_id, page, (r - 1)::int as r, (c - 1)::int as c, replace({strip("row[c]")}, chr(1), '|') as cell from (
  select doc_id, page, r, row, unnest(range(1, len(row) + 1)) as c from (
    select doc_id, page, r, string_split(regexp_replace(replace({strip("l[r]")}, '\|', chr(1)), '^\|+|\|+$', '', 'g'), '|') as row from (
      select doc_id, page, l, unnest(range(1, len(l) + 1)) as r from (
        select doc_id, page, list_filter(string_split(content, chr(10)), lambda x: {strip("x")} <> '' and not regexp_matches(x, '{DELIMITER}')) as l from blocks where kind = 'table'))))"""),
    "response_units": _with(RESPONSES, BLOCKS, then="select doc_id, page, block::bigint as seq, kind as type, content, level, case when kind = 'table' and page % 4 in (1, 2) and n = 1 then 100.0 else 0.0 end::double as y0, case when kind = 'table' and page % 4 in (1, 2) and n = 1 then 300.0 else 842.0 end::double as y1 from (select *, sum(case when kind = 'table' then 1 else 0 end) over (partition by doc_id, page) as n from blocks)"),
    "repetition_windows": _with(RESPONSES, REPEATS, then="select doc_id, page, coalesce(worst, 0)::bigint as worst from responses left join worst using (doc_id, page)"),
    "response_verification": _with(RESPONSES, BLOCKS, REPEATS, CHECKED, then="select doc_id, page, array_to_string(reasons, '|') as review_reasons from checked"),
    "flagged_response_units": _with(RESPONSES, BLOCKS, REPEATS, CHECKED, then="select doc_id, page, block::bigint as seq, kind as type, len(reasons) > 0 or contains(content, '[ILLEGIBLE]') or content = '' as needs_review from blocks join checked using (doc_id, page) union all select doc_id, page, 0, 'text', true from checked c where not exists (select 1 from blocks b where b.doc_id = c.doc_id and b.page = c.page)"),
    "cache_hits": "with c as (select conv_id, turn, coalesce(text, '') as t from conversations), k as (select distinct t from c where conv_id % 2 = 0 and turn % 5 <> 4 and t <> '') select conv_id, turn, sha256(t || 'm' || '1') as key, t in (select t from k) as cached from c",
    "furniture_keys": _with(UNITS, FURNITURE, then="select * from furniture"),
    "furniture_stripped_units": _with(UNITS, FURNITURE, STRIPPED, then="select doc_id, seq, type, content from stripped"),
    "units_outside_tables": _with(UNITS, then="select doc_id, seq, type from units where not (type in ('text', 'title') and source <> 'gemini' and page % 3 = 0 and (y0 + y1) / 2 between 200 and 400)"),
    "heading_levels": _with(UNITS, levels("units", "leveled"), then="select doc_id, seq, content, level from leveled where type = 'title'"),
    "figure_dedup": _with(UNITS, then="""
, d as (select doc_id, storage_key, min(seq) % 10 as digest from units where type = 'figure' and (page + seq) % 4 <> 0 group by all)
select doc_id, seq, type from (select u.doc_id, seq, page, type, digest, row_number() over (partition by u.doc_id, digest order by page, seq) as n from units u left join d using (doc_id, storage_key)) where type <> 'figure' or digest is null or n = 1""".strip()).replace(")\n, d as", "),\nd as"),
    "pixel_boxes_to_points": _with(BOXES, then="""
, t as (
  select order_key, line, greatest(10.0, 10 + greatest(0.0, ax0 - 10) * (295.0 / 1000.0)::double) as x0, greatest(20.0, 20 + greatest(0.0, ay0 - 10) * (421.0 / 2000.0)::double) as y0,
    least(305.0, 10 + least(1000.0, ax1 + 10) * (295.0 / 1000.0)::double) as x1, least(441.0, 20 + least(2000.0, ay1 + 10) * (421.0 / 2000.0)::double) as y1,
    greatest(0.0, bx0 * (595.0::double / 300.0)) as qx0, greatest(0.0, by0 * (842.0::double / 400.0)) as qy0, least(595.0, bx1 * (595.0::double / 300.0)) as qx1, least(842.0, by1 * (842.0::double / 400.0)) as qy1 from boxes)
select order_key, line, case when x0 < x1 and y0 < y1 then x0 end::double as x0, case when x0 < x1 and y0 < y1 then y0 end::double as y0, case when x0 < x1 and y0 < y1 then x1 end::double as x1, case when x0 < x1 and y0 < y1 then y1 end::double as y1,
  case when qx0 < qx1 and qy0 < qy1 then qx0 end::double as qx0, case when qx0 < qx1 and qy0 < qy1 then qy1 end::double as qy1 from t""".strip()).replace(")\n, t as", "),\nt as"),
    "region_overlap": _with(BOXES, then=f"select order_key, line, {_OVERLAP}::double as overlap, (ax0 + ax1) / 2 between bx0 and bx1 and (ay0 + ay1) / 2 between by0 and by1 as inside, ay0 <= 842.0 * 0.2 or ay1 >= 842.0 * 0.8 as band, by0 <= 1 and by1 >= 841 as \"full\", round_even(ay0 / 8, 0)::bigint as bucket, ax1 - ax0 as width, by1 - by0 as height from boxes"),
    "suppressed_suspects": _with(BOXES, then="""
, r as (
  select (order_key % 40)::varchar as doc_id, (order_key // 40)::int as page, line as seq, round_even(floor(ax0 / 80) * 8, 0) as k0, round_even(floor(ay0 / 90) * 9, 0) as k1, case when (order_key // 40) % 4 = 0 then 'find_tables' else 'yolo_only' end as source from boxes),
f as (select doc_id, k0, k1 from r where source = 'yolo_only' group by all having count(distinct page) >= 3)
select doc_id, page, seq, source from r where not (source = 'yolo_only' and exists (select 1 from f where f.doc_id = r.doc_id and f.k0 = r.k0 and f.k1 = r.k1))""".strip()).replace(")\n, r as", "),\nr as"),
    "borderless_suspects": _with(BOXES, f"""
g as (select (order_key % 40)::varchar as doc_id, (order_key // 40)::int as page, line, ax0, ay0, ax1, ay1, bx0, by0, bx1, by1 from boxes),
free as (
  select a.doc_id, a.page, a.line, {{'line': a.line, 'x0': a.ax0, 'y0': a.ay0, 'x1': a.ax1, 'y1': a.ay1}} as box, row_number() over (partition by a.doc_id, a.page order by a.line) as n from g a where not exists (
    select 1 from (select doc_id as d, page as p, bx0, by0, bx1, by1 from g where line = 1) f where f.d = a.doc_id and f.p = a.page and {_OVERLAP.replace("bx", "f.bx").replace("by", "f.by").replace("ax", "a.ax").replace("ay", "a.ay")} > 0.3)),
taken as (
  select doc_id, page, n, [box] as boxes from free where n = 1
  union all select f.doc_id, f.page, f.n, case when len(list_filter(t.boxes, lambda b: {_OVERLAP.replace("bx", "b.x").replace("by", "b.y").replace("ax", "f.box.x").replace("ay", "f.box.y")} > 0.3)) > 0 then t.boxes else list_append(t.boxes, f.box) end
  from taken t join free f on f.doc_id = t.doc_id and f.page = t.page and f.n = t.n + 1)""",
        then="select doc_id, page, b.line::bigint as seq, b.x0 as x0, b.y0 as y0, b.x1 as x1, b.y1 as y1 from (select doc_id, page, unnest(boxes) as b from taken qualify row_number() over (partition by doc_id, page order by n desc) = 1)"),
    "table_chains": _with(FRAGMENTS, CHAINS, then="select doc_id, page, 0::bigint as seq, chain::int as chain, link::int as link from chains"),
    "table_ids": _with(FRAGMENTS, CHAINS, then="select doc_id, chain::int as chain, printf('t%04d_%02d', first, row_number() over (partition by doc_id, first order by chain) - 1) as table_id, pages, fragments from (select doc_id, chain, min(page) as first, array_to_string(list(page order by page), '|') as pages, count(*) as fragments from chains group by doc_id, chain)"),
    "stitched_tables": _with(FRAGMENTS, CHAINS, TABLES, then="select doc_id, table_id, array_to_string(pages, '|') as pages, len(cells)::int as row_count, 3 as col_count, markdown, 'find_tables' as source, 1 as header_rows from tables"),
    "table_grid": _with(FRAGMENTS, CHAINS, TABLES, """
gl as (select doc_id, table_id, unnest(cells) as row, unnest(range(0, len(cells))) as i from tables),
gw as (select doc_id, table_id, greatest(3, max(length(row[1]))) as a, greatest(3, max(length(row[2]))) as b, greatest(3, max(length(row[3]))) as c from gl group by all),
gr as (select *, '+' || repeat('-', a + 2) || '+' || repeat('-', b + 2) || '+' || repeat('-', c + 2) || '+' as rule from gw)""",
        then="select doc_id, table_id, any_value(rule) || chr(10) || string_agg('| ' || rpad(row[1], a::int, ' ') || ' | ' || rpad(row[2], b::int, ' ') || ' | ' || rpad(row[3], c::int, ' ') || ' |' || chr(10) || rule, chr(10) order by i) as grid from gl join gr using (doc_id, table_id) group by doc_id, table_id"),
    "stitched_spans": _with(SPANNED, """
sj as (select w.doc_id, w.chain, string_agg(case when w.r = 0 then 'segment,name,key' else w.w || ',' || s.c_name || ',' || s.c_custkey end, ';' order by w.r) as cells from walked w join sr s using (doc_id, chain, r) group by w.doc_id, w.chain),
sn as (select doc_id, chain, string_agg(m, ';' order by page, i) as merges from sm group by doc_id, chain)""",
        then="select doc_id, printf('t%04d_%02d', 4 * chain, 0) as table_id, cells, merges from sj join sn using (doc_id, chain)"),
    "table_markdown": _with(FRAGMENTS, then=f"select doc_id, page, {markdown('cells')} as markdown from fragments"),
    "table_validation": _with(FRAGMENTS, _BROKEN, then=f"""
select doc_id, page, case when len(cells) < 2 then 'fewer than 2 rows'
    when len(list_distinct(list_transform(cells, lambda r: len(r)))) <> 1 then 'ragged rows: ' || array_to_string(list_sort(list_distinct(list_transform(cells, lambda r: len(r)))), ', ')
    when len(list_filter(cells[1], lambda c: c <> '')) = 0 then 'empty header row'
    when len(list_filter(flatten(cells), lambda c: c <> '')) < 0.4 * len(flatten(cells)) then 'mostly empty cells' end as reason, case when page % 6 = 4 then 2 else 0 end as junk_cells from broken"""),
    "unmerged_cells": "select s_suppkey::varchar as doc_id, 1 as header_rows, 'H' || s_suppkey || ',H' || s_suppkey || ',Z;a,b,c;' || s_name || ',1,2;' || s_name || ',3,' as cells, '0-0-1-2;2-0-2-1' as merges from supplier",
    "unit_review_reasons": _with(UNITS, _DEFECT, then="select doc_id, seq, type, array_to_string(reasons, '|') as reasons from reasons where len(reasons) > 0"),
    "walk_order": _with(UNITS, "leveled as (select * from units)", FRAGMENTS, CHAINS, TABLES, WALK, then="select doc_id, pos::int as pos, kind, page, content, table_id from walk"),
    "heading_paths": _with(*_DOC, then=f"select doc_id, pos::int as pos, kind, {CRUMB} as crumb from paths"),
    "section_text": _with(*_DOC, SECTIONS, then=f"select doc_id, emit::int as emit, text, pages, source, needs_review, {CRUMB} as crumb from sections"),
    "all_chunks": _with(*_DOC, SECTIONS, CHUNKS, then="select chunk_id, type, content, embedding_text, pages, source, needs_review, token_count::int as token_count, table_id, storage_key from chunks"),
    "text_pieces": _with(*_DOC, SECTIONS, CHUNKS, then="select chunk_id, content, embedding_text, token_count::int as token_count from chunks where type = 'text'"),
    "table_row_groups": _with(*_DOC, SECTIONS, CHUNKS, then="select doc_id, table_id, content, pages, token_count::int as token_count from chunks where type = 'table'"),
    "merged_markdown": _with(*_DOC, then="select doc_id, string_agg(case kind when 'title' then chr(10) || repeat('#', greatest(1, coalesce(level, 1))) || ' ' || content || chr(10) when 'text' then content || chr(10) when 'figure' then chr(10) || '![figure](' || storage_key || ')' || chr(10) else chr(10) || markdown || chr(10) end, '' order by pos) as markdown from paths group by doc_id"),
}

# --- twins of composed queries ---------------------------------------------------------------------------------------

ITEMS = """
ritems as (
  select doc_id, (row_number() over (partition by doc_id order by page, seq) - 1)::int as item, page, type as kind, array_to_string(reasons, '; ') as reason, substr(content, 1, 120) as excerpt, null::varchar as crop_key
  from reasons where len(reasons) > 0)"""
SQL["review_items"] = _with(UNITS, _DEFECT, ITEMS, then="select * from ritems")
SQL["review_report"] = _with(
    UNITS, _DEFECT, ITEMS,
    """
rline as (select *, chr(10) || '- **' || kind || '** — ' || reason || case when excerpt <> '' then chr(10) || '  - excerpt: `' || excerpt || '`' else '' end as line from ritems),
rpage as (select doc_id, page, count(*) as n, chr(10) || '## Page ' || (page + 1) || chr(10) || string_agg(line, chr(10) order by item) as t from rline group by doc_id, page),
rdoc as (select doc_id, sum(n)::bigint as n, string_agg(t, chr(10) order by page) as t from rpage group by doc_id)""",
    then="""
select d.doc_id, '# Review report — ' || d.doc_id || chr(10) || chr(10) || coalesce(n || ' item(s) need human eyes, grouped by page.' || chr(10) || t || chr(10), 'Nothing flagged. Every extracted item passed its validator.' || chr(10)) as report
from (select distinct doc_id from units) d left join rdoc using (doc_id)""".strip(),
)


def _side(units: str, mark: str) -> str:
    """The chunk CTEs over `units`, under names of their own."""
    names = "items|walk|tops|paths|s1|sections|sent|filled|joined|piece|grp|rows_|tab|made|chunks|leveled"
    parts = [f"leveled as (select * from {units})", WALK, PATHS, SECTIONS, CHUNKS]
    return re.sub(rf"\b({names})\b", rf"\1_{mark}", ",\n".join(p.strip() for p in parts))


_SIG = "select doc_id, type, " + collapse("content") + " as content, pages, needs_review from chunks_"
SQL["chunk_diff"] = _with(
    UNITS, FURNITURE, STRIPPED, FRAGMENTS, CHAINS, TABLES, levels("units", "lev_a"), levels("stripped", "lev_b"), _side("lev_a", "a"), _side("lev_b", "b"),
    then=f"""
select side, doc_id, type, content, pages, needs_review, count(*) as n from (
  select 'a' as side, * from ({_SIG}a except all {_SIG}b) union all select 'b', * from ({_SIG}b except all {_SIG}a)) group by all""".strip(),
)
SQL["manifest"] = _with(
    PROFILES, ROUTES, UNITS.replace(DOCS + ",", ""), *_DOC[1:], SECTIONS, CHUNKS, _DEFECT,
    """
mr as (
  select doc_id, count(*) as page_count, string_agg(page || ':' || extractor, '|' order by page) as page_routes, count(*) filter (extractor = 'native') as pages_native, count(*) filter (extractor = 'vlm') as pages_vlm, count(*) filter (extractor = 'drawing') as pages_drawing from routes group by doc_id),
mu as (select doc_id, count(*) filter (type = 'title') as units_title, count(*) filter (type = 'text') as units_text, count(*) filter (type = 'table') as units_table, count(*) filter (type = 'figure') as units_figure from units group by doc_id),
mv as (
  select doc_id, count(*) as vlm_pages, count(*) filter (page % 10 = 3) as vlm_cached, sum(case when page % 10 <> 3 then 100 else 0 end)::bigint as input_tokens, sum(case when page % 10 <> 3 then page % 7 else 0 end)::bigint as output_tokens
  from (select distinct doc_id, page from units where page % 5 = 3) group by doc_id),
mc as (select doc_id, count(*) as chunks from chunks group by doc_id),
mi as (select doc_id, count(*) as review_items from reasons where len(reasons) > 0 group by doc_id)""",
    then="""
select doc_id, 'ok' as status, page_count, pages_native, pages_vlm, pages_drawing, coalesce(units_title, 0) as units_title, coalesce(units_text, 0) as units_text, coalesce(units_table, 0) as units_table, coalesce(units_figure, 0) as units_figure,
  coalesce(vlm_pages, 0) as vlm_pages, coalesce(vlm_cached, 0) as vlm_cached, coalesce(input_tokens, 0) as input_tokens, coalesce(output_tokens, 0) as output_tokens, 0::bigint as tables, coalesce(chunks, 0) as chunks, coalesce(review_items, 0) as review_items,
  page_routes, '' as multi_page, '' as tables_review, '' as chunks_review
from mr left join mu using (doc_id) left join mv using (doc_id) left join mc using (doc_id) left join mi using (doc_id)""".strip(),
)
