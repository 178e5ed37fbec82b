"""DuckDB SQL for the results of the queries that SQL can state."""

from __future__ import annotations

from tillstream.llm.chat import CONTROL, END, SAYS, TURN

WORD = r"[^\x20\x09-\x0D]+"


def _escaped(text: str) -> str:
    out = rf"replace({text}, '\', '\\')"
    for mark in CONTROL:
        out = rf"replace({out}, '{mark}', '{mark[0]}\{mark[1:]}')"
    return out


def chat_prefix_targets() -> str:
    """Per conversation; an example's length is that of all turns up to its end."""
    frame = len(TURN + SAYS + END)
    return f"""
with told as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values
    (-7::bigint, 0::bigint, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), shown as (
  select *, length({_escaped("role")}) + length({_escaped("text")}) + {frame} as chars,
    row_number() over w as place, count(*) over (partition by conv_id) as n
  from told window w as (partition by conv_id order by turn nulls first, role, text)
), summed as (
  select *, sum(chars) over (partition by conv_id order by place) as prefix from shown
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(case when role = 'assistant' or place = n then prefix else 0 end) as bigint) as formatted_chars,
  count(*) filter (role = 'assistant' or place = n) as n_examples
from summed group by conv_id
"""


WARC = """
with told as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), keepers as (
  select payload_digest, max(page_id) as keeper from told where payload_bytes >= 1000 group by payload_digest
)
select t.page_id, t.payload_bytes, t.payload_digest,
  case when k.keeper <> t.page_id then 'revisit' else 'response' end as record_type,
  case when k.keeper <> t.page_id then k.keeper end as refers_to
from told t left join keepers k on k.payload_digest = t.payload_digest and t.payload_bytes >= 1000
"""

SIMILAR = f"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
  from documents
), shingles as (
  select distinct doc_id, list_slice(w, i, i + 4) as s
  from words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), reached as (
  select doc_id, doc_id as root from documents
  union
  select r.doc_id, l.b from reached r join links l on l.a = r.root
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, m.root as component_id
from documents d left join sizes s using (doc_id)
join (select doc_id, min(root) as root from reached group by doc_id) m using (doc_id)
"""

REPEATS = """
with bytes as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), windows as (
  select doc_id, i, md5(substr(h, 2 * i + 1, 400)) as digest from bytes, unnest(range(n - 199)) as t(i)
), again as (
  select doc_id, i from windows where digest in (select digest from windows group by digest having count(*) > 1)
), starts as (
  select doc_id, i, lag(i) over w as before from again window w as (partition by doc_id order by i)
), spans as (
  select doc_id, min(i) as a, max(i) + 200 as b from (
    select *, sum(case when before is null or i > before + 200 then 1 else 0 end) over (partition by doc_id order by i) as span from starts
  ) group by doc_id, span
), gaps as (
  select b.doc_id, b.h, b.n, coalesce(s.a, b.n) as a, coalesce(s.b, b.n) as b,
    coalesce(lag(s.b) over w, 0) as kept_from, lead(s.a) over w is null as last, s.a is not null as cut
  from bytes b left join spans s using (doc_id) window w as (partition by b.doc_id order by s.a)
)
select doc_id, any_value(n) as n_bytes, cast(sum(case when cut then b - a else 0 end) as bigint) as n_removed,
  cast(count(*) filter (cut) as bigint) as n_spans,
  sha256(from_hex(string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) ||
    case when last then substr(h, 2 * b + 1) else '' end, '' order by a))) as kept_sha256
from gaps group by doc_id
"""

CRC = """crc_table as (
  select list(v order by i) as crcs from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as v
    from range(256) as t(i)
  )
)"""


def crc32(text: str) -> str:
    """CRC-32 of a text in ASCII, where crc_table is in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    step = "xor(c >> 8, crcs[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: {step}), 4294967295)"


def repaired() -> str:
    """Turns from the last to the first.  A way to the end is its cost in ten digits and its
    letters, so the least string is the cheapest way, and of those the first in ASCII."""

    def way(old: str, cost: str, letter: str) -> str:
        return f"(lpad((substr({old}, 1, 10)::bigint + {cost})::varchar, 10, '0') || '{letter}' || substr({old}, 11))"

    follows = (2, 2, 3, 2)
    base = []
    for q in range(4):
        n = follows[q]
        fits = "initial = 'a'" if q == 2 else "initial = 'u'"
        keep = f"case when {fits} then {way(f'f{n}', 'cut', 'K')}"
        keep += f" when initial = 's' then {way('f1', 'cut', 'K')} end" if q == 0 else " end"
        free = f"least(coalesce({keep}, '9'), {way(f'f{n}', '2 + cut', 'R')})"
        base.append(f"least({way(f'f{q}', '3', 'D')}, case when gone then '9' else {free} end) as b{q}")
    best = []
    for q in range(4):
        n = follows[q]
        best.append(f"least(b{q}, {way(f'b{n}', '2', 'I')}, {way(f'b{follows[n]}', '4', 'II')})")
    return f"""
with recursive {CRC}, told as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations
), kinds as (
  select * exclude (crcs), {crc32("name")} % 20 as kind from told, crc_table
), damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from kinds, range(case kind when 0 then 0 when 3 then 2 else 1 end)
), digests as (
  select *, sha256(length(role)::varchar || ':' || role || text) as digest, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
  from damaged
), ordered as (
  select *, left(role, 1) as initial, row_number() over (partition by conv_id order by turn nulls first, role, digest) as k
  from digests
), seen as (
  select *, row_number() over (partition by conv_id, digest order by k) > 1 as known from ordered
), faults as (
  select *, case when body = '' then 'b' when known then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '' end as fault
  from seen
), turns as (
  select *, fault in ('b', 'd') as gone, (fault = 't')::int as cut,
    lag(initial) over (partition by conv_id order by k) || initial not in ('su', 'ua', 'au') as wrong
  from faults
), sums as (
  select conv_id, max(k) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank,
    count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated, count(*) filter (wrong) as illegal
  from turns group by conv_id
), ways as (
  select conv_id, n + 1 as k, '0000000000' as f0, '0000000004II' as f1, '0000000002I' as f2, '0000000000' as f3 from sums
  union all
  select conv_id, k, {", ".join(best)} from (
    select t.conv_id, t.k, {", ".join(base)} from ways w join turns t on t.conv_id is not distinct from w.conv_id and t.k = w.k - 1
  )
), audits as (
  select conv_id, substr(f0, 1, 10)::bigint as cost, substr(f0, 11) as audit from ways where k = 1
), letters as (
  select conv_id, p, audit[p] as letter from audits, unnest(range(1, length(audit) + 1)) as u(p)
), placed as (
  select *, count(*) filter (letter <> 'I') over w as k, count(*) filter (letter <> 'D') over w as e
  from letters window w as (partition by conv_id order by p)
), joined as (
  select a.conv_id, a.p, a.letter, a.e, t.role, t.text, t.initial
  from placed a left join turns t on a.letter <> 'I' and t.conv_id is not distinct from a.conv_id and t.k = a.k where a.letter <> 'D'
), roles as (
  select *, e - max(case when e = 1 and letter = 'K' and initial = 's' then 1 else 0 end) over (partition by conv_id) as place from joined
), lines as (
  select conv_id, sha256(string_agg(
    case when letter = 'K' then role when place % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''), chr(10) order by p)) as hash
  from roles group by conv_id
)
select c.conv_id, coalesce(s.gaps, 0)::bigint as gaps, coalesce(s.blank, 0) as blank, coalesce(s.duplicate, 0) as duplicate,
  coalesce(s.truncated, 0) as truncated, coalesce(s.illegal, 0) as illegal, coalesce(a.cost, 0) as cost,
  coalesce(a.audit, '') as audit, coalesce(l.hash, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join sums s on s.conv_id is not distinct from c.conv_id
left join audits a on a.conv_id is not distinct from c.conv_id
left join lines l on l.conv_id is not distinct from c.conv_id
"""


def trie() -> str:
    """Each conversation gives a row for each of its prefixes; a node's subtree is found by the prefixes of its smallest member."""
    return f"""
with recursive {CRC}, told as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null
), digests as (
  select *, sha256(length(role)::varchar || ':' || role || text) as digest from told
), own as (
  select conv_id, list({{'d': digest, 's': length(text)}} order by turn nulls first, role, digest) as turns from digests group by conv_id
), hashed as (
  select conv_id, turns, {crc32("conv_id::varchar")} % 6 as h, conv_id - ((conv_id % 100) + 100) % 100 as base from own, crc_table
), rebuilt as (
  select c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, length(c.turns))) as turns
  from hashed c left join own b on b.conv_id = c.base
), prefixes as (
  select conv_id, d, length(turns) = d as ends, coalesce(turns[d].s, 0) as size,
    sha256(array_to_string(list_transform(list_slice(turns, 1, d), lambda t: t.d), ',')) as name,
    sha256(array_to_string(list_transform(list_slice(turns, 1, d - 1), lambda t: t.d), ',')) as above
  from rebuilt, unnest(range(length(turns) + 1)) as u(d)
), nodes as (
  select d, name, min(conv_id) as conv_id, case when d > 0 then any_value(above) end as above, count(*) as n, any_value(size) as size,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '') as ids
  from prefixes group by d, name
), children as (
  select d - 1 as d, above as name, count(*) as n from nodes where d > 0 group by all
), rated as (
  select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c using (d, name)
), subtrees as (
  select p.d, p.name, count(*) filter (r.n_children = 0) as n_leaves, cast(sum((r.n - 1) * r.size) as bigint) as saved_tokens
  from rated r join prefixes p on p.conv_id = r.conv_id and p.d <= r.d group by all
)
select r.conv_id, r.d as depth, a.conv_id as parent_conv_id, r.n as n_convs, r.n_children, s.n_leaves, s.saved_tokens, sha256(r.ids) as ends_sha256
from rated r join subtrees s using (d, name) left join nodes a on a.d = r.d - 1 and a.name = r.above
"""
