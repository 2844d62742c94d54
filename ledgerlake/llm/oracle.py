"""DuckDB SQL for the queries of this subpackage that SQL can express, written from the contracts alone.

Quadratic by nature (all pairs, all windows): for small tables, to compare with.
"""

from __future__ import annotations

NEAR_DUPLICATES = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x : x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x : x <> 0)) > 0
),
l as (
  select a.vec_id as x, b.vec_id as y from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9
),
r(x, c) as (select vec_id, vec_id from embeddings union select r.x, l.y from r join l on r.c = l.x),
m as (select x, min(c) as component_id from r group by x),
n as (select x, count(*) as n_links from l group by x)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, m.component_id, e.vec_id = m.component_id as kept
from embeddings e join m on m.x = e.vec_id left join n on n.x = e.vec_id
"""

SUBSTRING_DEDUP = r"""
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from t),
s as (
  select doc_id, i, w[i] as word,
    case when i + 19 <= len(w) then array_to_string(w[i:i + 19], ' ') end as win from p
),
d as (
  select doc_id, i, word, win is not null and row_number() over (partition by win order by doc_id, i) > 1 as again from s
),
c as (
  select *, max(again::int) over (partition by doc_id order by i rows between 19 preceding and current row) = 1 as gone from d
)
select t.doc_id, len(t.w)::bigint as n_words, count(*) filter (where c.gone) as n_removed,
  sha256(coalesce(string_agg(c.word, ' ' order by c.i) filter (where not c.gone), '')) as kept_sha256
from t left join c on c.doc_id = t.doc_id group by t.doc_id, len(t.w)
"""

LINE_DEDUP = r"""
with t as (select doc_id, string_split(coalesce(text, ''), chr(10)) as rows_ from documents),
l as (select doc_id, unnest(rows_) as line, unnest(range(len(rows_))) as pos from t),
n as (select *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words from l),
p as (select *, lead(line) over (partition by doc_id order by pos) as then_ from n where words > 0),
f as (
  select *, row_number() over (partition by line order by doc_id, pos) > 1 as line_again,
    then_ is not null and row_number() over (partition by line, then_ order by doc_id, pos) > 1 as pair_again from p
),
d as (
  select doc_id, pos, (line_again and words >= 5) or pair_again
    or coalesce(lag(pair_again) over (partition by doc_id order by pos), false) as gone from f
),
k as (select l.doc_id, l.pos, l.line, d.gone from l left join d on l.doc_id = d.doc_id and l.pos = d.pos)
select doc_id, count(gone) as n_lines, count(*) filter (where gone) as n_removed,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where gone is null or not gone), '')) as kept_sha256
from k group by doc_id
"""

CHAT_FORMAT = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
f as (
  select *, 8 + length(role) + 1 + length(text) + 8 + len(regexp_extract_all(role || ' ' || text, '\\|<[|]turn[|]>|<[|]end[|]>|<[|]image|<[|]audio|<[|]document|<[|]im_start[|]>|<[|]im_end[|]>|<[|]endoftext[|]>|<[|]eot_id[|]>|<[|]start_header_id[|]>|<[|]end_header_id[|]>|<[|]begin_of_text[|]>|<[|]end_of_text[|]>|<[|]startoftext[|]>|<s>|</s>|<pad>|<unk>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<start_of_turn>|<end_of_turn>')) as formatted from c
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(formatted)::bigint as formatted_chars, 0::bigint as extra_tokens
from f group by conv_id
"""

TOP_K = """
with v as (
  select vec_id, list_transform(embedding::double[], lambda x : floor(256 * x)) as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x : x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 5
"""

RUNS = r"""
with h as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x : ascii(x)::bigint)),
      lambda c, b : list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda v, z : xor(v >> 1, 3988292384 * (v & 1))))) as h
  from documents
),
g as (select *, len(w) as n, h // 10 as g from h),
a as (select *, case when h % 10 = 0 and n > 0 then g % n end as a from g),
d as (
  select doc_id, n, case when a is null then w else
    list_transform(range(n), lambda i : w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) end as w from a
),
s as (select doc_id, n, unnest(range(1, n - 14)) as i, w from d where n >= 24),
t as (select doc_id, n, i, array_to_string(w[i:i + 15], ' ') as gram from s),
p as (select x.doc_id, y.i - x.i as q, x.i from t x join t y on x.doc_id = y.doc_id and x.gram = y.gram and x.i < y.i where 3 * (y.i - x.i) <= x.n),
e as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from p),
m as (select doc_id, q, min(i) - 1 as start, count(*) + 15 + q as length from e group by doc_id, q, island),
r as (select doc_id, start, length, min(q) as period from m where length >= greatest(24, 3 * q) group by doc_id, start, length),
o as (select doc_id, unnest(range(start + period, start + length)) as i from r),
u as (select distinct doc_id, i from o),
x as (
  select doc_id, count(*) as n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256,
    list({'start': start, 'length': length, 'period': period} order by length::double / period desc, start, period)[1] as top from r group by doc_id
),
v as (select doc_id, unnest(w) as word, unnest(range(n)) as i from d),
k as (select v.doc_id, string_agg(v.word, ' ' order by v.i) as text from v left join u on u.doc_id = v.doc_id and u.i = v.i where u.i is null group by v.doc_id)
select d.doc_id, coalesce(x.n_runs, 0)::bigint as n_runs, top.start::bigint as start, top.length::bigint as length, top.period::bigint as period,
  (1000 * top.length // top.period)::bigint as exponent_milli, coalesce(x.runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from d left join x on x.doc_id = d.doc_id left join k on k.doc_id = d.doc_id
"""

ORACLE_SQL = {
    "op1_embedding_near_dedup": NEAR_DUPLICATES,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op7_line_dedup": LINE_DEDUP,
    "op8_chat_format": CHAT_FORMAT,
    "op9_exact_top_k": TOP_K,
    "op11_periodic_runs": RUNS,
}
