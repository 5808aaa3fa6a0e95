"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: SHA-1 as base 32: five hexadecimal digits are four characters.
OP3 = f"""
with h as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex, max(page_id) over (partition by coalesce(html, '')) as newest from pages),
d as (select *, [cast('0x' || substr(hex, i * 5 + 1, 5) as bigint) for i in range(8)] as parts from h)
select page_id, octet_length(encode(html)) as payload_bytes,
  array_to_string([substr('{_BASE32}', (v >> 15) % 32 + 1, 1) || substr('{_BASE32}', (v >> 10) % 32 + 1, 1) || substr('{_BASE32}', (v >> 5) % 32 + 1, 1) || substr('{_BASE32}', v % 32 + 1, 1) for v in parts], '') as payload_digest,
  case when newest > page_id then 'revisit' else 'response' end as record_type, case when newest > page_id then newest end as refers_to
from d
"""

OP4 = f"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) as ws from documents),
places as (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w where len(ws) >= 35),
win as (select doc_id, i, array_to_string(ws[i:i + 34], ' ') as s from places),
dup as (select s from win group by s having count(*) > 1),
gone as (select distinct doc_id, i + k as p from win join dup using (s) cross join (select unnest(range(0, 35)) as k)),
word as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from w),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by p) as text from word anti join gone using (doc_id, p) group by doc_id)
select w.doc_id, len(w.ws) as n_words, len(w.ws) - coalesce(kept.n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256 from w left join kept using (doc_id)
"""

OP5 = f"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORDS}) as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as s from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as both_ from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * both_ >= 85 * (x.n + y.n - both_)),
reach as (select doc_id as a, doc_id as b from w union select reach.a, links.b from reach join links on links.a = reach.b)
select w.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id from w left join n using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by 1) c using (doc_id)
"""

OP6 = """
with u as (select row_number() over () as r, vec_id, embedding from embeddings),
v as (select r, vec_id, [floor(256 * cast(x as double)) for x in embedding] as q from u
  where vec_id is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
p as (select a.r, a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score from v a join v b on a.vec_id % 50 = 0 and a.r <> b.r and len(a.q) = len(b.q)),
k as (select *, row_number() over (partition by r order by score desc, vec_id) as rank from p)
select query_id, cast(rank as integer) as rank, vec_id, score from k where rank <= 5
"""

OP8 = f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) as size, cast('0x' || substr(md5('0:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15) as bigint) as key from documents),
t as (select source, cast(sum(size) as bigint) as s, row_number() over (order by source nulls last) - 1 as turn from d group by source),
b as (select *, [5.0, 2.0, 1.0][turn % 3 + 1]::double as w, s * 2.0::double as bound from t),
r as (select *, bound / w as ratio, sum(s) over () * 1.5::double as total,
  coalesce(sum(bound) over (order by bound / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as done,
  sum(w) over () - coalesce(sum(w) over (order by bound / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as rest from b),
l as (select *, (total - done) / rest as level from r),
m as (select source, s, least(bound, coalesce((select level from l where ratio > level order by ratio limit 1) * w, bound)) as target from l),
p as (select doc_id, size, s as source_size, target, case when s > 0 then cast(floor(target / s) as bigint) else 0 end as epochs,
  coalesce(sum(size) over (partition by d.source order by key, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0) as before
  from d join m on d.source is not distinct from m.source)
select doc_id, size, source_size, target, cast(epochs * size + greatest(0, least(size, cast(round(target - epochs * source_size) as bigint) - before)) as bigint) as taken from p
"""

ORACLES = {"op3_warc": OP3, "op4_substring_dedup": OP4, "op5_jaccard_join": OP5, "op6_topk": OP6, "op8_mixing": OP8}
