"""SQL for the queries of this package that SQL can express on whole tables."""

from __future__ import annotations

LINES_SQL = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as place
  from documents),
k as (
  select doc_id, place, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
r as (
  select key, min(doc_id) as first from k where length(key) >= 10 group by key having count(distinct doc_id) > 1)
select k.doc_id,
       count(*) as n_lines,
       count(*) filter (r.first is not null and r.first <> k.doc_id) as n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) order by k.place) filter (r.first is null or r.first = k.doc_id), '')) as kept_sha256
from k left join r on k.key = r.key
group by k.doc_id
"""

MIX_SQL = r"""
with recursive rows_ as (
  select doc_id, source, cast(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as bigint) as n_tokens from documents),
docs as (select * from rows_ where n_tokens > 0),
src as (select source, sum(n_tokens)::bigint as tokens, count(*) as n_docs from docs group by source),
tot as (select sum(tokens)::double as total, count(*) as n from src),
share as (select s.*, tokens / total as share, total, n from src s, tot),
ent(step, a, width) as (
  select 0, 0.0::double, 1.0::double
  union all
  select step + 1,
         case when (select -sum(w * ln(w)) >= 0.95::double * ln(any_value(n)::double)
                    from (select pow(share, e.a + e.width / 2) / sum(pow(share, e.a + e.width / 2)) over () as w, n from share)) then a + width / 2 else a end,
         width / 2
  from ent e where step < 40),
rep(step, a, width) as (
  select 0, 0.0::double, 1.0::double
  union all
  select step + 1,
         case when (select max(w * total / (share * total)) > 4.0
                    from (select pow(share, e.a + e.width / 2) / sum(pow(share, e.a + e.width / 2)) over () as w, share, total from share)) then a + width / 2 else a end,
         width / 2
  from rep e where step < 40),
alpha as (
  select greatest(
    case when (select -sum(share * ln(share)) >= 0.95::double * ln(any_value(n)::double) from share) then 1.0 else (select a from ent where step = 40) end,
    case when (select max(1.0::double) > 4.0 from share) then 1.0 else (select a from rep where step = 40) end) as a),
w as (
  select source, tokens, n_docs, total, pow(share, a) / sum(pow(share, a)) over () as weight from share, alpha),
plan as (
  select *, floor(weight * total)::bigint as goal, ceil(n_docs / 4096.0)::bigint as blocks from w),
plan2 as (select *, floor(goal / tokens)::bigint as full_ from plan),
dealt as (
  select d.doc_id, d.source, d.n_tokens, p.tokens, p.weight, p.goal, p.full_,
         ('0x' || substr(md5('7|' || d.doc_id), 1, 8))::bigint % p.blocks as block
  from docs d join plan2 p on d.source is not distinct from p.source),
sums as (
  select source, block, full_, goal, tokens, sum(n_tokens) as inside from dealt group by all),
ep as (select *, unnest(range(full_ + 1)) as epoch from sums),
ranked as (
  select *, ('0x' || substr(md5('7|' || epoch || '|' || coalesce(source, '') || '|' || block), 1, 8))::bigint as o from ep),
cum as (
  select source, block, epoch, goal, row_number() over (partition by source, epoch order by o, block) as block_rank,
         sum(inside) over (partition by source, epoch order by o, block) - inside + epoch * tokens as before
  from ranked),
joined as (
  select d.*, c.epoch, c.block_rank, c.before,
         ('0x' || substr(md5('7|' || c.epoch || '|' || d.doc_id), 1, 8))::bigint as o
  from dealt d join cum c on d.source is not distinct from c.source and d.block = c.block and c.before < c.goal),
passed as (
  select *, row_number() over (partition by source, epoch, block order by o, doc_id) as rank_in_block,
         before + sum(n_tokens) over (partition by source, epoch, block order by o, doc_id rows unbounded preceding) - n_tokens as passed
  from joined)
select doc_id, source, n_tokens, epoch, block, block_rank, rank_in_block, round(weight, 9) as weight
from passed where passed < goal
"""

NEGATIVES_SQL = """
with v as (
  select row_number() over () as uid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select a.uid as anchor, a.vec_id as anchor_id, a.label as own, b.vec_id, b.label, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.uid <> b.uid and len(a.q) = len(b.q)
  where a.vec_id % 100 = 0),
positives as (
  select anchor, anchor_id, own, vec_id as positive_id, score as positive_score
  from scored where label = own
  qualify row_number() over (partition by anchor order by score desc, vec_id nulls last) <= 5)
select p.anchor_id, p.positive_id, n.vec_id as negative_id, p.positive_score, n.score as negative_score,
       (row_number() over (partition by p.anchor, p.positive_id, p.positive_score order by n.score desc, n.vec_id nulls last))::int as rank
from positives p join scored n
  on n.anchor = p.anchor and n.label <> p.own and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
qualify rank <= 5
"""

COMPONENTS = "list_transform(embedding, lambda x: floor(256 * x::double)::bigint)"
LLOYD_SQL = f"""
with v as materialized (
  select row_number() over () as uid, vec_id, {COMPONENTS} as q
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
x as materialized (select uid, unnest(range(64)) as d, unnest(q) as c from v),
starts as (select uid, row_number() over (order by sha256('2:' || vec_id), q) - 1 as k from v qualify k < 40),
c0 as materialized (select s.k, x.d, x.c from starts s join x using (uid)),
""" + ",\n".join(f"""a{r} as materialized (
  select uid, min_by(k, s * 64 + k) as k, min(s) as s
  from (select x.uid, c.k, sum((x.c - c.c) * (x.c - c.c))::bigint as s from x join c{r} c using (d) group by all) group by uid)""" + (f""",
c{r + 1} as materialized (
  select o.k, o.d, coalesce(n.c, o.c) as c
  from c{r} o left join (
    select a.k, x.d, (sum(x.c) - ((sum(x.c) % count(*)) + count(*)) % count(*)) // count(*) as c
    from x join a{r} a using (uid) group by all) n using (k, d))""" if r < 5 else "") for r in range(6)) + """,
names as (select k, sha256(string_agg(c::bigint, ',' order by d)) as centroid_sha256 from c5 group by k),
sums as (select k, sum(s)::bigint as cluster_inertia from a5 group by k)
select v.vec_id, a5.k::int as cluster, a5.s as distance, sums.cluster_inertia, (select sum(s)::bigint from a5) as inertia, names.centroid_sha256
from a5 join v using (uid) join names using (k) join sums using (k)
"""

ORACLE = {"op11_hard_negatives": NEGATIVES_SQL, "op12_centroids": LLOYD_SQL, "op2_line_dedup": LINES_SQL, "op4_mixing": MIX_SQL}
