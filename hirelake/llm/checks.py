"""Checking SQL (DuckDB) of the operators that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORD = r"'[^\x20\x09-\x0D]+'"
ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SUBSTRING = f"""
with d as (select doc_id, row_number() over () as r, regexp_extract_all(coalesce(text, ''), {WORD}) as w from documents),
win as (select r, doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) as k
  from (select *, unnest(range(1, len(w) - 48)) as p from d where len(w) >= 50) t),
least_doc as (select k, min(doc_id) as m from win group by k),
gone as (select distinct r, unnest(range(p, p + 50)) as x from win join least_doc using (k) where m < doc_id),
word as (select r, unnest(w) as v, generate_subscripts(w, 1) as x from d),
kept as (select r, string_agg(v, ' ' order by x) as t from word anti join gone using (r, x) group by r)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (r) left join (select r, count(*) as n from gone group by r) g using (r)"""

LANGUAGE_MODEL = f"""
with d as (select doc_id, row_number() over () as r, regexp_extract_all({PLAIN}, {WORD}) as w from documents),
word as (select r, unnest(w) as v, generate_subscripts(w, 1) as x from d),
c1 as (select v, count(*) as c from word group by v),
o1 as (select r, v, count(*) as o from word group by r, v),
pair as (select r, x, v, lag(v) over (partition by r order by x) as a from word),
c2 as (select a, v, count(*) as c from pair where a is not null group by a, v),
o2 as (select r, a, v, count(*) as o from pair where a is not null group by r, a, v),
total as (select count(*) as n from word),
one as (
  select p.r, p.a, coalesce(c2.c - o2.o, 0) as both_, ca.c - oa.o as before_, cv.c - ov.o as seen, total.n - len(d.w) as others
  from pair p join d on p.r = d.r cross join total
  join c1 cv on cv.v = p.v join o1 ov on ov.r = p.r and ov.v = p.v
  left join c1 ca on ca.v = p.a left join o1 oa on oa.r = p.r and oa.v = p.a
  left join c2 on c2.a = p.a and c2.v = p.v left join o2 on o2.r = p.r and o2.a = p.a and o2.v = p.v),
s as (
  select r, count(*) filter (where both_ = 0) as k,
    sum(case when both_ > 0 then ln(both_) - ln(before_)
      else case when a is null then 0 else ln(0.4) end + case when seen > 0 then ln(seen) else ln(0.4) end - ln(others) end) as s
  from one group by r)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(k, 0) as n_backoff, round(s / len(w), 6) as log_score
from d left join s using (r)"""

DECONTAMINATION = f"""
with d as (select doc_id, row_number() over () as r, regexp_extract_all({PLAIN}, {ITEM_WORD}) as w from documents),
i as (select item_id, regexp_extract_all({PLAIN}, {ITEM_WORD}) as w from benchmark),
iw as (select distinct item_id, size, array_to_string(w[p:p + size - 1], ' ') as k from (
  select item_id, w, least(len(w), 10) as size, unnest(range(1, len(w) - least(len(w), 10) + 2)) as p from i where len(w) > 0) t),
dw as (select r, size, p, array_to_string(w[p:p + size - 1], ' ') as k from (
  select r, w, size, unnest(range(1, len(w) - size + 2)) as p from d, (select distinct size from iw) s where len(w) >= size) t),
hit as (select r, item_id, p, size from dw join iw using (size, k)),
words as (select r, count(distinct x) as n_hit from (select r, unnest(range(p, p + size)) as x from hit) t group by r),
found as (select r, count(*) as n_items, string_agg(id, ',' order by id) as items
  from (select distinct r, cast(item_id as varchar) as id from hit) t group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from d left join words using (r) left join found using (r)"""

# Of two lines within one edit, the first or the last eight characters agree.
LINES = """
with l as (select doc_id, x, line, nullif(p, '') as p from (
    select doc_id, x, line, trim(regexp_replace(lower(line), '\\s+', ' ', 'g')) as p from (
      select doc_id, unnest(s) as line, generate_subscripts(s, 1) as x
      from (select doc_id, string_split(text, chr(10)) as s from documents) a) b) c),
f as (select p, min((doc_id, x)) as first from l where p is not null group by p),
near as (
  select a.p, b.first from f a join f b on left(a.p, 8) = left(b.p, 8)
    where a.p <> b.p and length(a.p) >= 20 and length(b.p) >= 20 and abs(length(a.p) - length(b.p)) <= 1 and levenshtein(a.p, b.p) <= 1
  union all
  select a.p, b.first from f a join f b on right(a.p, 8) = right(b.p, 8)
    where a.p <> b.p and length(a.p) >= 20 and length(b.p) >= 20 and abs(length(a.p) - length(b.p)) <= 1 and levenshtein(a.p, b.p) <= 1
  union all select p, first from f),
e as (select p, min(first) as first from near group by p),
k as (select l.doc_id, l.x, l.line, e.first is not null and e.first < (l.doc_id, l.x) as gone from l left join e using (p))
select doc_id, count(*) filter (where gone) as n_removed,
  sha256(coalesce(string_agg(line, chr(10) order by x) filter (where not gone), '')) as kept_sha256
from k group by doc_id"""



def _centroid_rounds(rounds: int = 3, k: int = 16, width: int = 64) -> str:
    """Assignment and exact floors of means, written out round by round."""
    parts = [f"""
with v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor({width} * cast(x as double)) as bigint)) as c
  from embeddings where len(embedding) = {width} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (
  select row_number() over (order by h, c) - 1 as k, c from (
    select sha256('1:' || cast(vec_id as varchar)) as h, c from v order by h, c limit {k}) t)"""]
    for i in range(rounds + 1):
        parts.append(f""", a{i} as materialized (
  select r, min((d, k)) as best from (
    select r, k, list_sum(list_transform(list_zip(v.c, c{i}.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d from v, c{i}) t
  group by r)""")
        if i < rounds:
            parts.append(f""", m{i + 1} as (
  select k, x, cast((s - ((s % n) + n) % n) // n as bigint) as y from (
    select best[2] as k, x, sum(y) as s, count(*) as n from (
      select best, unnest(c) as y, generate_subscripts(c, 1) as x from a{i} join v using (r)) u group by 1, 2) w),
c{i + 1} as materialized (
  select k, coalesce(n.c, c{i}.c) as c from c{i} left join (select k, list(y order by x) as c from m{i + 1} group by k) n using (k))""")
    last = f"a{rounds}"
    parts.append(f"""
select vec_id, cast(best[2] as int) as cluster, cast(best[1] as bigint) as distance,
  cast(sum(best[1]) over (partition by best[2]) as bigint) as cluster_inertia, cast(sum(best[1]) over () as bigint) as inertia,
  sha256(array_to_string(f.c, ',')) as centroid_sha256
from {last} join v using (r) join (select k, c from c{rounds}) f on f.k = best[2]""")
    return "".join(parts)


ORACLES = {
    "op11_centroids": _centroid_rounds(),
    "op4_substring": SUBSTRING,
    "op7_lm": LANGUAGE_MODEL,
    "op9_decontamination": DECONTAMINATION,
    "op10_lines": LINES,
}
