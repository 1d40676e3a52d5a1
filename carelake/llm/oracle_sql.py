"""DuckDB SQL for the training-data queries that SQL can express."""

WORDS = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIX = rf"""
with d as (
  select doc_id, source, coalesce({WORDS}, 0)::bigint as size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as h
  from documents),
s as (select source, sum(size)::bigint as source_size,
             [3.0, 1.0, 2.0][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::double as w
      from d group by source),
b as (select 1.5 * sum(source_size) as budget, sum(w) as all_w from s),
-- the sources that reach their cap are the first k by cap over weight
r as (select s.*, 2.0 * source_size as cap, row_number() over (order by 2.0 * source_size / w, source) as k from s),
c as (select r.*, coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0) as held,
             coalesce(sum(w) over (order by k rows between unbounded preceding and 1 preceding), 0) as held_w from r),
l as (select max((budget - held) / (all_w - held_w)) filter (where cap > (budget - held) / (all_w - held_w) * w) as level
      from c, b),
t as (select source, source_size, least(cap, level * w) as target,
             case when source_size > 0 then round(least(cap, level * w))::bigint // source_size else 0 end as copies
      from c, l),
g as (select d.*, source_size, target, copies, round(target)::bigint - copies * source_size as rest,
             coalesce(sum(size) over (partition by d.source order by h
                                      range between unbounded preceding and 1 preceding), 0)::bigint as before,
             sum(size) over (partition by d.source, h)::bigint as tied
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target::double as target,
       (copies * size + case when before + tied <= rest then size
                             when before <= rest and tied > 0 then (size::hugeint * (rest - before)) // tied
                             else 0 end)::bigint as taken
from g"""

# the html of the given pages names no canonical link and no refresh target; the
# query still links pages by them, and a fixture with such links is tested by brute force
URLS = r"""
with u as (
  select row_number() over () as i, page_id,
         case when url like '%://%' then substr(url, strpos(url, '://') + 3) end as tail from pages),
p as (select i, page_id, coalesce(translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz'), '') as host,
             coalesce(regexp_extract(tail, '^[^/?#]*([^?#]*)', 1), '') as path from u),
r(rule, verdict) as (values ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'),
                            ('com/fr/', 'allow'), ('com/de/', 'block')),
m as (select i, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
      from p join r on ('.' || host) like '%.' || split_part(rule, '/', 1)
                   and starts_with(path, substr(rule, strpos(rule, '/')))
      group by i)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join m using (i)"""

EXACT = f"""
with d as (select doc_id, sha256({LOWERED}) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*)::bigint as group_size from d group by 1)
select doc_id, keep_id, group_size,
       row_number() over (partition by text_sha256 order by doc_id desc nulls last) = 1 as kept, text_sha256
from d join g using (text_sha256)"""

CHAT = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
n as (select *, length(text) + length(text) - length(replace(text, '\', ''))
             + len([i for i in range(1, length(text) + 1) if substr(text, i, 3) = '###'])
             + (length(text) - length(replace(text, '</turn>', ''))) // 7 as body from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length('### ' || role || ': ' || ' </turn>' || chr(10)) + body)::bigint as formatted_chars
from n group by conv_id"""

# exact shingle sets; links by counting common shingles; components by reachability
NEAR = rf"""
with d as (select doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, case when len(w) >= 3 then array_to_string(w[i:i + 2], ' ') else array_to_string(w, ' ') end as sh
      from d, unnest(range(1, greatest(len(w) - 1, 2))) as r(i) where len(w) > 0),
n as (select doc_id, count(*)::bigint as n from s group by doc_id),
p as (select a.doc_id as u, b.doc_id as v, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
l as (select u, v from p join n x on x.doc_id = u join n y on y.doc_id = v where 100 * k >= 85 * (x.n + y.n - k)),
c(node, root) as (with recursive r(node, root) as (
      select doc_id, doc_id from documents
      union select l2.b, r.root from r join (select u as a, v as b from l union all select v, u from l) l2 on l2.a = r.node)
  select node, min(root) from r group by node)
select doc_id, coalesce(n, 0)::bigint as n_shingles, root as component_id, doc_id = root as kept
from documents left join n using (doc_id) join c on c.node = doc_id"""

LEAKS = rf"""
with d as (select doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select coalesce(item_id::varchar, '') as item, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from benchmark),
iw as (select distinct item, least(len(w), 10) as k, array_to_string(w[i:i + 9], ' ') as t
       from b, unnest(range(1, greatest(len(w) - 8, 2))) as r(i) where len(w) > 0),
dw as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as t
       from d, (select distinct k from iw) as z, unnest(range(1, len(w) - k + 2)) as r(i)),
h as (select dw.doc_id, dw.i, dw.k, iw.item from dw join iw on dw.k = iw.k and dw.t = iw.t),
words as (select doc_id, count(distinct x) as n from h, unnest(range(i, i + k)) as r(x) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as list
          from (select distinct doc_id, item from h) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(words.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)"""

# shortest runs of 30 words from each line on, paired with every earlier equal one; the last pair of a row of pairs
# is prolonged line by line while both sides agree; the lines of all these runs go
LINES = r"""
with recursive d as (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null),
l as (select doc_id, i - 1 as pos, trim(ls[i], ' ' || chr(9) || chr(13)) as t,
             len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) as n
      from d, unnest(range(1, len(ls) + 1)) as r(i)),
s as (select *, row_number() over (partition by doc_id order by pos) as k,
             coalesce(sum(n) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0)::bigint
                as s from l where n > 0),
total as (select doc_id, sum(n)::bigint as total from s group by doc_id),
w as (select doc_id, k, max(k) over near as b, md5(string_agg(t, chr(10)) over near) as run, s, total
      from s join total using (doc_id)
      window near as (partition by doc_id order by s range between current row and 29 following)),
f as (select doc_id, k, b, run from w where s + 30 <= total),
p as (select x.doc_id, x.k, x.b, y.doc_id as d2, y.k as k2, y.b as b2
      from f x join f y on x.run = y.run and (y.doc_id < x.doc_id or (y.doc_id = x.doc_id and y.k < x.k))),
e(doc_id, k, b, d2, b2) as (
  select doc_id, k, b, d2, b2 from p
  where not exists (select 1 from p q where q.doc_id = p.doc_id and q.k = p.k + 1 and q.d2 = p.d2 and q.k2 = p.k2 + 1)
  union all
  select e.doc_id, e.k, e.b + 1, e.d2, e.b2 + 1
  from e join s x on x.doc_id = e.doc_id and x.k = e.b + 1 join s y on y.doc_id = e.d2 and y.k = e.b2 + 1 and y.t = x.t),
runs as (select doc_id, k, max(b) as b from (select doc_id, k, b from p union all select doc_id, k, b from e) group by 1, 2),
gone as (select distinct r.doc_id, x as pos
         from runs r join s a on a.doc_id = r.doc_id and a.k = r.k join s z on z.doc_id = r.doc_id and z.k = r.b,
              unnest(range(a.pos, z.pos + 1)) as u(x))
select d.doc_id, len(ls)::bigint as n_lines, count(g.pos)::bigint as n_removed,
       sha256(coalesce(string_agg(ls[i], chr(10) order by i) filter (where g.pos is null), '')) as kept_sha256
from d, unnest(range(1, len(ls) + 1)) as r(i) left join gone g on g.doc_id = d.doc_id and g.pos = r.i - 1
group by d.doc_id, ls"""

# every document is scored for every item that shares a term with it
RANKED = rf"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
           from documents),
n as (select r, doc_id, len(w)::bigint as n from d where len(w) > 0),
total as (select count(*)::bigint as docs, sum(n)::bigint as terms from n),
f as (select r, term, count(*)::bigint as tf from (select r, unnest(w) as term from d) group by r, term),
q as (select item_id, term, count(*)::bigint as k from (
        select item_id, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term
        from (select distinct item_id, text from benchmark)) group by item_id, term),
g as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w
      from f, total where term in (select term from q) group by term, docs),
s as (select item_id, r, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
      from q join g using (term) join f using (term) join n using (r), total group by item_id, r),
o as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
      from s join n using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score from o where rank <= 20"""
