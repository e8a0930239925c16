"""DuckDB SQL for the corpus queries that SQL can express: op3, op5 to op7, op11 and the base counts of op8.

Components are a recursion that holds the least id known to reach each node (USING KEY) until none gets a lesser one.
op1, op2, op4, op8 to op10, op12 and op13 rest on learned models, tokenizers or hashes that SQL lacks; tests hold them against brute force,
the public libraries or held-out labels.
"""

OP5 = """
with p as (select page_id, coalesce(html, '') as body from pages),
h as (select page_id, octet_length(encode(body)) as payload_bytes, sha1(body) as hex from p),
five as (select *, list_transform(range(0, 8), lambda g: cast('0x' || substr(hex, cast(5 * g + 1 as bigint), 5) as bigint)) as v from h),
d as (select page_id, payload_bytes, array_to_string(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 15) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') as payload_digest from five),
f as (select payload_digest, min(page_id) as first_id from d group by 1)
select page_id, payload_bytes, payload_digest, case when page_id > first_id then 'revisit' else 'response' end as record_type, case when page_id > first_id then first_id end as refers_to
from d join f using (payload_digest)
"""
_COMPONENTS = """, both_ways as (select a as u, b as v from links union all select b, a from links),
reach(id, low) using key (id) as (
  select id, id from nodes
  union
  select b.v, min(r.low) from reach r join both_ways b on b.u = r.id join recurring.reach o on o.id = b.v where r.low < o.low group by b.v)"""
OP3 = """
with recursive ok as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select x.vec_id as a, y.vec_id as b from ok x join ok y on x.label = y.label and len(x.e) = len(y.e) and x.vec_id < y.vec_id where list_cosine_similarity(x.e, y.e) >= 0.98),
nodes as (select vec_id as id from embeddings)""" + _COMPONENTS + """
select vec_id, coalesce(n, 0) as n_links, low as component_id, low = vec_id as kept
from embeddings join reach on id = vec_id left join (select u, count(*) as n from both_ways group by u) on u = vec_id
"""
OP7 = r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\r\f\x0B]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from w),
z as (select doc_id, list_sort(s) as s from s),
reps as (select s, min(doc_id) as rep from z where len(s) > 0 group by s),
e as (select rep, len(s) as n, unnest(s) as x from reps),
pairs as (select x.rep as a, y.rep as b, any_value(x.n) as na, any_value(y.n) as nb, count(*) as m from e x join e y on x.x = y.x and x.rep < y.rep group by 1, 2),
links as (select a, b from pairs where 100 * m >= 85 * (na + nb - m) union all select rep, doc_id from z join reps using (s) where doc_id <> rep),
nodes as (select doc_id as id from documents)""" + _COMPONENTS + """
select doc_id, len(s) as n_shingles, low as component_id, low = doc_id as kept from z join reach on id = doc_id
"""
#: crc32 by its table; letters beyond ASCII are two bytes, of which the first is C3. Words are near if they agree with one place masked, or if one is the other without one place.
OP11 = r"""
with recursive tab as (select list(list_reduce(range(0, 8), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as t from range(0, 256) r(i)),
runs as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents),
once as (select doc_id, run, count(*) as m from runs where length(run) >= 6 group by all),
coded as (select run, m, list_transform(flatten(list_transform(string_split(coalesce(cast(doc_id as varchar), '') || ':' || run, ''), lambda x: case when unicode(x) < 128 then [unicode(x)] else [195, unicode(x) - 64] end)), lambda x: cast(x as bigint)) as b from once),
hashed as (select run, m, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) as h from coded, tab),
slipped as (select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, m from hashed),
v as (select word, cast(sum(m) as bigint) as n from slipped where length(word) >= 6 group by 1 having sum(m) >= 5),
cut as (select word, n, unnest(range(1, length(word) + 1)) as i from v),
masked as (select word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) as k from cut),
less as (select distinct word, n, substr(word, 1, i - 1) || substr(word, i + 1) as k from cut),
near as (select x.word, y.word as other, y.n as other_n from masked x join masked y on x.k = y.k and x.word <> y.word
  union all select less.word, v.word, v.n from less join v on v.word = k union all select v.word, less.word, less.n from less join v on v.word = k),
best as (select word, count(*) as n_near, arg_min({'f': other, 'n': other_n}, {'a': -other_n, 'b': other}) as f from near group by 1),
found as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when f.n >= 5 * v.n then f.f end as form, case when f.n >= 5 * v.n then f.n end as form_n from v left join best using (word)),
ends(word, root) as (select word, word from found union all select ends.word, found.form from ends join found on found.word = ends.root where found.form is not null)
select word, form, root, n, n_near, form_n from found join ends using (word) join (select word as root, form as further from found) using (root) where further is null
"""
#: Levels rise until the sources that stop at twice their size are stable, one more at least in each step.
OP6 = r"""
with recursive d as (select doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f\x0B]+'), lambda x: x <> '')) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size, cast([3, 1, 2][(row_number() over (order by source is null, source) - 1) % 3 + 1] as double) as w from d group by source),
lv(i, level) as (select 0, cast(0 as double) union all
  select i + 1, coalesce(greatest(level, (cast(1.5 as double) * (select sum(source_size) from s) - sum(case when w * level >= source_size * cast(2 as double) then source_size * cast(2 as double) else 0 end)) / nullif(sum(case when w * level >= source_size * cast(2 as double) then 0 else w end), 0)), level)
  from lv, s where i <= (select count(*) from s) group by i, level),
t as (select source, source_size, case when w * level >= source_size * cast(2 as double) then source_size * cast(2 as double) else w * level end as target from s, (select level from lv order by i desc limit 1)),
r as (select *, case when source_size > 0 then target / source_size else 0 end as rate, rate - floor(rate) as fraction from t),
u as (select d.doc_id, d.source, size, seed, cast('0x' || substr(md5(seed || '|' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) / cast(4294967296 as double) as u from d, range(0, 32) x(seed)),
e as (select r.source, seed, abs(sum(case when u < fraction then size else 0 end) - (any_value(target) - floor(any_value(rate)) * any_value(source_size))) as off from u join r on u.source is not distinct from r.source group by all),
best as (select source, seed from e qualify row_number() over (partition by source order by off, seed) = 1)
select u.doc_id, size, source_size, target, cast(size * (floor(rate) + case when u < fraction then 1 else 0 end) as bigint) as taken
from u join best b on u.source is not distinct from b.source and u.seed = b.seed join r on u.source is not distinct from r.source
"""
OP8_BASE = r"""
with d as (select doc_id, coalesce(text, '') as t, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f\x0B]+'), lambda x: x <> '') as w from documents),
three as (select doc_id, unnest(range(1, len(w) - 1)) as i, w from d),
win as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as x from three),
many as (select doc_id, i from win qualify count(*) over (partition by doc_id, x) > 1),
rep as (select doc_id, count(distinct i + j) as n from many, range(0, 3) r(j) group by 1),
lines as (select doc_id, unnest(string_split(t, chr(10))) as line from d),
dup as (select doc_id, count(*) - count(distinct line) as n from lines where regexp_matches(line, '[^ \t\n\r\f\x0B]') group by 1),
c as (select doc_id, len(w) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars, cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, coalesce(dup.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words
  from d left join dup using (doc_id) left join rep using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c
"""
