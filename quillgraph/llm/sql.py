"""DuckDB SQL for the queries that it can express."""

_W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL = {
    "op1_substring_dedup": rf"""
with d as (select doc_id, {_W} as w from documents),
win as (select doc_id, unnest(generate_series(1, len(w) - 19)) as s, w from d where len(w) >= 20),
win2 as (select doc_id, s, array_to_string(w[s:s + 19], ' ') as p from win),
rep as (select doc_id, s from (select doc_id, s, row_number() over (partition by p order by doc_id, s) as r from win2) where r > 1),
gone as (select distinct doc_id, unnest(generate_series(s, s + 19)) as i from rep),
g as (select doc_id, list(i) as gi from gone group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(len(gi), 0)::bigint as n_removed,
  sha256(array_to_string(case when gi is null then w else list_filter(list_transform(w, lambda x, i: case when list_contains(gi, i) then null else x end), lambda x: x is not null) end, ' ')) as kept_sha256
from d left join g using (doc_id)""",
    "op3_source_mixing": rf"""
with d as (select doc_id, source, len({_W})::bigint as size, ('0x' || left(md5('17:' || coalesce(doc_id::varchar, '')), 15))::bigint as place from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, 2::double * source_size as lim, [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by source is null, source) - 1) % 3 + 1] as weight from s),
l as (select *, lim / weight as level from w),
a as (select *, ((select sum(source_size) from l) * 1.5::double - coalesce(sum(lim) over u, 0)) / ((select sum(weight) from l) - coalesce(sum(weight) over u, 0)) as lvl
  from l window u as (order by level, source is null, source rows between unbounded preceding and 1 preceding)),
f as (select lvl from a where lvl <= level order by level, source is null, source limit 1),
t as (select source, source_size, case when exists (select 1 from f) then least(lim, weight * (select lvl from f)) else lim end as target from a),
q as (select d.*, source_size, target, coalesce(sum(size) over (partition by d.source order by place, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join t on d.source is not distinct from t.source),
c as (select *, before + copy * source_size as start from q, (values (0), (1)) x(copy) where size > 0 or copy = 0),
o as (select *, start < target and start + size > target as open from c),
p as (select *, unnest(case when open then generate_series(0::bigint, size - 1, 16::bigint) else [0::bigint] end) as packet from o),
e as (select *, case when open then least(16, size - packet) else size end as words from p),
g as (select *, case when target > 0 then (start + packet + words) / target else 0 end as finish from e),
r as (select *, coalesce(sum(words) over (order by finish, doc_id, copy, packet rows between unbounded preceding and 1 preceding), 0) as past from g)
select doc_id, size, source_size, target, sum(greatest(0, least(words, (select floor(sum(size) * 1.5::double) from d) - past)))::bigint as taken
from r group by doc_id, size, source_size, target, source""",
    "op6_top_k": """
with e as (select row_number() over () as uid, vec_id, [floor(256 * x::double)::bigint for x in embedding] as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.uid, q.vec_id as query_id, c.vec_id, list_sum([a[1] * a[2] for a in list_zip(q.v, c.v)])::bigint as score
  from e q join e c on q.uid <> c.uid where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by uid order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
    # candidates share one of their rarest shingles, as many as a pair at the threshold must
    "op7_near_duplicates": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
l as (select doc_id, list_distinct(case when len(w) >= 2 then list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) else w end) as l from w),
s as materialized (select doc_id, unnest(l) as g, len(l) as n from l),
f as (select g, count(*) as f from s group by g having count(*) > 1),
r as materialized (select s.doc_id, s.g, n, row_number() over (partition by s.doc_id order by coalesce(f, 1), s.g) as r from s left join f using (g)),
p as (select doc_id, g, n from r where r <= n - ceil(0.8 * n) + 1),
c as materialized (select distinct a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb from p a join p b on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
o as (select c.a, c.b, na, nb, count(*) as common from c join s x on x.doc_id = c.a join s y on y.doc_id = c.b and y.g = x.g group by all),
e as materialized (select a, b from o where 100 * common >= 80 * (na + nb - common)),
u as materialized (select a, b from e union all select b, a from e),
k as (select a as doc_id, a as root from u union select u.b, k.root from k join u on u.a = k.doc_id where k.root < u.b),
m as (select doc_id, min(root) as root from k group by doc_id)
select l.doc_id, len(l.l)::bigint as n_shingles, least(l.doc_id, coalesce(root, l.doc_id)) as component_id, l.doc_id = least(l.doc_id, coalesce(root, l.doc_id)) as kept from l left join m on m.doc_id = l.doc_id""",
    "op8_chat_format": r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
f as (select *, '<|im_start|>' || replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<|nl|>') || chr(10) || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10) as line from c),
g as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, line) as turns,
  coalesce(string_agg(text, '' order by turn nulls first, role, line) filter (where role = 'assistant'), '') as loss, sum(length(line))::bigint as formatted_chars from f group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars from g""",
    "op10_quality_rules": rf"""
with d as (select doc_id, coalesce(text, '') as t, {_W} as w from documents),
win as (select doc_id, unnest(generate_series(1, len(w) - 7)) as s, w from d where len(w) >= 8),
dup as (select doc_id, s from (select doc_id, s, count(*) over (partition by doc_id, array_to_string(w[s:s + 7], ' ')) as c from win) where c > 1),
rep as (select doc_id, count(distinct i) as n from (select doc_id, unnest(generate_series(s, s + 7)) as i from dup) group by doc_id),
m as (select d.doc_id, len(w)::bigint as n_words, coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines,
  coalesce(rep.n, 0)::bigint as n_repeat_words,
  len(regexp_extract_all(t, '\p{{L}}[^\x20\x09-\x0D]*'))::bigint as n_plain
  from d left join rep using (doc_id)),
k as (select *, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or 10 * n_dup_lines > 3 * len(lines)
    or (n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)) or 5 * n_plain < 2 * n_words) as kept
from k""",
    "op11_filter_interactions": rf"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, {_W} as w from documents),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
  (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
  + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int
  + 16 * (d.doc_id > min(d.doc_id) over (partition by t))::int as mask
  from d left join l using (doc_id)),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, mask),
f(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o as (select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as before from o, range(1, 6) r(step)),
shap as (select part, bit, sum(case when mask & bit <> 0 then n * 120 // bit_count(mask) else 0 end)::bigint as shapley from c, f group by part, bit),
e as (select part, filter_order, step, s.bit,
  sum(case when mask & (s.bit | before) = 0 then n else 0 end)::bigint as kept,
  sum(case when mask & s.bit <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
  sum(case when mask & s.bit <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
  sum(case when mask = s.bit then n else 0 end)::bigint as unique_fails,
  sum(case when mask & s.bit <> 0 and mask & before = 0 then good else 0 end)::bigint as good_lost,
  sum(case when mask & s.bit <> 0 and mask & before = 0 then toxic else 0 end)::bigint as toxic_lost
  from c, s group by part, filter_order, step, s.bit)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley from e join shap using (part, bit)""",
    # equal words at every distance up to a quarter of the document; neighbouring pairs at one distance make a run
    "op12_periodic_runs": rf"""
with d as (select doc_id, {_W} as w, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) as h from documents),
g as (select *, len(w)::bigint as n, h // 10 as g from d),
a as (select *, case when h % 10 = 0 and n > 0 then g % n end as a, case when h % 10 = 0 and n > 0 then 1 + (n - g % n) // (3 + g % 8) end as p from g),
i as (select doc_id, w, n, a, p, unnest(range(n)) as i from a),
t as materialized (select doc_id, n, i, w[1 + case when i < a or a is null then i else a + (i - a) % p end] as x from i),
e as (select l.doc_id, r.i - l.i as p, l.i from t l join t r on l.doc_id = r.doc_id and l.x = r.x and r.i > l.i and 4 * (r.i - l.i) <= l.n),
k as (select doc_id, p, i, i - row_number() over (partition by doc_id, p order by i) as island from e),
u as (select doc_id, p, min(i) as start, count(*) + p as length from k group by doc_id, p, island having count(*) >= greatest(6 - p, 3 * p)),
runs as materialized (select doc_id, start, length, min(p) as period from u group by doc_id, start, length),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (select doc_id, string_agg(x, ' ' order by t.i) as text from t anti join gone on gone.doc_id = t.doc_id and gone.i = t.i group by doc_id),
s as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed,
  list(struct_pack(l := -length, s := start, p := period) order by -length, start, period)[1] as best from runs group by doc_id)
select d.doc_id, coalesce(n_runs, 0)::bigint as n_runs, best.s::bigint as start, (-best.l)::bigint as length, best.p::bigint as period,
  (1000 * -best.l // best.p)::bigint as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
from d left join s using (doc_id) left join kept using (doc_id)""",
    "op13_line_dedup": r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key, min(doc_id) as first from k where length(key) >= 10 group by key),
m as (select k.doc_id, i, line, coalesce(first <> k.doc_id, false) as gone from k left join f using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from m group by doc_id""",
}
