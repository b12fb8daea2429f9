"""DuckDB SQL that gives the rows of the contract queries."""

_WORDS = r"list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def words(text: str = "text") -> str:
    return _WORDS.format(text=text)


QUALITY = rf"""
with d as (select doc_id, source, coalesce(text, '') as t, {words()} as ws from documents),
base as (
  select doc_id, len(ws) as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    (select len(ls) - len(list_distinct(ls)) from (select list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls)) as n_dup_lines
  from d),
tri as (select doc_id, unnest(generate_series(1, len(ws) - 2)) as i, ws from d where len(ws) >= 3),
win as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as w from tri),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as n from win) where n > 1),
cov as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as p from rep) group by doc_id),
lines as (
  select doc_id, source, t, trim(regexp_replace(translate(lower(line), '123456789', '000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) as line
  from (select doc_id, source, t, unnest(string_split(t, chr(10))) as line from d)),
often as (select source, line from lines where line <> '' group by source, line having count(distinct doc_id) > 50),
freq as (
  select l.doc_id, sum(len(string_split(l.line, ' '))) as n
  from lines l join often o on l.source is not distinct from o.source and l.line = o.line group by l.doc_id)
select b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, coalesce(c.n_repeat_words, 0) as n_repeat_words,
  coalesce(f.n, 0)::bigint as n_frequent_words,
  (b.n_words < 50 or 100 * coalesce(c.n_repeat_words, 0) > 50 * b.n_words) as base_failed,
  not (b.n_words < 50 or 100 * coalesce(c.n_repeat_words, 0) > 50 * b.n_words) and coalesce(f.n, 0) <= 0.5 * b.n_words as kept
from base b left join cov c using (doc_id) left join freq f using (doc_id)
"""

MIXING = rf"""
with d as (select doc_id, source, len({words()})::bigint as size, md5('mix:' || coalesce(doc_id::varchar, '')) as k from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as n from d group by source),
w as (select source, source_size, (n - 1) % 3 + 1 as weight, 3.0::double * source_size / ((n - 1) % 3 + 1) as ratio from s),
l as (
  select *, (sum(source_size) over () - 3.0::double * coalesce(sum(source_size) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following))::double as level
  from w),
t as (
  select source, source_size, case when level > ratio then 3.0::double * source_size
    else (select l2.level from l l2 where not l2.level > l2.ratio order by l2.ratio, l2.source nulls last limit 1) * weight end as target
  from l),
p as (
  select d.doc_id, d.size, t.source_size, t.target, floor(t.target)::bigint as budget,
    (sum(d.size) over (partition by d.source order by d.k, d.size rows unbounded preceding) - d.size)::bigint as before
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (case when source_size > 0 then budget // source_size else 0 end * size
    + greatest(0, least(size, budget - case when source_size > 0 then budget // source_size else 0 end * source_size - before)))::bigint as taken
from p
"""

LINES = r"""
with l as (
  select doc_id, unnest(generate_series(1, len(ls))) as i, ls from (select doc_id, string_split(text, chr(10)) as ls from documents)),
n as (select doc_id, i, ls[i] as line, trim(regexp_replace(lower(ls[i]), '[\x20\x09-\x0D]+', ' ', 'g')) as norm from l),
m as (
  select doc_id, i, norm, len(string_split(norm, ' ')) as k, lead(i) over r as i2, lead(i, 2) over r as i3, lead(norm) over r as norm2, lead(norm, 2) over r as norm3,
    count(*) over (partition by doc_id) as n_full, row_number() over r as nth
  from n where norm <> '' window r as (partition by doc_id order by i)),
f as (
  select doc_id, i as a, i3 as z, norm || chr(10) || norm2 || chr(10) || norm3 as w from m where i3 is not null
  union all select doc_id, i, i2, norm || chr(10) || norm2 from m where i2 is not null and k + len(string_split(norm2, ' ')) > 50
  union all select doc_id, i, i, norm from m where k > 50
  union all select doc_id, i, i2, 'whole' || chr(13) || norm || chr(10) || norm2 from m where n_full = 2 and nth = 1 and k + len(string_split(norm2, ' ')) <= 50
  union all select doc_id, i, i, 'whole' || chr(13) || norm from m where n_full = 1 and k <= 50),
k as (select *, row_number() over (partition by w order by doc_id, a) as nth from f),
g as (select distinct doc_id, unnest(generate_series(a, z)) as i from k where nth > 1)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines, coalesce(x.n_removed, 0)::bigint as n_removed,
  sha256(x.kept) as kept_sha256
from documents d left join (
  select n.doc_id, count(g.i) as n_removed, coalesce(string_agg(case when g.i is null then n.line end, chr(10) order by n.i), '') as kept
  from n left join g on n.doc_id = g.doc_id and n.i = g.i group by n.doc_id) x using (doc_id)
"""

NEAR = rf"""
with recursive d as (select doc_id, {words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws from documents),
s as (
  select distinct doc_id, case when len(ws) = 1 then ws[1] else ws[i] || ' ' || ws[i + 1] end as x
  from (select doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 1))) as i from d where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
rare as (select x from s group by x having count(*) > 1),
k as (select doc_id, x from s join rare using (x)),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from k a join k b on a.x = b.x and a.doc_id <> b.doc_id group by all),
l as (select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * p.k >= 80 * (x.n + y.n - p.k)),
r as (select doc_id, doc_id as reach from d union select r.doc_id, l.b from r join l on r.reach = l.a)
select d.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r.reach) as component_id, d.doc_id = min(r.reach) as kept
from d join r using (doc_id) left join n using (doc_id) group by d.doc_id
"""

VECTORS = """
with recursive e as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and not list_contains(list_transform(embedding, lambda x: x is null or not isfinite(x)), true)
    and list_contains(list_transform(embedding, lambda x: x <> 0), true)),
l as (select a.vec_id as a, b.vec_id as b from e a join e b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.9),
r as (select vec_id, vec_id as reach from embeddings union select r.vec_id, l.b from r join l on r.reach = l.a)
select vec_id, (select count(*) from l where l.a = r.vec_id)::bigint as n_links, min(reach)::bigint as component_id, vec_id = min(reach) as kept
from r group by vec_id
"""

SUBSTRINGS = rf"""
with d as (select doc_id, {words()} as ws from documents),
w as (select doc_id, i, ws[i] as word, len(ws) as n, ws from (select doc_id, ws, unnest(generate_series(1, len(ws))) as i from d)),
f as (select doc_id, i, array_to_string(ws[i:i + 19], ' ') as x from w where i + 19 <= n),
k as (select doc_id, i, row_number() over (partition by x order by doc_id, i) as nth from f),
g as (select distinct doc_id, unnest(generate_series(i, i + 19)) as i from k where nth > 1),
r as (
  select w.doc_id, count(g.i) as n_removed, coalesce(string_agg(case when g.i is null then w.word end, ' ' order by w.i), '') as kept
  from w left join g on w.doc_id = g.doc_id and w.i = g.i group by w.doc_id)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(r.n_removed, 0)::bigint as n_removed, sha256(coalesce(r.kept, '')) as kept_sha256
from d left join r using (doc_id)
"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Each round: the nearest entry for each part of each vector, then the floor of the mean of what it is nearest to."""
    near = """
a{n} as materialized (
  select row, part, entry, far from (
    select c.row, c.part, k.entry, sum((c.x - k.x) * (c.x - k.x))::bigint as far, row_number() over (partition by c.row, c.part order by sum((c.x - k.x) * (c.x - k.x)), k.entry) as nth
    from cells c join k{n} k on c.part = k.part and c.pos = k.pos group by c.row, c.part, k.entry)
  where nth = 1),"""
    step = """
k{m} as materialized (
  select k.part, k.entry, k.pos, coalesce(((s.x - ((s.x % s.n) + s.n) % s.n) // s.n)::bigint, k.x) as x
  from k{n} k left join (select a.part, a.entry, c.pos, sum(c.x) as x, count(*) as n from a{n} a join cells c on a.row = c.row and a.part = c.part group by all) s
    on k.part = s.part and k.entry = s.entry and k.pos = s.pos),"""
    turns = "".join(near.format(n=n) + step.format(n=n, m=n + 1) for n in range(rounds)) + near.format(n=rounds)
    return f"""
with v as materialized (
  select row_number() over (order by vec_id nulls last, embedding) as row, vec_id, label, embedding::double[] as v from embeddings
  where embedding is not null and not list_contains(list_transform(embedding, lambda x: x is null or not isfinite(x)), true)),
cells as materialized (
  select row, (i - 1) // (n // {parts}) as part, (i - 1) % (n // {parts}) as pos, floor({scale} * v[i])::bigint as x
  from (select row, v, len(v) as n, unnest(generate_series(1, len(v))) as i from v)),
k0 as materialized (select part, row - 1 as entry, pos, x from cells where row <= {entries}),{turns}
e as (select row, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(far)::bigint as error from a{rounds} group by row),
h as (select sha256(string_agg(x::varchar, ',' order by part, entry, pos)) as codebooks_sha256 from k{rounds})
select v.vec_id, e.code, e.error, sum(e.error) over (partition by v.label)::bigint as label_error, h.codebooks_sha256
from v join e on v.row = e.row cross join h
"""


CODES = _codes()

CASCADE = r"""
with recursive crc as (
  select list(n order by i) as t from (
    select i, list_reduce(list_prepend(i, generate_series(1, 8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as n
    from (select unnest(generate_series(0, 255))::bigint as i))),
r as (
  select row_number() over () as id, conv_id, turn, encode(coalesce(text, '')) as b, coalesce(conv_id::varchar, '') || ':' || coalesce(turn::varchar, '') as name from conversations),
m as (select id, 9 as k, b from r union all select id, g, encode(g::varchar || ':' || r.name) from r, unnest(generate_series(0, 8)) as u(g)),
h as (
  select id, k, xor(list_reduce(list_prepend(4294967295, list_transform(generate_series(1, octet_length(b)), lambda i: ('0x' || substr(hex(b), 2 * i - 1, 2))::bigint)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as n from m, crc),
w as (
  select r.id, conv_id, turn, max(n) filter (k = 9) as weight, max(n % 5) filter (k = 0) as back, max(n % 101) filter (k = 1) < 50 as faulty, max(n % 101) filter (k = 2) as wait,
    list(n % 3 <> 0 order by k) filter (k between 3 and 8) as lets
  from r join h using (id) group by all),
t as (
  select *, row_number() over (partition by conv_id order by turn nulls last, weight) - 1 as p, dense_rank() over (order by conv_id nulls first) as c from w),
f as (select *, 7 * p as arrival, 7 * p + wait as repaired from t),
run as (
  select c, -1::bigint as p, []::bigint[] as until, 0::bigint as begin, 0 as attempts from (select distinct c from f)
  union all
  select c, p, list_append(until, case when begin = 4611686018427387904 or nth is null then 4611686018427387904 else begin + 20 * (power(2, nth - 1)::bigint - 1) end), begin,
    case when begin = 4611686018427387904 then 0 else coalesce(nth, 6) end
  from (
    select *, case when not faulty then 1 else list_min(list_filter([1, 2, 3, 4, 5, 6], lambda a: lets[a] and begin + 20 * (power(2, a - 1)::bigint - 1) >= repaired)) end as nth
    from (
      select f.*, run.until, greatest(arrival, case when back > 0 and back <= f.p then run.until[f.p - back + 1] else 0 end) as begin
      from run join f on run.c = f.c and f.p = run.p + 1))),
o as (
  select f.conv_id, f.turn, f.p, f.weight, case when run.until[f.p + 1] < 4611686018427387904 then 'delivered' when run.attempts > 0 then 'dead' else 'blocked' end as status, run.attempts::int as attempts,
    case when run.attempts > 0 then run.begin end as first_at, case when run.attempts > 0 then run.begin + 20 * (power(2, run.attempts - 1)::bigint - 1) end as last_at
  from f join run on f.c = run.c and f.p = run.p),
n as (select *, case when status = 'delivered' then row_number() over (partition by conv_id, status order by last_at, turn, p) end as release_no from o)
select conv_id, turn, status, attempts, first_at, last_at, release_no,
  case when status = 'delivered' then sum(release_no * weight) over (partition by conv_id, status order by release_no) end::bigint as state
from n
"""
