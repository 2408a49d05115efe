"""DuckDB SQL for the training-data queries that SQL can express."""

#: Turns in order, their digests, and the length that the template and its escapes give.
OP1 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, length(regexp_replace(role, '(\\|</?turn>|<text>)', 'x\1', 'g'))
              + length(regexp_replace(text, '(\\|</?turn>|<text>)', 'x\1', 'g')) + 20 as n from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(n)::bigint as formatted_chars
from e group by conv_id
"""

#: Counts of every document, the base rules, the sketches of the measures, their fences and the verdict.
OP4 = r"""
with d as (
  select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
windows as (
  select rid, i, count(*) over (partition by rid, list_slice(w, i, i + 7)) as found
  from (select rid, w, unnest(range(1, len(w) - 6)) as i from d)),
covered as (
  select rid, sum(gap)::bigint as n
  from (select rid, least(8, coalesce(lead(i) over (partition by rid order by i) - i, 8)) as gap
        from windows where found > 1) group by rid),
s as (
  select d.rid, doc_id, lang, source, len(w)::bigint as n_words,
         length(coalesce(array_to_string(w, ''), ''))::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words
  from d left join covered c using (rid)),
b as (select *, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
             word_chars * 1000 // greatest(n_words, 1) as m1, n_symbols * 1000 // greatest(n_words, 1) as m2,
             n_dup_lines * 1000 // greatest(n_words, 1) as m3, n_repeat_words * 1000 // greatest(n_words, 1) as m4 from s),
v as (select lang, source, m, v from (
        select lang, source, unnest([1, 2, 3, 4]) as m, unnest([m1, m2, m3, m4]) as v from b where not base_failed)),
k as (select lang, source, m, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) as a from v),
grp as (select distinct lang, source, m from k),
ln as (select lang, m, a, count(*) as n from k group by all),
al as (select m, a, count(*) as n from k group by all),
parts as (
  select lang, source, m, a, count(*) as own, 0 as ln, 0 as al from k group by all
  union all select g.lang, g.source, g.m, x.a, 0, x.n, 0 from grp g join ln x on x.lang is not distinct from g.lang and x.m = g.m
  union all select g.lang, g.source, g.m, x.a, 0, 0, x.n from grp g join al x on x.m = g.m),
sums as (select lang, source, m, a, sum(own)::hugeint as own, sum(ln)::hugeint as ln, sum(al)::hugeint as al from parts group by all),
sized as (select *, (sum(ln) over g)::hugeint as lt, (sum(al) over g)::hugeint as at_all from sums window g as (partition by lang, source, m)),
levels as (select lang, source, m, a, own * lt * at_all + 50 * ln * at_all + 50 * al * lt as n from sized),
ranked as (select *, sum(n) over (partition by lang, source, m) as total,
                  sum(n) over (partition by lang, source, m order by a) as upto from levels),
q as (select lang, source, m, min(case when 4 * upto >= total then a end) as q1,
             min(case when 4 * upto >= 3 * total then a end) as q3 from ranked group by all),
f as (select *, 4 * greatest(q3 - q1, [500, 50, 20, 75][m]) as reach from q),
fences as (select lang, source, max(case when m = 1 then q1 - reach end) as lo,
                  max(case when m = 1 then q3 + reach end) as h1, max(case when m = 2 then q3 + reach end) as h2,
                  max(case when m = 3 then q3 + reach end) as h3, max(case when m = 4 then q3 + reach end) as h4
           from f group by all),
picked as (
  select b.*, g from b left join fences g on g.lang is not distinct from b.lang and g.source is not distinct from b.source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(m1 between g.lo and g.h1 and m2 <= g.h2 and m3 <= g.h3 and m4 <= g.h4, true) as kept
from picked
"""

#: Targets by source, copies by size class, Pareto ranks and the cut of each source by a sorted running sum.
OP5 = r"""
with d as (
  select doc_id, source, size, length(bin(size)) as c
  from (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents)),
s0 as (select source, sum(size)::bigint as ss from d group by source),
s1 as (select *, row_number() over (order by source nulls last) as i, sum(ss) over () as total from s0),
s2 as (select *, [1, 2, 3][(i - 1) % 3 + 1] as w, 3 * ss as cap from s1),
s3 as (select *, (total - coalesce(sum(cap) over o, 0))::double * w >=
                 cap::double * (sum(w) over () - coalesce(sum(w) over o, 0)) as is_full
       from s2 window o as (order by cap / w, cap, i rows between unbounded preceding and 1 preceding)),
goal as (select source, ss, case when is_full then cap::double else
           (total - coalesce(sum(case when is_full then cap end) over (), 0))::double * w
           / sum(case when not is_full then w end) over () end as target from s3),
c1 as (select d.source, c, sum(size)::bigint as words, any_value(target) as target from d
       join goal g on g.source is not distinct from d.source group by d.source, c having sum(size) > 0),
c2 as (select *, words * (1000 + 1000 // (1 + c)) as w, 3 * words as cap from c1),
c3 as (select *, (target - coalesce(sum(cap) over o, 0))::double * w >=
                 cap::double * (sum(w) over (partition by source) - coalesce(sum(w) over o, 0)) as is_full
       from c2 window o as (partition by source order by cap / w, cap, c rows between unbounded preceding and 1 preceding)),
c4 as (select *, case when is_full then cap::double else
           (target - coalesce(sum(case when is_full then cap end) over (partition by source), 0))::double * w
           / sum(case when not is_full then w end) over (partition by source) end as share from c3),
rate as (select source, c, words, target, floor(least(share / words, 3.0))::bigint as whole,
                least(share / words, 3.0::double) - floor(least(share / words, 3.0::double)) as p from c4),
need as (select source, max(target) - sum(whole * words) as need from rate group by source having max(target) - sum(whole * words) > 0),
u as (select d.*, whole, p, (('0x' || substr(md5('42:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint + 0.5::double) / 4503599627370496 as u
      from d left join rate r on r.source is not distinct from d.source and r.c = d.c),
r as (select *, case when p > 0 and size > 0 then floor(1073741824.0::double * (u * (1 - p)) / (u * (1 - p) + p * (1 - u)))::bigint end as rk from u),
k as (select source, rk, sum(size)::bigint as here from r where rk is not null group by source, rk),
run as (select k.*, need, sum(here) over (partition by k.source order by rk) as upto
        from k join need n on n.source is not distinct from k.source),
cut as (select source, max(rk) filter (upto - here < need and upto - here / 2.0 <= need) as cut from run group by source)
select r.doc_id, r.size, g.ss as source_size, g.target,
       (case when r.size > 0 then r.whole + case when r.rk <= x.cut then 1 else 0 end else 0 end * r.size)::bigint as taken
from r join goal g on g.source is not distinct from r.source
left join cut x on x.source is not distinct from r.source
"""

#: Base 32 from the hex digest, five bytes at a time; of equal payloads the largest page_id is the response.
OP7 = r"""
with p as (select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages),
f as (select *, max(page_id) over (partition by h) as first from p)
select page_id, strlen(t)::bigint as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, ((i // 8) * 10 + 1)::int, 10))::bigint >> (35 - 5 * (i % 8))::int) & 31) + 1)::int, 1)), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to, null::varchar as fault
from f
"""

#: The article of a page by patterns: blocks end at paragraph and heading tags; references of the pages' texts are decoded.
OP3 = r"""
with a as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) as t from pages),
b as (select page_id, url, list_filter(list_transform(regexp_split_to_array(t, '</?(?:p|h1)(?:\s[^>]*)?>'), lambda x:
        trim(regexp_replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]+>', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))),
        lambda x: x <> '') as blocks from a),
d as (select page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(array_to_string(blocks, chr(10)),
        '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') as text from b)
select page_id, url, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n_chars from d
"""


def _op8() -> str:
    """Hosts, paths and rules, then one level of the template tree after the other."""
    from .queries import RULES
    from .url_filter import LOWER, MAX_DEPTH, MIN_LABELS, REJECT, SMOOTHING, UPPER, Z
    fits = []
    for says, text in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits.append((f"(host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '/{rest}')", says, text))
    rule = "case " + " ".join(f"when {f} then '{t}'" for f, _, t in fits) + " end"
    says = "case " + " ".join(f"when {f} then '{v}'" for f, v, _ in fits) + " end"
    parts = [f"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r as (select *, {rule} as rule, {says} as says from h),
lab as (select doc_id, max((quality = 0 or toxic = 1)::int) as bad from labels where doc_id is not null and (quality = 0 or toxic = 1) is not null group by doc_id),
p as (select host, path, count(lab.bad) as labelled, coalesce(sum(lab.bad), 0)::bigint as bad from r left join lab on lab.doc_id = r.page_id group by host, path),
s as (select *, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: regexp_replace(x, '[0-9]+', '*', 'g')) as sg from p),
n0 as (select host, path, labelled, bad, '' as prefix, least(len(sg), {MAX_DEPTH + 1}) as depth,
  case when len(sg) > {MAX_DEPTH} then list_concat(sg[1:{MAX_DEPTH}], ['**']) else sg end as sg from s)"""]
    for k in range(MAX_DEPTH + 1):
        parts.append(f"""
b{k} as (select host, depth, prefix, sg[{k + 1}] as branch, sum(labelled) as n, sum(bad) as b from n{k} where depth > {k} group by all),
t{k} as (select host, depth, prefix, count(*) as k, sum(n) as an, sum(b) as ab from b{k} group by all),
d{k} as (select host, depth, prefix, branch, case when k = 1 or (n >= {MIN_LABELS} and abs((b + 0.5::double) / (n + 1) - (ab - b + 0.5::double) / (an - n + 1))
  > {Z}::double * sqrt((ab + 0.5::double) / (an + 1) * (1 - (ab + 0.5::double) / (an + 1)) * (1::double / (n + 1) + 1::double / (an - n + 1)))) then branch else '*' end as name
  from b{k} join t{k} using (host, depth, prefix)),
n{k + 1} as (select host, path, labelled, bad, prefix || '/' || d.name as prefix, depth, sg from n{k} x join d{k} d using (host, depth, prefix)
  where x.depth > {k} and d.branch = x.sg[{k + 1}]
  union all select host, path, labelled, bad, prefix, depth, sg from n{k} where depth <= {k})""")
    last = MAX_DEPTH + 1
    parts.append(f"""
t as (select host, path, host || case when prefix = '' then '/' else prefix end as template, labelled, bad from n{last}),
prior as (select coalesce(sum(bad)::double / nullif(sum(labelled), 0), 0) as q from t),
pur as (select template, (sum(bad) + {SMOOTHING}::double * any_value(q)) / (sum(labelled) + {SMOOTHING}::double) as purity from t, prior group by template)""")
    return ",".join(parts) + f"""
select r.page_id, r.host, r.path, r.rule, coalesce(r.says, case when pur.purity >= {REJECT} then 'block' else 'allow' end) as verdict, t.template, pur.purity
from r join t on t.host = r.host and t.path = r.path join pur on pur.template = t.template
"""


#: All pairs of vectors, and the ids that can be reached from each.
OP10 = """
with recursive v as (
  select row_number() over () as r, vec_id, embedding::double[] as e,
         coalesce(len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
                  and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as good from embeddings),
l as (select a.r as x, b.r as y from v a join v b on a.good and b.good and a.r <> b.r and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= 0.95),
c as (select r, vec_id as c from v union select l.y, c.c from c join l on l.x = c.r),
m as (select r, min(c) as component_id from c group by r)
select v.vec_id, (select count(*) from l where l.x = v.r)::bigint as n_links, m.component_id, v.vec_id = m.component_id as kept
from v join m on m.r = v.r
"""

#: Keys of all lines, their smallest ids, and the lines that stay.
OP11 = r"""
with d as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
x as (select rid, doc_id, unnest(range(1, len(l) + 1)) as i, unnest(l) as line from d),
k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from x),
r as (select key, min(doc_id) as first from k where length(key) >= 10 group by key
      having min(doc_id) <> max(doc_id) or count(*) > count(doc_id) and min(doc_id) is not null),
f as (select k.*, coalesce(k.doc_id <> r.first, r.first is not null) as gone from k left join r using (key))
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from f group by rid
"""

#: CRC-32 (unsigned) of ASCII text, as a table of the 256 bytes and a fold.
CRC_TABLE = """crc as (
  select list(v order by i) as t from (
    select i, list_reduce(range(0, 8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, i) as v
    from (select unnest(range(0, 256)) as i)))"""


def _crc32(text: str) -> str:
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint), "
            "lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295), 4294967295)")


#: Planted words, pairs of equal 5-grams a lag apart, their islands as stretches, and those without a smaller period.
OP12 = r"""
with """ + CRC_TABLE + r""",
s as (
  select row_number() over () as rid, doc_id, case when doc_id is null then 1 else """ + _crc32("doc_id::varchar") + r""" end as h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents, crc),
m as (select *, len(w) as n, case when len(w) > 0 then (h // 10) % len(w) end as a from s),
d as (select rid, doc_id, n,
             case when h % 10 = 0 and n > 0
                  then list_transform(range(0, n), lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) end])
                  else w end as w from m),
g as (select rid, n, i, array_to_string(list_slice(w, i + 1, i + 5), ' ') as x from (select rid, n, w, unnest(range(0, n - 4)) as i from d)),
e as (select l.rid, r.i - l.i as q, l.i - row_number() over (partition by l.rid, r.i - l.i order by l.i) as island, l.i
      from g l join g r on l.rid = r.rid and l.x = r.x and r.i > l.i and 4 * (r.i - l.i) <= l.n),
p as (select rid, q, min(i) as start, max(i) + 5 + q - min(i) as length from e group by rid, q, island),
r as (select * from p where length >= greatest(6, 4 * q) and not exists (
        select 1 from p as o where o.rid = p.rid and o.q < p.q and o.start <= p.start and o.start + o.length >= p.start + p.length)),
dropped as (select distinct rid, i from (select rid, unnest(range(start + q, start + length)) as i from r)),
kept as (select rid, string_agg(w[i + 1], ' ' order by i) as t
         from (select rid, w, unnest(range(0, n)) as i from d) anti join dropped using (rid, i) group by rid),
best as (select rid, count(*) as n_runs, min(struct_pack(rest := -length, start := start, q := q)) as b,
                string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) as lines from r group by rid)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, b.start::bigint as start, (-b.rest)::bigint as length, b.q::bigint as period,
       (-b.rest * 1000 // b.q)::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
       sha256(coalesce(t, '')) as collapsed_sha256
from d left join best using (rid) left join kept using (rid)
"""



def _op13() -> str:
    """Damage, faults, and a fold over each conversation's rows that keeps the least (cost, audit) of each state as text."""
    def plus(state: str, cost: str, edit: str) -> str:
        return f"lpad((left({state}, 9)::int + {cost})::varchar, 9, '0') || substr({state}, 10) || '{edit}'"

    def step(sources: list[int], initial: str) -> list[str]:
        keep = [f"case when x[1] = '{initial}' and x[2] <> 'out' then {plus(f's[{p}]', 'x[3]::int', 'K')} end" for p in sources]
        rerole = [f"case when x[2] <> 'out' then {plus(f's[{p}]', '3 + x[3]::int', 'R')} end" for p in sources]
        return keep + (rerole if initial != "s" else [])

    # states 1..4: nothing yet, after s, after u, after a
    edits = [[plus(f"s[{q}]", "4", "D")] + more for q, more in ((1, []), (2, step([1], "s")), (3, step([1, 2, 4], "u")), (4, step([3], "a")))]
    edit = "[" + ", ".join(f"least({', '.join(e)}, null)" for e in edits) + "]"
    insert = ("[s[1], s[2], least(s[3], " + ", ".join(plus(f"s[{p}]", "3", "I") for p in (1, 2, 4)) + "), least(s[4], "
              + plus("s[3]", "3", "I") + ", " + ", ".join(plus(f"s[{p}]", "6", "II") for p in (1, 2)) + ")]")
    blank = r"[\x20\x09-\x0D]"
    return f"""
with {CRC_TABLE},
c as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
             {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations, crc),
w as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
             case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
             unnest(range(0, case when kind = 3 then 2 else 1 end)) as copy from c where kind <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i from w),
b as (select *, left(role, 1) as initial, lead(left(role, 1)) over (partition by conv_id order by i) as follower,
             regexp_replace(text, '{blank}+$', '') as body, row_number() over (partition by conv_id, role, text order by i) as seen from o),
f as (select *, case when body = '' then 'blank' when seen > 1 then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from b),
p as (select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (fault = 'blank') as blank,
             count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
             count(*) filter (follower is not null and initial || follower not in ('su', 'ua', 'au')) as illegal,
             list(role order by i) as roles, list(text order by i) as texts,
             list([initial, case when fault in ('blank', 'duplicate') then 'out' else 'in' end, case when fault = 'truncated' then '3' else '0' end] order by i) as rows
      from f group by conv_id),
z as (select *, list_reduce(flatten(list_transform(rows, lambda r: [r, ['I']])),
                            lambda s, x: case when x[1] = 'I' then {insert} else {edit} end,
                            ['000000000', null, '000000003I', '000000006II']) as s from p),
e as (select *, substr(least(s[1], s[4]), 10) as audit, left(least(s[1], s[4]), 9)::bigint as cost from z),
l as (select conv_id, roles, texts, i, audit[i] as edit, i - length(replace(audit[:i], 'I', '')) as inserted,
             length(replace(audit[:i], 'D', '')) as place, length(replace(audit, 'D', '')) as n from (select *, unnest(range(1, length(audit) + 1)) as i from e)),
t as (select conv_id, string_agg(case when edit = 'K' then roles[i - inserted] when (place + n) % 2 = 1 then 'user' else 'assistant' end || ':'
                                 || case when edit = 'I' then '' else texts[i - inserted] end, chr(10) order by i) as repaired
      from l where edit <> 'D' group by conv_id),
every as (select distinct conv_id from conversations)
select every.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
       coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from every left join e on e.conv_id is not distinct from every.conv_id left join t on t.conv_id is not distinct from every.conv_id
"""


SQL: dict[str, str] = {
    "op1_chat_format": OP1,
    "op3_html_extraction": OP3,
    "op4_quality_rules": OP4,
    "op5_mixing": OP5,
    "op7_warc": OP7,
    "op8_url_filters": _op8(),
    "op10_embedding_near_dedup": OP10,
    "op11_line_dedup": OP11,
    "op12_periodic_runs": OP12,
    "op13_conversation_repair": _op13(),
}
