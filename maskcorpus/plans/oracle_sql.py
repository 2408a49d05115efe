"""DuckDB SQL twins of the registered queries (the driver's correctness oracle).

Each text inlines the derived views of ``plans.fixtures`` as CTEs and computes
the same result relationally and independently of the Spark code path.
"""

from __future__ import annotations

from maskcorpus.config import MASK_TOKEN, PY_WHITESPACE_CLASS
from maskcorpus.plans.fixtures import VIEWS, with_views

WS = PY_WHITESPACE_CLASS


def py_split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda t: t <> '')"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{WS}+|{WS}+\\z', '', 'g')"


def mask_line(x: str, keywords=("elif", "if"), term: str = ":", mask: str = MASK_TOKEN) -> str:
    arms = []
    for kw in keywords:
        p = f"instr({x}, '{kw}')"
        after = f"substring({x}, {p} + {len(kw)})"
        c = f"instr({after}, '{term}')"
        arms.append(f"when {p} > 0 and {c} > 0 then concat(substring({x}, 1, {p} - 1), '{kw} {mask}', substring({after}, {c}))")
    return "case " + " ".join(arms) + " end"


def span(x: str, keywords, term: str) -> str:
    arms = []
    for kw in keywords:
        p = f"instr({x}, '{kw}')"
        after = f"substring({x}, {p} + {len(kw)})"
        c = f"instr({after}, '{term}')"
        arms.append(f"when {p} > 0 and {c} > 0 then substring({after}, 1, {c} - 1)")
    return "case " + " ".join(arms) + " end"


def seeded(seed: int, *parts: str) -> str:
    inner = ", ':', ".join(f"cast({p} as string)" for p in parts)
    return f"sha256(concat('{seed}', ':', {inner}))"


def hash_bucket(seed: int, key: str) -> str:
    return f"(('0x' || substring({seeded(seed, key)}, 1, 8))::bigint % 10000)"


SQL: dict[str, str] = {}

SQL["function_ids"] = with_views("code_functions") + """
select func_no, sha256(concat(cast(row_number() over (order by func_no) - 1 as string), ':', substring(code, 1, 100))) as id
from code_functions
"""

# functions with their id (position among functions that have ifs) and if list
_FUNCS = """,
funcs as (
  select f.func_no, f.code, sha256(concat(cast(row_number() over (order by f.func_no) - 1 as string), ':', substring(f.code, 1, 100))) as fid
  from code_functions f where f.func_no in (select func_no from code_ifs)
)
"""

SQL["example_ids"] = with_views("code_functions", "code_ifs") + _FUNCS + """
select f.func_no, c.line, f.fid as func_id, sha256(concat(f.fid, ':', cast(c.line as string))) as id
from funcs f join code_ifs c on f.func_no = c.func_no
"""

SQL["line_stats"] = with_views("code_functions", "code_ifs") + """
select f.func_no, cast(len(string_split(f.code, chr(10))) as int) as lines, cast(coalesce(n.num_ifs, 0) as int) as num_ifs
from code_functions f left join (select func_no, count(*) as num_ifs from code_ifs group by func_no) n on f.func_no = n.func_no
"""

SQL["token_split"] = f"""
with t as (select doc_id, {py_split('text')} as tokens from documents)
select doc_id, cast(len(tokens) as int) as n_tokens, sha256(array_to_string(tokens, ' ')) as tokens_sha,
 tokens[1] as first_token, tokens[len(tokens)] as last_token
from t
"""

SQL["min_token_filter"] = f"""
with t as (select doc_id, len({py_split('text')}) as n_tokens from documents)
select doc_id, cast(n_tokens as int) as n_tokens from t where n_tokens >= 10
"""

SQL["explode_ifs"] = with_views("code_ifs") + """
select func_no, cast(row_number() over (partition by func_no order by line) - 1 as int) as if_ord, condition, line, depth
from code_ifs
"""

SQL["mask_conditions"] = with_views("code_functions", "code_ifs") + _FUNCS + f""",
x as (
  select f.func_no, f.fid, c.line, c.condition, string_split(f.code, chr(10)) as lines
  from funcs f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines))
select sha256(concat(fid, ':', cast(line as string))) as id, fid as func_id, func_no, line,
 array_to_string(list_transform(lines, lambda s, i: case when i = line then masked else s end), chr(10)) as input,
 {py_strip('condition')} as target
from y where masked is not null
"""

SQL["mask_after_keyword"] = f"""
with l as (select doc_id, string_split(text, chr(10)) as ls from documents),
e as (select doc_id, ls, unnest(range(1, len(ls) + 1)) as line from l),
m as (select doc_id, line, ls[line] as tl from e)
select doc_id, cast(line as int) as line, {mask_line('tl', ('and', 'the'), ',')} as masked_line,
 {py_strip(span('tl', ('and', 'the'), ','))} as span
from m where ({mask_line('tl', ('and', 'the'), ',')}) is not null
"""

SQL["shuffle_index"] = with_views("code_functions") + f"""
select func_no, row_number() over (order by {seeded(42, 'func_no')}, func_no) - 1 as shuffle_idx
from code_functions
"""

SQL["split_hash"] = with_views("code_functions") + f"""
select func_no, case when {hash_bucket(42, 'func_no')} < 8000 then 'train'
 when {hash_bucket(42, 'func_no')} < 9000 then 'val' else 'test' end as split
from code_functions
"""

_DOC_TOKENS = f"""
with t as (select doc_id, {py_split('text')} as tokens from documents),
t10 as (select doc_id, tokens, len(tokens) as n from t where len(tokens) >= 10),
e as (select doc_id, n, unnest(tokens) as tok, unnest(range(len(tokens))) as pos from t10),
s32 as (select *, ('0x' || substring(sha256(concat('42:', cast(doc_id as string))), 1, 8))::bigint as seed32 from e),
h1 as (select *, (xor(xor(seed32, pos) >> 16, xor(seed32, pos)) * 73244475) % 4294967296 as x1 from s32),
h2 as (select *, (xor(x1 >> 16, x1) * 73244475) % 4294967296 as x2 from h1),
r as (select *, row_number() over (partition by doc_id order by xor(x2 >> 16, x2), pos) as rk,
 greatest(1, n * 15 // 100) as k from h2),
m as (select *, rk <= k as masked from r),
o as (select *, case when masked then sum(case when masked then 1 else 0 end) over (partition by doc_id order by pos rows between unbounded preceding and current row) - 1 end as ord from m)
"""

SQL["sample_positions"] = _DOC_TOKENS + """
select doc_id, cast(max(n) as int) as n_tokens, cast(count(*) filter (where masked) as int) as n_masks,
 string_agg(case when masked then cast(pos as string) end, ',' order by pos) as positions
from o group by doc_id
"""

SQL["corrupt_tokens"] = _DOC_TOKENS + """
select doc_id,
 string_agg(case when masked then concat('<extra_id_', cast(ord as string), '>') else tok end, ' ' order by pos) as input,
 string_agg(case when masked then concat('<extra_id_', cast(ord as string), '> ', tok) end, ' ' order by pos) as target
from o group by doc_id
"""

SQL["split_counts"] = with_views("code_functions") + f""",
s as (select func_no, row_number() over (order by {seeded(42, 'func_no')}, func_no) - 1 as idx from code_functions)
select func_no, case when idx < (select count(*) from s) * 35 // 100 then 'pretrain'
 when idx < (select count(*) from s) * 35 // 100 + (select count(*) from s) * 15 // 100 then 'finetune' else 'unused' end as split from s
"""

_EXAMPLES = with_views("code_functions", "code_ifs") + _FUNCS + f""",
x as (
  select f.func_no, f.fid, c.line, c.condition, string_split(f.code, chr(10)) as lines
  from funcs f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines)),
ex as (select sha256(concat(fid, ':', cast(line as string))) as id from y where masked is not null),
s as (select id, row_number() over (order by {seeded(42, 'id')}, id) - 1 as idx, count(*) over () as n from ex),
sp as (select id, case when idx < floor(cast(n as double) * 0.8) then 'train'
 when idx < floor(cast(n as double) * 0.8) + floor(cast(n as double) * 0.1) then 'val' else 'test' end as split from s)
"""

SQL["split_80_10_10"] = _EXAMPLES + "select id, split from sp\n"

SQL["split_sizes"] = _EXAMPLES + "select split, count(*) as n from sp group by split\n"

SQL["holdout_95_5"] = f"""
with t as (select doc_id, {py_split('text')} as tokens from documents),
s as (select doc_id, row_number() over (order by {seeded(42, 'doc_id')}, doc_id) - 1 as idx, count(*) over () as n
 from t where len(tokens) >= 10)
select doc_id, case when idx < ceil(cast(n as double) * 0.05) then 'test' else 'train' end as split from s
"""

SQL["masking_success_rate"] = with_views("code_functions", "code_ifs") + _FUNCS + f""",
x as (
  select f.func_no, c.line, string_split(f.code, chr(10)) as lines
  from funcs f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines)),
a as (select (select count(*) from x) as n_ifs, (select count(*) from y where masked is not null) as n_examples)
select n_ifs, n_examples, coalesce(n_examples / nullif(cast(n_ifs as double), 0), 0.0) as rate from a
"""

SQL["catalog_pages"] = with_views("repo_catalog") + """
select cast(floor(repo_key / 100) as bigint) as page,
 cast(row_number() over (partition by floor(repo_key / 100) order by repo_key) - 1 as int) as item_ord,
 owner, repo, html_url, language, stars, fork, archived, license, default_branch
from repo_catalog
"""

_FILTERED = with_views("repo_catalog") + """,
b1 as (select * from repo_catalog where language = 'Python' and stars >= 10 and not fork and not archived),
b2 as (select * from b1 where license in ('MIT', 'Apache-2.0', 'BSD-3-Clause', 'BSD-2-Clause', 'ISC')),
b3 as (select repo_key, stars, owner, repo, html_url, license, coalesce(default_branch, 'main') as default_branch from b2),
c1 as (select *, row_number() over (order by stars desc, repo_key) as repo_rank from b3 qualify repo_rank <= 500)
"""

SQL["catalog_filter"] = _FILTERED + "select * from b1\n"
SQL["license_filter"] = _FILTERED + "select * from b2\n"
SQL["repo_projection"] = _FILTERED + "select * from b3\n"
SQL["top_repos"] = _FILTERED + "select * from c1\n"

SQL["repo_function_counts"] = with_views("repo_functions") + """
select repo_key, count(*) as n_functions from repo_functions group by repo_key
"""

_TAKE = _FILTERED + """,
code_functions as (""" + with_views("code_functions").split(" as (", 1)[1].rsplit(")", 1)[0] + """),
repo_functions as (select func_no, cast(floor(sqrt(func_no)) as bigint) as repo_key from code_functions),
cnt as (select repo_key, count(*) as n_functions from repo_functions group by repo_key),
g as (select c1.repo_rank, c1.repo_key, coalesce(cnt.n_functions, 0) as n_functions from c1 left join cnt on c1.repo_key = cnt.repo_key),
sums as (select *, coalesce(sum(n_functions) over (order by repo_rank rows between unbounded preceding and 1 preceding), 0) as functions_before from g),
cut as (select * from sums where functions_before < (select sum(n_functions) // 3 from g))
"""

SQL["take_until_target"] = _TAKE + """
select repo_rank, repo_key, n_functions, cast(functions_before as bigint) as functions_before from cut
"""

SQL["functions_until_target"] = _TAKE + """
select func_no, repo_key from repo_functions where repo_key in (select repo_key from cut)
"""

_SCORED = with_views("code_functions", "code_ifs", "if_predictions") + _FUNCS + f""",
x as (
  select f.func_no, f.fid, c.line, c.condition, string_split(f.code, chr(10)) as lines
  from funcs f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines)),
ex as (select sha256(concat(fid, ':', cast(line as string))) as id, func_no, line, {py_strip('condition')} as target
 from y where masked is not null),
sc as (select ex.id, ex.target, p.prediction,
 coalesce(lower({py_strip('p.prediction')}) = lower({py_strip('ex.target')}), false) as correct
 from ex left join if_predictions p on ex.func_no = p.func_no and ex.line = p.line)
"""

SQL["score_predictions"] = _SCORED + "select * from sc\n"

SQL["exact_match_metrics"] = _SCORED + """
select count(*) filter (where correct) as exact_match, count(*) as total,
 coalesce(count(*) filter (where correct) / nullif(cast(count(*) as double), 0), 0.0) as accuracy from sc
"""

SQL["extract_functions"] = with_views("code_functions", "code_ifs", "code_files") + """,
n as (select func_no, cast(count(*) as int) as num_ifs from code_ifs group by func_no),
r as (
  select f.file_no, case when f.file_no % 3 = 2 then 1 else 0 end as fn_ord,
   case when f.file_no % 3 = 0 then c.code else replace(c.code, chr(10), concat(chr(10), '    ')) end as code, n.num_ifs
  from code_files f join code_functions c on c.func_no = f.file_no join n on n.func_no = f.file_no
  union all
  select f.file_no, 0, f.code, n.num_ifs from code_files f join n on n.func_no = f.file_no where f.file_no % 3 = 2
)
select file_no, cast(fn_ord as int) as fn_ord, code, num_ifs, cast(len(string_split(code, chr(10))) as int) as lines from r
"""

SQL["extract_ifs"] = with_views("code_file_ifs") + """
select file_no, cast(fn_ord as int) as fn_ord, line, depth, condition from code_file_ifs
"""

_BENCH = with_views("benchmark_code") + """,
bex as (
  select item_id, concat('def g', cast(item_id as string), '(x):', chr(10), '    if <extra_id_0>:', chr(10), '        if x < 0:', chr(10), '            return 1', chr(10), '    return 0',
   chr(10), '# ', replace(text, chr(10), concat(chr(10), '# ')), chr(10), 'done()') as input,
   concat('x > ', cast(item_id * 7 % 89 as string)) as target
  from benchmark where item_id % 4 = 0
  union all
  select item_id, concat('value = compute()', chr(10), 'if <extra_id_0>:', chr(10), '    print(value)',
   chr(10), '# ', replace(text, chr(10), concat(chr(10), '# ')), chr(10), 'done()'),
   concat('value == ', cast(item_id as string))
  from benchmark where item_id % 4 = 1
)
"""

SQL["mask_benchmark_first_if"] = _BENCH + "select * from bex\n"

_TWO = _SCORED.rstrip() + "," + with_views("benchmark_predictions").replace("with ", "", 1) + "," + \
    _BENCH.replace("with ", "", 1) + f""",
bsc as (select coalesce(lower({py_strip('p.prediction')}) = lower({py_strip('b.target')}), false) as correct
 from bex b left join benchmark_predictions p on b.item_id = p.item_id),
allsc as (select 'generated_testset' as testset, correct from sc union all select 'provided_testset', correct from bsc),
m as (select testset, count(*) filter (where correct) as exact_match, count(*) as total from allsc group by testset)
"""

SQL["evaluate_two_testsets"] = _TWO + """
select testset, exact_match, total, coalesce(exact_match / nullif(cast(total as double), 0), 0.0) as accuracy from m
"""

SQL["metrics_json"] = _TWO + """,
mm as (select testset, {'accuracy': coalesce(exact_match / nullif(cast(total as double), 0), 0.0), 'exact_match': exact_match, 'total': total} as s from m)
select to_json({'generated_testset': (select s from mm where testset = 'generated_testset'),
                'provided_testset': (select s from mm where testset = 'provided_testset')})::varchar as metrics_json
"""

# ---- vocabulary (J1-J5) ------------------------------------------------------
# The byte-level pre-tokenizer ends with "\s+(?!\S)|\s+". RE2 has no lookahead, so
# pre-tokens are matched with a greedy whitespace alternative and then fixed up:
# a whitespace run of two or more characters that precedes a token gives up its
# last character, which becomes its own token or, when it is a space, the prefix
# of the next token. This equals the lookahead pattern except for a contraction
# right after such a run ("  's"), which no fixture holds. NFKC is not applied:
# no fixture text changes under it. The Spark side is unit-tested against the
# tokenizers library for both.


def _byte_table_sql() -> str:
    from maskcorpus.functions.bytelevel import byte_to_char
    return "[" + ", ".join("'" + c.replace("'", "''") + "'" for c in byte_to_char()) + "]"


_PRETOKEN_RE2 = (r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\x{09}-\x{0d}\x{85}\p{Z}\p{L}\p{N}]+|"
                 r"[\x{09}-\x{0d}\x{85}\p{Z}]+")


def _byte_level_sql(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(hex(encode({x})), '..'), "
            f"lambda h: ({_byte_table_sql()})[('0x' || h)::int + 1]), '')")


_WSC = r"[\x{09}-\x{0d}\x{85}\p{Z}]"


def _fixup_sql(toks: str) -> str:
    """Lookahead emulation over a materialised list of greedy pre-tokens (see the note above)."""
    return f"""flatten(list_transform({toks}, lambda t, i:
  case when regexp_full_match(t, '{_WSC}{{2,}}') and i < len({toks}) then
         case when right(t, 1) = ' ' then [left(t, length(t) - 1)] else [left(t, length(t) - 1), right(t, 1)] end
       when i > 1 and regexp_full_match({toks}[i - 1], '{_WSC}{{2,}}') and right({toks}[i - 1], 1) = ' ' then [' ' || t]
       else [t] end))"""


_WORDS = f"""
with raw0 as (select regexp_extract_all(text, '{_PRETOKEN_RE2}') as toks from documents),
raw as (select unnest({_fixup_sql('toks')}) as w from raw0),
words as (select {_byte_level_sql('w')} as word, count(*) as n from raw group by w)
"""

SQL["word_frequencies"] = _WORDS + "select word, n from words\n"

SQL["pair_counts"] = _WORDS + """,
c as (select n, regexp_extract_all(word, '.') as cs from words where length(word) >= 2),
p as (select n, cs, unnest(range(1, len(cs))) as i from c)
select cs[i] as "left", cs[i + 1] as "right", cast(sum(n) as bigint) as n from p group by cs[i], cs[i + 1]
"""


def _bpe_chain(merges: int) -> str:
    """CTE chain: alphabet ids, the word table as <id> strings, then one materialised round per merge."""
    from maskcorpus.config import SPECIAL_TOKENS
    n_sp = len(SPECIAL_TOKENS)
    parts = [_WORDS.rstrip(), f""",
chars as (select distinct unnest(regexp_extract_all(word, '.')) as c from words),
alpha as (select c as token, cast({n_sp - 1} + row_number() over (order by c) as int) as id from chars),
wc as (select word, n, unnest(regexp_extract_all(word, '.')) as c, unnest(range(length(word))) as pos from words),
w0 as materialized (select wc.word, any_value(wc.n) as n, string_agg('<' || cast(a.id as string) || '>', '' order by wc.pos) as s
  from wc join alpha a on a.token = wc.c group by wc.word),
base as (select count(*) as n_alpha from alpha),
tok0 as materialized (select token, id from alpha)"""]
    for k in range(merges):
        parts.append(f""",
x{k} as (select n, regexp_extract_all(s, '<([0-9]+)>', 1) as ids from w{k} where s like '%><%'),
y{k} as (select n, ids, unnest(range(1, len(ids))) as i from x{k}),
p{k} as materialized (select cast(ids[i] as int) as a, cast(ids[i + 1] as int) as b, sum(n) as cnt from y{k} group by all),
t{k} as materialized (select a, b, cnt, (select n_alpha from base) + {n_sp + k} as new_id from p{k} order by cnt desc, a, b limit 1),
m{k} as materialized (select {k} as rank, t.a, t.b, t.cnt, t.new_id, la.token as "left", ra.token as "right"
  from t{k} t join tok{k} la on la.id = t.a join tok{k} ra on ra.id = t.b),
tok{k + 1} as materialized (select token, id from tok{k} union all select "left" || "right", new_id from m{k}),
w{k + 1} as materialized (select w.word, w.n, replace(w.s, '<' || cast(m.a as string) || '><' || cast(m.b as string) || '>',
  '<' || cast(m.new_id as string) || '>') as s from w{k} w, m{k} m)""")
    return "".join(parts) + "\n"


SQL["bpe_merges_8"] = _bpe_chain(8) + " union all ".join(
    f'select cast(rank as int) as rank, "left", "right", cast(cnt as bigint) as pair_count from m{k}' for k in range(8)) + "\n"

_SPECIALS_SQL = "select * from (values " + ", ".join(
    f"('{t}', {i})" for i, t in enumerate(__import__("maskcorpus.config", fromlist=["x"]).SPECIAL_TOKENS)) + ") v(token, id)"

SQL["vocab_ids"] = _bpe_chain(8) + f"""
select token, cast(id as int) as id from ({_SPECIALS_SQL}) union all select token, cast(id as int) from tok8
"""

SQL["encode_words"] = _bpe_chain(8) + """
select word, array_to_string(regexp_extract_all(s, '<([0-9]+)>', 1), ',') as ids from w8
"""

_FILL = _EXAMPLES.replace(
    "ex as (select sha256(concat(fid, ':', cast(line as string))) as id from y where masked is not null)",
    f"ex as (select sha256(concat(fid, ':', cast(line as string))) as id, {py_strip('condition')} as target,\n"
    " array_to_string(list_transform(lines, lambda s, i: case when i = line then masked else s end), chr(10)) as input\n"
    " from y where masked is not null)").replace(
    "sp as (select id, case",
    "sp as (select id, case") + f""",
spx as (select ex.*, sp.split, string_split(ex.input, chr(10)) as ls from ex join sp on ex.id = sp.id),
spk as (select *, list_position(list_transform(ls, lambda x: instr(x, '<extra_id_0>') > 0), true) as kk from spx),
ctx as (select id, target, split,
  case when kk > 1 then {py_strip('ls[kk - 1]')} else '' end as ctx_prev,
  coalesce({py_strip('ls[kk + 1]')}, '') as ctx_next from spk),
tr as (select * from ctx where split = 'train'),
c1 as (select ctx_prev, ctx_next, target, count(*) as n from tr group by all),
pair as (select ctx_prev, ctx_next, arg_min(target, (-n, target)) as prediction, max(n) as votes, cast(sum(n) as bigint) as support
  from c1 group by ctx_prev, ctx_next),
c2 as (select ctx_prev, target, count(*) as n from tr group by all),
prev as (select ctx_prev, arg_min(target, (-n, target)) as prediction from c2 group by ctx_prev),
c3 as (select target, count(*) as n from tr group by target),
gmode as (select arg_min(target, (-n, target)) as prediction from c3)
"""

SQL["fill_counts"] = _FILL + "select ctx_prev, ctx_next, prediction, votes, support from pair\n"

SQL["predict_fill_counts"] = _FILL + f""",
te as (select c.id, c.target, p1.prediction as p1, p2.prediction as p2 from ctx c
  left join pair p1 on c.ctx_prev = p1.ctx_prev and c.ctx_next = p1.ctx_next
  left join prev p2 on c.ctx_prev = p2.ctx_prev where c.split = 'test')
select id, target, coalesce(p1, p2, (select prediction from gmode)) as prediction,
 case when p1 is not null then 'pair' when p2 is not null then 'prev'
  when (select prediction from gmode) is not null then 'global' else 'none' end as level,
 coalesce(lower({py_strip('coalesce(p1, p2, (select prediction from gmode))')}) = lower({py_strip('target')}), false) as correct
from te
"""


def _corrupt_ctes(src: str, key: str, text: str, seed: int = 42) -> str:
    """CTE text: corruption of ``text`` keyed by ``key`` from CTE ``src`` -> ``cor(key, input, target)``."""
    return f""",
ct as (select {key} as k, {py_split(text)} as tokens from {src}),
ct10 as (select k, tokens, len(tokens) as n from ct where len(tokens) >= 10),
ce as (select k, n, unnest(tokens) as tok, unnest(range(len(tokens))) as pos from ct10),
cs as (select *, ('0x' || substring(sha256(concat('{seed}:', cast(k as string))), 1, 8))::bigint as seed32 from ce),
ch1 as (select *, (xor(xor(seed32, pos) >> 16, xor(seed32, pos)) * 73244475) % 4294967296 as x1 from cs),
ch2 as (select *, (xor(x1 >> 16, x1) * 73244475) % 4294967296 as x2 from ch1),
cr as (select *, row_number() over (partition by k order by xor(x2 >> 16, x2), pos) as rk, greatest(1, n * 15 // 100) as kk from ch2),
cm as (select *, rk <= kk as masked from cr),
co as (select *, case when masked then sum(case when masked then 1 else 0 end) over (partition by k order by pos rows between unbounded preceding and current row) - 1 end as ord from cm),
cor as (select k,
 string_agg(case when masked then concat('<extra_id_', cast(ord as string), '>') else tok end, ' ' order by pos) as input,
 string_agg(case when masked then concat('<extra_id_', cast(ord as string), '> ', tok) end, ' ' order by pos) as target
 from co group by k)
"""


SQL["build_datasets"] = with_views("code_functions", "code_ifs") + _FUNCS + f""",
parts as (select func_no, fid, code, row_number() over (order by {seeded(42, 'fid')}, fid) - 1 as pidx from funcs),
pre as (select * from parts where pidx < floor((select count(*) from parts)::double * 0.7)),
fin as (select * from parts where pidx >= floor((select count(*) from parts)::double * 0.7))""" + _corrupt_ctes("pre", "fid", "code") + f""",
x as (
  select f.fid, c.line, c.condition, string_split(f.code, chr(10)) as lines
  from fin f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines)),
ex as (select sha256(concat(fid, ':', cast(line as string))) as id,
 array_to_string(list_transform(lines, lambda s, i: case when i = line then masked else s end), chr(10)) as input,
 {py_strip('condition')} as target from y where masked is not null),
s as (select *, row_number() over (order by {seeded(42, 'id')}, id) - 1 as idx, count(*) over () as n from ex)
select 'pretrain' as kind, 'train' as split, k as id, input, target from cor
union all
select 'finetune', case when idx < floor(cast(n as double) * 0.8) then 'train'
 when idx < floor(cast(n as double) * 0.8) + floor(cast(n as double) * 0.1) then 'val' else 'test' end, id, input, target from s
"""


# ---- encoding (J5, J6) -------------------------------------------------------

_SPECIAL_RE2 = r"<pad>|<unk>|</s>|<extra_id_(?:[1-9]?[0-9])>"


def _encode_ctes(src: str, key: str, text: str, tag: str, max_len: int = 512, merges: int = 8) -> str:
    """CTEs ending in ``{tag}_enc(k, n_tokens, ids_str, n_attended)`` for ``text`` of CTE ``src``."""
    from maskcorpus.config import SPECIAL_TOKENS
    chain = "s"
    for k in range(merges):
        chain = f"replace({chain}, '<' || cast(a{k} as string) || '><' || cast(b{k} as string) || '>', '<' || cast(n{k} as string) || '>')"
    sp_case = "case " + " ".join(f"when seg = '{t}' then {i}" for i, t in enumerate(SPECIAL_TOKENS)) + " end"
    mp_cols = ", ".join(f"m{k}.a as a{k}, m{k}.b as b{k}, m{k}.new_id as n{k}" for k in range(merges))
    mp_from = ", ".join(f"m{k}" for k in range(merges))
    return f""",
{tag}_mp as (select {mp_cols} from {mp_from}),
{tag}_segs as (select {key} as k, list_filter(string_split(regexp_replace({text}, '({_SPECIAL_RE2})', chr(1) || '\\1' || chr(1), 'g'), chr(1)), lambda z: z <> '') as segs from {src}),
{tag}_seg as (select k, unnest(segs) as seg, unnest(range(len(segs))) as seg_no from {tag}_segs),
{tag}_sp as (select k, seg_no, 0 as tok_no, 0 as piece_no, {sp_case} as id from {tag}_seg where regexp_full_match(seg, '{_SPECIAL_RE2}')),
{tag}_pt0 as (select k, seg_no, regexp_extract_all(seg, '{_PRETOKEN_RE2}') as toks from {tag}_seg where not regexp_full_match(seg, '{_SPECIAL_RE2}')),
{tag}_pt as (select k, seg_no, {_fixup_sql('toks')} as pts from {tag}_pt0),
{tag}_w as (select k, seg_no, unnest(pts) as w, unnest(range(len(pts))) as tok_no from {tag}_pt),
{tag}_wb as (select k, seg_no, tok_no, {_byte_level_sql('w')} as bw from {tag}_w),
{tag}_ch as (select k, seg_no, tok_no, unnest(regexp_extract_all(bw, '.')) as c, unnest(range(length(bw))) as ci from {tag}_wb),
{tag}_sym as (select h.k, h.seg_no, h.tok_no, string_agg('<' || cast(coalesce(a.id, 1) as string) || '>', '' order by h.ci) as s
  from {tag}_ch h left join alpha a on a.token = h.c group by h.k, h.seg_no, h.tok_no),
{tag}_bpe as (select k, seg_no, tok_no, regexp_extract_all({chain}, '<([0-9]+)>', 1) as ids from {tag}_sym, {tag}_mp),
{tag}_pc as (select k, seg_no, tok_no, cast(unnest(ids) as int) as id, unnest(range(len(ids))) as piece_no from {tag}_bpe),
{tag}_all as (select k, seg_no, tok_no, piece_no, id from {tag}_pc union all select k, seg_no, tok_no, piece_no, id from {tag}_sp),
{tag}_list as (select s.k, coalesce(list(a.id order by a.seg_no, a.tok_no, a.piece_no) filter (where a.id is not null), []) as ids
  from {tag}_segs s left join {tag}_all a on a.k = s.k group by s.k),
{tag}_cut as (select k, len(ids) + 1 as n_tokens, list_slice(list_concat([2], ids), 1, {max_len}) as x from {tag}_list),
{tag}_enc as (select k, cast(n_tokens as int) as n_tokens, cast(len(x) as int) as n_attended,
  array_to_string(list_concat(x, list_transform(range({max_len} - len(x)), lambda z: 0)), ',') as ids_str from {tag}_cut)"""


def _encode_padded_sql() -> str:
    ex = with_views("code_functions", "code_ifs") + _FUNCS + f""",
x as (
  select f.func_no, f.fid, c.line, c.condition, string_split(f.code, chr(10)) as lines
  from funcs f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines)),
ex as (select sha256(concat(fid, ':', cast(line as string))) as id,
 array_to_string(list_transform(lines, lambda s, i: case when i = line then masked else s end), chr(10)) as input,
 {py_strip('condition')} as target from y where masked is not null),
"""
    chain = _bpe_chain(8).strip()
    assert chain.startswith("with ")
    return (ex + chain[len("with "):] + _encode_ctes("ex", "id", "input", "ei") + _encode_ctes("ex", "id", "target", "et")
            + """
select i.k as id, i.ids_str as input_ids, i.n_attended, t.ids_str as labels
from ei_enc i join et_enc t on i.k = t.k
""")


SQL["encode_padded"] = _encode_padded_sql()


# ---- files, archives and stages ------------------------------------------------
SQL["catalog_files"] = with_views("repo_catalog") + """
select cast(row_number() over (partition by floor(repo_key / 100) order by repo_key) - 1 as int) as item_ord,
 owner, repo, html_url, language, stars, fork, archived, license, default_branch
from repo_catalog
"""

SQL["archive_members"] = with_views("code_files") + """
select concat('src/f', cast(file_no as string), '.py') as member,
 cast(row_number() over (partition by file_no // 50 order by file_no) as int) as member_ord, 'ok' as status, sha256(code) as code_sha
from code_files
"""

SQL["archive_source"] = SQL["archive_members"]

_EXTRACTED = SQL["extract_functions"].rstrip().rsplit("\nselect ", 1)[0]

SQL["functions_from_archives"] = _EXTRACTED + """
select concat('src/f', cast(file_no as string), '.py') as member, cast(fn_ord as int) as fn_ord, num_ifs, cast(len(string_split(code, chr(10))) as int) as lines,
 sha256(concat(cast(row_number() over (order by case when (file_no // 50) % 2 = 0 then -(file_no // 50) else file_no // 50 + 1 end, file_no, fn_ord) - 1 as string), ':', substring(code, 1, 100))) as id
from r
"""

SQL["functions_from_all_archives"] = _EXTRACTED + """
select concat('src/f', cast(file_no as string), '.py') as member, cast(fn_ord as int) as fn_ord, num_ifs, cast(len(string_split(code, chr(10))) as int) as lines,
 sha256(concat(cast(row_number() over (order by -(file_no // 50), file_no, fn_ord) - 1 as string), ':', substring(code, 1, 100))) as id
from r
"""

SQL["extraction_report"] = """
select status, cast(sum(n) as bigint) as n from (
 select case when doc_id % 10 = 7 then 'syntax_error' else 'ok' end as status, case when doc_id % 10 <> 7 and doc_id % 3 = 2 then 2 else 1 end as n
 from documents) group by status
"""

SQL["length_filter"] = f"with e as ({SQL['extract_functions']}) select file_no, fn_ord, lines from e where lines between 5 and 12\n"

SQL["functions_jsonl"] = with_views("code_functions", "code_ifs") + _FUNCS + """
select f.fid as id, cast(count(*) as int) as num_ifs, cast(len(string_split(any_value(f.code), chr(10))) as int) as lines,
 sha256(any_value(f.code)) as code_sha, string_agg(concat(cast(c.line as string), ':', c.condition), '|' order by c.line) as ifs
from funcs f join code_ifs c on f.func_no = c.func_no group by f.func_no, f.fid
"""

_EX_FULL = _EXAMPLES.replace(
    "ex as (select sha256(concat(fid, ':', cast(line as string))) as id from y where masked is not null)",
    f"ex as (select sha256(concat(fid, ':', cast(line as string))) as id, func_no, line, {py_strip('condition')} as target,\n"
    " array_to_string(list_transform(lines, lambda s, i: case when i = line then masked else s end), chr(10)) as input\n"
    " from y where masked is not null)")

SQL["examples_by_split"] = _EX_FULL + """
select sp.split, ex.id, sha256(ex.input) as input_sha, ex.target from ex join sp on ex.id = sp.id
"""

SQL["benchmark_csv"] = with_views("benchmark_code") + "select sha256(code) as code_sha from benchmark_code where item_id % 7 <> 3\n"

SQL["results_csv"] = _EX_FULL.rstrip() + f""",
if_predictions as ({VIEWS["if_predictions"][0].strip()})
select sha256(ex.input) as input_sha, ex.target, p.prediction,
 coalesce(lower({py_strip('p.prediction')}) = lower({py_strip('ex.target')}), false) as correct
from ex left join if_predictions p on ex.func_no = p.func_no and ex.line = p.line
"""

SQL["vocab_tables"] = SQL["vocab_ids"]

SQL["nfkc_text"] = """
select doc_id, cast(length(text) as int) as n_chars, sha256(text) as text_sha from documents
"""

SQL["count_at_least"] = """
select n::bigint as n, (select count(*) from documents) >= n as enough from (select unnest([1, 150, 900, 1000000000]) as n)
"""

SQL["materialized_stage"] = f"select doc_id, cast(len({py_split('text')}) as int) as n_tokens from documents\n"

SQL["decode_whole_texts"] = f"""
select doc_id, cast(length({py_strip('text')}) as int) as n_chars, sha256({py_strip('text')}) as text_sha from documents
"""

SQL["rebuilt_stage"] = f"""
select doc_id, case when {hash_bucket(42, 'doc_id')} < 8000 then 'train'
 when {hash_bucket(42, 'doc_id')} < 9000 then 'val' else 'test' end as split
from documents
"""

SQL["progress_report"] = """
select 'functions' as stage, true as complete, count(*) as rows from documents union all
select 'words', true, count(*) from documents union all select 'missing', false, null
"""

_REPEATED = with_views("code_functions", "code_ifs", "if_predictions", "repeated_predictions") + _FUNCS + f""",
x as (
  select f.func_no, f.fid, c.line, c.condition, string_split(f.code, chr(10)) as lines
  from funcs f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines)),
ex as (select sha256(concat(fid, ':', cast(line as string))) as id, func_no, line, {py_strip('condition')} as target
 from y where masked is not null),
one as (select func_no, line, min(prediction) as prediction from repeated_predictions group by func_no, line)
"""

SQL["score_repeated_predictions"] = _REPEATED + f"""
select ex.id, ex.target, p.prediction, coalesce(lower({py_strip('p.prediction')}) = lower({py_strip('ex.target')}), false) as correct
from ex left join one p on ex.func_no = p.func_no and ex.line = p.line
"""

SQL["predict_batch"] = _EX_FULL + """
select ex.id, cast(len(string_split(ex.input, chr(10))) as string) as prediction from ex join sp on ex.id = sp.id where sp.split = 'test'
"""

SQL["decode_truncated"] = "select doc_id, true as is_prefix, true as has_text from documents\n"

_DATASETS = SQL["build_datasets"].rstrip()


def _encode_datasets_sql() -> str:
    head, tail = _DATASETS.rsplit("\nselect 'pretrain' as kind", 1)
    chain = _bpe_chain(8).strip()[len("with "):]
    hold = seeded(42, "id")
    return (head + f""",
ds as (select 'pretrain' as kind{tail}),
pr as (select kind, id, input, target, row_number() over (order by {hold}, id) - 1 as hidx, count(*) over () as hn from ds where kind = 'pretrain'),
todo as (select kind, case when hidx < ceil(cast(hn as double) * 0.05) then 'test' else 'train' end as split, id, input, target from pr
 union all select kind, split, id, input, target from ds where kind = 'finetune' and split <> 'test'),
""" + chain + _encode_ctes("todo", "id", "input", "ei") + _encode_ctes("todo", "id", "target", "et") + """
select t.kind, t.split, t.id, sha256(i.ids_str) as input_sha, i.n_attended, sha256(l.ids_str) as labels_sha
from todo t join ei_enc i on i.k = t.id join et_enc l on l.k = t.id
""")


SQL["encode_datasets"] = _encode_datasets_sql()


def _pipeline_metrics_sql() -> str:
    head, tail = _DATASETS.rsplit("\nselect 'pretrain' as kind", 1)
    return head + f""",
ds as (select 'pretrain' as kind{tail}),""" + _BENCH.replace("with ", "", 1) + """,
pairs as (select 'g' as t, target from ds where kind = 'finetune' and split = 'test' union all select 'p', target from bex),
m as (select t, count(*) filter (where length(target) % 2 = 0) as exact_match, count(*) as total from pairs group by t),
mm as (select t, {'accuracy': coalesce(exact_match / nullif(cast(total as double), 0), 0.0), 'exact_match': exact_match, 'total': total} as s from m)
select to_json({'generated_testset': (select s from mm where t = 'g'), 'provided_testset': (select s from mm where t = 'p')})::varchar as metrics_json
"""


SQL["pipeline_metrics"] = _pipeline_metrics_sql()

SQL["incremental_examples"] = with_views("code_functions", "code_ifs") + _FUNCS + _corrupt_ctes("funcs", "fid", "code") + f""",
x as (
  select f.fid, c.line, c.condition, string_split(f.code, chr(10)) as lines
  from funcs f join code_ifs c on f.func_no = c.func_no
),
y as (select *, {mask_line('lines[line]')} as masked from x where line <= len(lines)),
both_kinds as (
  select 'pretrain' as kind, k as func_id, k as id, input, target from cor
  union all
  select 'finetune', fid, sha256(concat(fid, ':', cast(line as string))),
   array_to_string(list_transform(lines, lambda s, i: case when i = line then masked else s end), chr(10)), {py_strip('condition')}
  from y where masked is not null)
select kind, case when {hash_bucket(42, 'func_id')} < 8000 then 'train' when {hash_bucket(42, 'func_id')} < 9000 then 'val' else 'test' end as split,
 func_id, id, sha256(input) as input_sha, target
from both_kinds
"""
