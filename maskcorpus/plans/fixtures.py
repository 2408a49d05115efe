"""Derived input views built by SQL from the driver's tables.

The supplied tables hold prose, not Python, so code rows are *derived* by SQL
whose right extraction is known by construction. Each text runs unchanged in
Spark SQL and DuckDB (``chr(10)`` for newline, ``chr(39)`` for a quote, no
backslashes), so the oracle inlines the very same text as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# One function per document, six templates: plain, multi-line condition (masking
# drops it), slice colon, 'elif' inside a string plus an elif branch, nested if
# with a trailing comment, and no if at all. Each body goes on with the whole
# text of its document as comment lines, so functions have the size of documents.
CODE_FUNCTIONS = """
select doc_id as func_no, concat(case doc_id % 6
 when 0 then concat('def f', cast(doc_id as string), '(n, lang):', chr(10), '    if n > ', cast(n_chars % 97 as string), ' and lang == "', lang, '":', chr(10), '        return "', source, '"', chr(10), '    return None')
 when 1 then concat('def f', cast(doc_id as string), '(a, b):', chr(10), '    if (a or', chr(10), '            b):', chr(10), '        return ', cast(n_chars as string), chr(10), '    return 0')
 when 2 then concat('def f', cast(doc_id as string), '(s):', chr(10), '    if s[1:', cast(2 + n_chars % 5 as string), ']:', chr(10), '        return s')
 when 3 then concat('def f', cast(doc_id as string), '(k):', chr(10), '    if k == ', chr(39), 'elif', chr(39), ':', chr(10), '        return 1', chr(10), '    elif k == "', lang, '":', chr(10), '        return 2')
 when 4 then concat('def f', cast(doc_id as string), '(x):', chr(10), '    if x:', chr(10), '        if x > ', cast(n_chars % 13 as string), ':  # deep', chr(10), '            return x', chr(10), '    return 0')
 else concat('def f', cast(doc_id as string), '(x):', chr(10), '    return x + ', cast(n_chars as string)) end, chr(10), '    # ', replace(text, chr(10), concat(chr(10), '    # ')), chr(10), '    pass') as code
from documents
"""

# The right extraction of CODE_FUNCTIONS, by construction.
CODE_IFS = """
select doc_id as func_no, 2 as line, 3 as depth, case doc_id % 6
 when 0 then concat('n > ', cast(n_chars % 97 as string), ' and lang == "', lang, '"')
 when 1 then concat('(a or', chr(10), '            b)')
 when 2 then concat('s[1:', cast(2 + n_chars % 5 as string), ']')
 when 3 then concat('k == ', chr(39), 'elif', chr(39))
 else 'x' end as condition
from documents where doc_id % 6 < 5
union all
select doc_id, 3, 5, concat('x > ', cast(n_chars % 13 as string)) from documents where doc_id % 6 = 4
"""

# One repo per customer, with null licences, null branches, forks and archived rows.
REPO_CATALOG = """
select c_custkey as repo_key, concat('owner', cast(c_custkey % 50 as string)) as owner, c_name as repo,
 concat('https://example.com/', c_name) as html_url,
 case when c_nationkey = 0 then 'Java' else 'Python' end as language,
 cast(floor(abs(c_acctbal)) as bigint) as stars, c_custkey % 11 = 0 as fork, c_custkey % 17 = 0 as archived,
 case c_mktsegment when 'BUILDING' then 'MIT' when 'AUTOMOBILE' then 'Apache-2.0' when 'FURNITURE' then 'BSD-3-Clause'
  when 'HOUSEHOLD' then 'GPL-3.0' else null end as license,
 case when c_custkey % 3 = 0 then null else 'develop' end as default_branch
from customer
"""

# Which repo each function came from: repo r holds functions r*r .. (r+1)*(r+1)-1,
# so repos hold 1, 3, 5, ... functions (uneven groups for the take-until cut).
REPO_FUNCTIONS = """
select func_no, cast(floor(sqrt(func_no)) as bigint) as repo_key from code_functions
"""

# A third equal, a third equal only after strip + lower, a third wrong.
IF_PREDICTIONS = """
select func_no, line, condition as target, case (func_no + line) % 3
 when 0 then condition when 1 then concat('  ', upper(condition), ' ') else 'None' end as prediction
from code_ifs
"""

# Source files for the extraction kernel: each function as written (variant 0),
# as a method of a class (variant 1), or nested in an outer function (variant 2).
CODE_FILES = """
select func_no as file_no, case func_no % 3
 when 0 then code
 when 1 then concat('class K', cast(func_no as string), ':', chr(10), '    ', replace(code, chr(10), concat(chr(10), '    ')))
 else concat('def outer', cast(func_no as string), '():', chr(10), '    ', replace(code, chr(10), concat(chr(10), '    ')), chr(10), '    return f', cast(func_no as string))
 end as code
from code_functions
"""

# The right extraction of CODE_FILES: function rows (in file order) and their ifs.
CODE_FILE_IFS = """
select func_no as file_no, case when func_no % 3 = 2 then 1 else 0 end as fn_ord, line, depth,
 case when func_no % 3 = 0 then condition else replace(condition, chr(10), concat(chr(10), '    ')) end as condition
from code_ifs
union all
select func_no, 0, line + 1, depth + 2, replace(condition, chr(10), concat(chr(10), '    '))
from code_ifs where func_no % 3 = 2
"""

# Benchmark rows as code: nested ifs (first = outer), a module-level if, no if,
# and a multi-line first if (drops out of the denominator); each goes on with the
# item's text as comment lines.
BENCHMARK_CODE = """
select item_id, concat(case item_id % 4
 when 0 then concat('def g', cast(item_id as string), '(x):', chr(10), '    if x > ', cast(item_id * 7 % 89 as string), ':', chr(10), '        if x < 0:', chr(10), '            return 1', chr(10), '    return 0')
 when 1 then concat('value = compute()', chr(10), 'if value == ', cast(item_id as string), ':', chr(10), '    print(value)')
 when 2 then concat('def g', cast(item_id as string), '(x):', chr(10), '    return x')
 else concat('def g', cast(item_id as string), '(x, y):', chr(10), '    if (x and', chr(10), '            y):', chr(10), '        pass', chr(10), '    elif x:', chr(10), '        pass')
 end, chr(10), '# ', replace(text, chr(10), concat(chr(10), '# ')), chr(10), 'done()') as code
from benchmark
"""

# Predictions for the benchmark examples: a third right, a third right after
# strip + lower, a third wrong.
BENCHMARK_PREDICTIONS = """
select item_id, case item_id % 3
 when 0 then concat('x > ', cast(item_id * 7 % 89 as string))
 when 1 then concat(' VALUE == ', cast(item_id as string))
 else 'None' end as prediction
from benchmark
"""

# Predictions with repeats and gaps: none for every fifth condition, two or three rows for others
# (the smallest text counts), one of them without a text.
REPEATED_PREDICTIONS = """
select func_no, line, prediction from if_predictions where (func_no + line) % 5 <> 0
union all
select func_no, line, concat('~', prediction) from if_predictions where (func_no + line) % 5 in (1, 2)
union all
select func_no, line, cast(null as string) from if_predictions where (func_no + line) % 5 = 1
"""

# name -> (sql, dependencies)
VIEWS = {
    "code_functions": (CODE_FUNCTIONS, ("documents",)),
    "code_ifs": (CODE_IFS, ("documents",)),
    "repo_catalog": (REPO_CATALOG, ("customer",)),
    "repo_functions": (REPO_FUNCTIONS, ("code_functions",)),
    "if_predictions": (IF_PREDICTIONS, ("code_ifs",)),
    "code_files": (CODE_FILES, ("code_functions",)),
    "code_file_ifs": (CODE_FILE_IFS, ("code_ifs",)),
    "benchmark_code": (BENCHMARK_CODE, ("benchmark",)),
    "repeated_predictions": (REPEATED_PREDICTIONS, ("if_predictions",)),
    "benchmark_predictions": (BENCHMARK_PREDICTIONS, ("benchmark",)),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out or n not in VIEWS:
            return
        for d in VIEWS[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views (and what they need) for an oracle query."""
    parts = [f"{n} as ({VIEWS[n][0].strip()})" for n in _closure(names)]
    return "with " + ",\n".join(parts) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet), or a derived view built on top of them."""
    if name in VIEWS:
        sql, deps = VIEWS[name]
        for d in deps:
            table(spark, sf_dir, d).createOrReplaceTempView(d)
        return spark.sql(sql)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...]) -> DataFrame:
    """A text table for CPU-heavy per-row work: only ``columns``, dealt evenly over tasks (see ``spread_rows``)."""
    from maskcorpus.session import spread_rows
    return spread_rows(table(spark, sf_dir, name).select(*columns))
