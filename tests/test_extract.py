"""Extraction kernel."""

from maskcorpus.functions.pysyntax import extract_functions, extract_ifs
from maskcorpus.operators.extract import extract_all, extraction_report

SRC = '''import os

class A:
    @staticmethod
    def m(self, x):
        if x:
            return 1
        elif x > 2:
            if y:
                pass
        else:
            if z or w:
                pass
        return 0


async def g(a):
    def inner(b):
        if (b and
                a):
            return b
    for i in range(3):
        if i % 2:
            continue
    try:
        pass
    except ValueError:
        if a: pass
    return inner
'''


def test_functions_in_order_with_nested_and_methods():
    status, funcs = extract_functions(SRC)
    assert status == "ok"
    assert [f["code"].split("(")[0] for f in funcs] == ["def m", "async def g", "def inner"]
    m = funcs[0]
    assert m["code"].startswith("def m(self, x):") and m["code"].endswith("return 0")
    assert m["conditions"] == ["x", "y", "z or w"]          # elif arm is not a target
    assert m["if_lines"] == [2, 5, 8]                        # relative to the function text
    assert m["depths"] == [3, 6, 6]                          # else/elif arms add 3
    g = funcs[1]
    assert g["conditions"] == ["(b and\n                a)", "i % 2", "a"]   # outer function sees inner's ifs
    assert g["depths"] == [5, 5, 6]
    inner = funcs[2]
    assert inner["conditions"] == ["(b and\n                a)"] and inner["if_lines"] == [2]


def test_syntax_error_and_crlf():
    assert extract_functions("def f(:\n  pass")[0] == "syntax_error"
    status, funcs = extract_functions("def f(x):\r\n    if x:\r\n        return 1\r\n")
    assert status == "ok" and funcs[0]["conditions"] == ["x"] and funcs[0]["if_lines"] == [2]


def test_module_ifs_first_in_preorder():
    status, ifs = extract_ifs("x = 1\nif x:\n    if y:\n        pass\nif z:\n    pass")
    assert [(c, ln, d) for c, ln, d in ifs] == [("x", 2, 1), ("y", 3, 3), ("z", 5, 1)]


def test_non_ascii_offsets():
    status, funcs = extract_functions("def f(é):\n    if é == 'ü' and (x):\n        pass")
    assert funcs[0]["conditions"] == ["é == 'ü' and (x)"]


def test_spark_job_reports_bad_files(spark):
    files = spark.createDataFrame([(1, SRC), (2, "def broken(:\n"), (3, None)], "file_no int, code string")
    out = extract_all(files, ("file_no",))
    rep = {r["status"]: r["n"] for r in extraction_report(out).collect()}
    assert rep == {"ok": 3, "syntax_error": 1, "null_code": 1}
