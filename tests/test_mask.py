"""Condition masking rules."""

from maskcorpus.operators import mask

CASES = [
    ("if node.type == 'elif':", "if node.type == 'elif <extra_id_0>:"),
    ("if x[1:2]:", "if <extra_id_0>:2]:"),
    ("if (n := 3):", "if <extra_id_0>:= 3):"),
    ("if x:  # elif", "if <extra_id_0>:  # elif"),
    ("if y: # if z: elif w: q", "if y: # if z: elif <extra_id_0>: q"),
    ("if (a or", None),
    ("", None),
    ("    elif_thing = 1", None),
]


def _reference(line):
    for kw in ["elif", "if"]:
        if kw in line:
            before, after = line.split(kw, 1)
            c = after.find(":")
            if c != -1:
                return before + kw + " <extra_id_0>" + after[c:]
    return None


def test_mask_line_cases(spark):
    rows = [(i, line) for i, (line, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, line string")
    got = {r["i"]: r["m"] for r in df.select("i", mask.mask_line("line").alias("m")).collect()}
    for i, (line, expected) in enumerate(CASES):
        if expected is not None:
            assert got[i] == expected, line
        assert got[i] == _reference(line), line


def test_mask_conditions_whole_code(spark):
    code = "def f(x):\n    if x > 1:\n        return 1\n    if (a or\n            b):\n        return 2"
    f = spark.createDataFrame(
        [("fid", code, [("x > 1", 2, 3), ("(a or\n            b)", 4, 3), ("zz", 99, 3)])],
        "id string, code string, if_statements array<struct<condition:string,line:int,depth:int>>")
    ex = mask.mask_conditions(f).collect()
    assert len(ex) == 1  # multi-line condition and out-of-range line give no example
    r = ex[0]
    assert r["input"] == "def f(x):\n    if <extra_id_0>:\n        return 1\n    if (a or\n            b):\n        return 2"
    assert r["target"] == "x > 1"
    import hashlib
    assert r["id"] == hashlib.sha256(b"fid:2").hexdigest()


def test_mask_then_fill_restores_simple_lines(spark):
    code = "def g(y):\n    if y == 3:\n        pass"
    f = spark.createDataFrame([("g", code, [("y == 3", 2, 3)])],
                              "id string, code string, if_statements array<struct<condition:string,line:int,depth:int>>")
    r = mask.mask_conditions(f).first()
    assert r["input"].replace("<extra_id_0>", r["target"]) == code


def test_mask_after_keyword_on_prose(spark):
    df = spark.createDataFrame([(1, "first line\nwe and they, then\nno hit")], "k int, t string")
    out = mask.mask_after_keyword(df, "t", ("and",), ",", key=("k",)).collect()
    assert [(r["line"], r["masked_line"], r["span"]) for r in out] == [(2, "we and <extra_id_0>, then", "they")]


def test_mask_plan_is_narrow_and_jvm_only(spark):
    f = spark.createDataFrame([("a", "def f():\n    if x:\n        pass", [("x", 2, 3)])],
                              "id string, code string, if_statements array<struct<condition:string,line:int,depth:int>>")
    plan = mask.mask_conditions(f)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
