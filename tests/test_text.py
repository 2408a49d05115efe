"""Python string semantics as Spark expressions."""

import hashlib
import sys

from pyspark.sql import functions as F

from maskcorpus.functions.text import function_id, mask_budget, py_split, py_strip


def _ws_chars():
    return [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def test_split_matches_python_for_every_whitespace_char(spark):
    ws = _ws_chars()
    texts = [f"a{c}b{c}{c}c" for c in ws] + ["  lead", "trail  ", "", "   ", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(py_split("t")).collect()]
    assert got == [t.split() for t in texts]


def test_non_whitespace_is_not_split(spark):
    others = ["\u200b", "\ufeff", "\u180e", "x"]
    df = spark.createDataFrame([(f"a{c}b",) for c in others], "t string")
    got = [r[0] for r in df.select(py_split("t")).collect()]
    assert got == [[f"a{c}b"] for c in others]


def test_strip_matches_python(spark):
    ws = _ws_chars()
    texts = [f"{c}{c}mid dle{c}" for c in ws] + ["", "   ", "abc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(py_strip("t")).collect()] == [t.strip() for t in texts]


def test_lower_matches_python_on_special_letters(spark):
    texts = ["\u0130stanbul", "ΟΔΟΣ", "ÀÉÎ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(F.lower("t")).collect()] == [t.lower() for t in texts]


def test_function_id_counts_code_points(spark):
    code = "\U0001F600" * 120 + "def f(): pass"
    df = spark.createDataFrame([(7, code)], "i long, code string")
    got = df.select(function_id("i", "code")).first()[0]
    assert got == hashlib.sha256(f"7:{code[:100]}".encode()).hexdigest()


def test_mask_budget_equals_reference_float_form(spark):
    df = spark.range(1, 100_000).select(F.col("id").alias("n"), mask_budget(F.col("id")).alias("k"))
    bad = df.where(F.col("k") != F.greatest(F.lit(1), F.col("n") * 15 / 100).cast("int"))
    assert bad.count() == 0
    sample = {r["n"]: r["k"] for r in df.where(F.col("n") < 2000).collect()}
    assert all(sample[n] == max(1, int(n * 0.15)) for n in sample)


def test_nfkc_prefilter_and_udf(spark):
    import unicodedata

    from maskcorpus.functions.bytelevel import nfkc
    texts = ["plain ascii", "café crème ñ ü ß ¿", "ﬁne ＡＢＣ ²", "x y", "é", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(nfkc("t")).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]
