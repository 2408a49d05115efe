"""Scoring and reports."""

import json
import os

import pandas as pd
from pyspark.sql import functions as F

from maskcorpus.operators.evaluate import assemble_metrics, evaluate, exact_match, score_predictions
from maskcorpus.sources.files import metrics_to_json, write_results


def test_exact_match_normalises_and_counts_missing(spark):
    ex = spark.createDataFrame([("a", "x > 1"), ("b", "Y"), ("c", "z")], "id string, target string")
    pr = spark.createDataFrame([("a", "  X > 1 "), ("b", "y")], "id string, prediction string")
    scored = score_predictions(ex, pr)
    got = {r["id"]: r["correct"] for r in scored.collect()}
    assert got == {"a": True, "b": True, "c": False}
    m = exact_match(scored).first()
    assert (m["exact_match"], m["total"]) == (2, 3) and abs(m["accuracy"] - 2 / 3) < 1e-12


def test_accuracy_zero_on_empty(spark):
    empty = spark.createDataFrame([], "id string, correct boolean")
    m = exact_match(empty).first()
    assert (m["exact_match"], m["total"], m["accuracy"]) == (0, 0, 0.0)


def test_metrics_json_keeps_null_testset(spark):
    gen = spark.createDataFrame([(0.5, 1, 2)], "accuracy double, exact_match long, total long")
    j = json.loads(metrics_to_json(assemble_metrics(gen, None)).first()[0])
    assert j == {"generated_testset": {"accuracy": 0.5, "exact_match": 1, "total": 2}, "provided_testset": None}


def test_evaluate_two_sets(spark):
    ex = spark.createDataFrame([("a", "in", "t")], "id string, input string, target string")
    pr = spark.createDataFrame([("a", "T")], "id string, prediction string")
    bex = spark.createDataFrame([(1, "in", "u")], "item_id int, input string, target string")
    bpr = spark.createDataFrame([(1, "v")], "item_id int, prediction string")
    out = evaluate(ex, pr, bex, bpr)
    m = out["metrics"].first()
    assert m["generated_testset"]["accuracy"] == 1.0 and m["provided_testset"]["accuracy"] == 0.0


def test_results_csv_round_trips(spark, tmp_dir):
    rows = [('say "hi", ok', "a,b", "line1\nline2", True), ("plain", "t", "p", False)]
    df = spark.createDataFrame(rows, "input string, target string, prediction string, correct boolean")
    path = os.path.join(tmp_dir, "results")
    write_results(df, path)
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    assert sorted(tuple(r) for r in back.select("input", "target", "prediction").collect()) == \
        sorted((a, b, c) for a, b, c, _ in rows)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    pdf = pd.concat([pd.read_csv(os.path.join(path, f)) for f in files])
    assert set(pdf["input"]) == {r[0] for r in rows}
    assert sorted(pdf["correct"].tolist()) == [False, True]  # pandas reads the reference's True/False


def test_predict_batch_runs_user_model_per_task(spark):
    from maskcorpus.operators.predict import predict_batch

    def make():
        table = {"if <extra_id_0>:": "x"}
        return lambda inputs: [table.get(s, " none ") for s in inputs]
    ex = spark.createDataFrame([("a", "if <extra_id_0>:"), ("b", "other")], "id string, input string")
    got = {r["id"]: r["prediction"] for r in predict_batch(ex, make).collect()}
    assert got == {"a": "x", "b": "none"}


def test_fill_model_with_a_hot_context(spark):
    """One context holds a third of all rows: the mode comes from map-side-combined counts, no window."""
    from maskcorpus.operators.predict import fit_fill_counts, predict_fill_counts
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        prev = "def f(x):" if hot else f"def g{i % 50}(y):"
        tgt = ("x" if i % 2 else "y") if hot else f"t{i % 7}"
        rows.append((f"e{i}", f"{prev}\n    if <extra_id_0>:\n        pass", tgt))
    rows += [("extra", "def f(x):\n    if <extra_id_0>:\n        pass", "x")]
    ex = spark.createDataFrame(rows, "id string, input string, target string")
    model = fit_fill_counts(ex)
    plan = model["pair"]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan
    hot = model["pair"].where("ctx_prev = 'def f(x):'").first()
    assert (hot["prediction"], hot["support"], hot["votes"]) == ("x", 1001, 501)
    pred = predict_fill_counts(spark.createDataFrame([("q", "def f(x):\n    if <extra_id_0>:\n        pass")],
                                                     "id string, input string"), model).first()
    assert (pred["prediction"], pred["level"]) == ("x", "pair")


def test_hash_split_by_function_keeps_examples_together(spark):
    from maskcorpus.operators.ordering import split_hash
    ex = spark.range(0, 3000).select((F.col("id") % 400).cast("string").alias("func_id"), F.col("id").alias("line"))
    out = split_hash(ex, "func_id")
    per_func = out.groupBy("func_id").agg(F.countDistinct("split").alias("k"))
    assert per_func.where("k > 1").count() == 0  # no function in two splits (the Q17 leak is gone)


def test_repeated_predictions_do_not_repeat_examples(spark):
    from maskcorpus.operators.evaluate import exact_match, score_predictions
    ex = spark.createDataFrame([(1, "a"), (2, "b")], "id long, target string")
    pred = spark.createDataFrame([(1, "a"), (1, "zz"), (1, None), (3, "x")], "id long, prediction string")
    assert exact_match(score_predictions(ex, pred)).first().asDict() == {"exact_match": 1, "total": 2, "accuracy": 0.5}


def test_hot_context_is_split(spark):
    """One context holds half of all rows: no task of the joins reads much more than the median, and nothing is lost."""
    from pyspark.sql import functions as F

    from maskcorpus.operators.predict import heavy_keys, split_join
    left = spark.range(0, 40_000, 1, 8).selectExpr("id", "if(id % 2 = 0, 'hot', concat('k', id % 3001)) as k", "if(id % 997 = 0, null, 'x') as other")
    right = spark.range(3001).selectExpr("concat('k', id) as k", "id as v").where("v % 5 <> 0").union(spark.sql("select 'hot', -7L"))
    heavy = heavy_keys(left, ["k"])
    assert len(heavy) <= 1000 and left.where("k = 'hot'").select(F.xxhash64("k")).first()[0] in heavy
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        out = split_join(left, right, ["k"], heavy)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        plain = sorted(r["count"] for r in left.join(right, "k", "left").groupBy(F.spark_partition_id()).count().collect())
        assert out.columns == ["id", "k", "other", "v"]
        assert sorted(map(str, out.collect())) == sorted(map(str, left.join(right, "k", "left").select("id", "k", "other", "v").collect()))
        assert sizes[-1] <= 3 * sizes[len(sizes) // 2] < plain[-1]
        none = split_join(left, right, ["k"], [])
        assert sorted(map(str, none.collect())) == sorted(map(str, out.collect()))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert heavy_keys(left.limit(0), ["k"]) == []
