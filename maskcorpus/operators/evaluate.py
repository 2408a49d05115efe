"""Scoring predictions.

Exact match is ``prediction.strip().lower() == target.strip().lower()`` with
Python's whitespace set; accuracy is 0.0 on an empty set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskcorpus.functions.text import py_strip


def normalise(col) -> Column:
    """``s.strip().lower()``."""
    return F.lower(py_strip(col))


def score(df: DataFrame, prediction: str = "prediction", target: str = "target") -> DataFrame:
    """L4: add ``correct``; a missing prediction is not correct."""
    eq = normalise(prediction) == normalise(target)
    return df.withColumn("correct", F.coalesce(eq, F.lit(False)))


def one_prediction(predictions: DataFrame, on: Sequence[str] = ("id",), prediction: str = "prediction") -> DataFrame:
    """One row per key: its prediction (of several, the smallest text that is not null) and how many rows it had."""
    return predictions.groupBy(*on).agg(F.min(prediction).alias(prediction), F.count(F.lit(1)).alias("n_predictions"))


def score_predictions(examples: DataFrame, predictions: DataFrame, on: Sequence[str] = ("id",),
                      prediction: str = "prediction") -> DataFrame:
    """K1 + L4: every example once, with its prediction (left join: missing -> null, not correct).

    Predictions are reduced to one row per key before the join, so a key that
    repeats cannot repeat an example.
    """
    p = one_prediction(predictions, on, prediction).drop("n_predictions")
    return score(examples.join(p, list(on), "left"), prediction)


def exact_match(scored: DataFrame, correct: str = "correct") -> DataFrame:
    """One row ``exact_match, total, accuracy`` (0.0 when empty)."""
    agg = scored.agg(F.count_if(F.col(correct)).alias("exact_match"), F.count(F.lit(1)).alias("total"))
    return agg.withColumn("accuracy", F.coalesce(
        F.try_divide(F.col("exact_match").cast("double"), F.col("total")), F.lit(0.0)))


def per_testset(scored: DataFrame, testset: str = "testset", correct: str = "correct") -> DataFrame:
    """I3 grouped: one metrics row per testset label, one aggregation pass over all testsets."""
    agg = scored.groupBy(testset).agg(F.count_if(F.col(correct)).alias("exact_match"),
                                      F.count(F.lit(1)).alias("total"))
    return agg.withColumn("accuracy", F.coalesce(
        F.try_divide(F.col("exact_match").cast("double"), F.col("total")), F.lit(0.0)))


METRIC_FIELDS = ("accuracy", "exact_match", "total")


def assemble_metrics(generated: DataFrame, provided: DataFrame | None) -> DataFrame:
    """I4: one row ``generated_testset, provided_testset`` (null when there is no benchmark).

    Both inputs are one-row metric frames; they are tagged and folded in one
    aggregation instead of being joined.
    """
    def tagged(df, name):
        return df.select(F.lit(name).alias("_t"), F.struct(*METRIC_FIELDS).alias("_m"))
    both = tagged(generated, "generated")
    if provided is not None:
        both = both.unionByName(tagged(provided, "provided"))
    return both.agg(F.max(F.when(F.col("_t") == "generated", F.col("_m"))).alias("generated_testset"),
                    F.max(F.when(F.col("_t") == "provided", F.col("_m"))).alias("provided_testset"))


def evaluate_dataset(examples: DataFrame, predictions: DataFrame, on: Sequence[str] = ("id",)
                     ) -> tuple[DataFrame, DataFrame]:
    """``(results, metrics)``; results are ``input, target, prediction, correct`` (+ keys)."""
    results = score_predictions(examples, predictions, on)
    return results, exact_match(results)


def evaluate(generated: DataFrame, generated_predictions: DataFrame,
             benchmark: DataFrame | None = None, benchmark_predictions: DataFrame | None = None,
             on: Sequence[str] = ("id",), benchmark_on: Sequence[str] = ("item_id",)) -> dict:
    """Both testsets -> ``{"generated": results, "provided": results|None, "metrics": row}``."""
    gen_res, gen_m = evaluate_dataset(generated, generated_predictions, on)
    prov_res = prov_m = None
    if benchmark is not None and benchmark_predictions is not None:
        prov_res, prov_m = evaluate_dataset(benchmark, benchmark_predictions, benchmark_on)
    return {"generated": gen_res, "provided": prov_res, "metrics": assemble_metrics(gen_m, prov_m)}
