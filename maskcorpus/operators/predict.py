"""Prediction.

Neural training is out of scope. ``predict_batch`` runs a user's model over
Arrow batches (loaded once per task); ``fit_fill_counts`` /
``predict_fill_counts`` are a count-based fill model so the whole pipeline can
run on Spark alone: the most frequent target for the masked line's context
(previous and next line), backing off to the previous line, then to the global mode.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskcorpus.config import MASK_TOKEN
from maskcorpus.functions.text import py_strip, split_lines


def mask_context(input_col: str = "input", mask: str = MASK_TOKEN) -> tuple[Column, Column]:
    """``(prev_line, next_line)`` around the first line holding the mask, stripped ('' at the edges)."""
    lines = split_lines(input_col)
    k = F.array_position(F.transform(lines, lambda x: F.instr(x, mask) > 0), True) - 1
    prev = F.when(k > 0, py_strip(F.get(lines, k - 1))).otherwise(F.lit(""))
    nxt = F.coalesce(py_strip(F.get(lines, k + 1)), F.lit(""))
    return prev, nxt


def _mode(df: DataFrame, keys: list[str], target: str = "target") -> DataFrame:
    """Most frequent target per key (ties: smallest target). Partial aggregation first, no window."""
    counts = df.groupBy(*keys, target).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("nn"), F.col(target).alias("t"))).alias("_b"),
                                     F.sum("_n").alias("support"))
    return best.select(*keys, F.col("_b.t").alias("prediction"), (-F.col("_b.nn")).alias("votes"), "support")


def with_context(examples: DataFrame, input_col: str = "input") -> DataFrame:
    prev, nxt = mask_context(input_col)
    return examples.withColumn("ctx_prev", prev).withColumn("ctx_next", nxt)


def fit_fill_counts(examples: DataFrame, input_col: str = "input", target: str = "target") -> dict:
    """L2: ``{"pair": (ctx_prev, ctx_next) table, "prev": ctx_prev table, "global": mode or None}``."""
    ex = with_context(examples, input_col).select("ctx_prev", "ctx_next", target)
    g = _mode(ex.withColumn("_all", F.lit(1)), ["_all"], target).select("prediction").first()
    return {"pair": _mode(ex, ["ctx_prev", "ctx_next"], target), "prev": _mode(ex, ["ctx_prev"], target),
            "global": g["prediction"] if g else None}


#: Keys with more than this share of the rows are answered from a broadcast: at most 1 / HEAVY_SHARE keys.
HEAVY_SHARE = 0.001
#: A heavy key's rows go through the shuffle in so many lanes.
LANES = 4096


def heavy_keys(rows: DataFrame, keys: list[str], share: float = HEAVY_SHARE) -> list[int]:
    """Hashes of the keys that may hold more than ``share`` of the rows: one pass with a sketch of 1 / ``share`` counters.

    Every heavier key is among them; others may be too, which costs nothing but a place in the broadcast.
    """
    found = rows.select(F.xxhash64(*keys).alias("h")).freqItems(["h"], share).first()
    return sorted(found[0] or []) if found else []


def split_join(left: DataFrame, right: DataFrame, keys: list[str], heavy: list[int]) -> DataFrame:
    """Left join with ``right``, which has one row per key: heavy keys by a broadcast, all others by a shuffle.

    The broadcast holds at most ``len(heavy)`` rows. Rows of heavy keys have
    their answer then and go through the shuffled join in LANES lanes that
    match nothing, so that no task gets all rows of one key.
    """
    values = [c for c in right.columns if c not in keys]
    hashes = F.lit(np.array(heavy, np.int64)) if heavy else F.array().cast("array<bigint>")
    is_heavy = F.array_contains(hashes, F.xxhash64(*keys))
    few = right.where(is_heavy).select(*[F.col(k).alias(f"_h_{k}") for k in keys], *[F.col(v).alias(f"_h_{v}") for v in values])
    same = None
    for k in keys:
        one = F.col(k) == F.col(f"_h_{k}")
        same = one if same is None else same & one
    first = left.join(F.broadcast(few), same, "left") if heavy else left.select("*", *[F.lit(None).cast(right.schema[v].dataType).alias(f"_h_{v}") for v in values])
    lane = F.when(is_heavy, 1 + F.pmod(F.xxhash64(*left.columns), F.lit(LANES))).otherwise(F.lit(0)).cast("long")
    # always 0, but no literal: a constant would leave the join's keys, and with it the lanes
    rest = right.where(~is_heavy).withColumn("_lane", F.pmod(F.xxhash64(*keys), F.lit(1)))
    out = first.withColumn("_lane", lane).join(rest, [*keys, "_lane"], "left")
    return out.select(*left.columns, *[F.coalesce(F.col(f"_h_{v}"), F.col(v)).alias(v) for v in values])


def predict_fill_counts(examples: DataFrame, model: dict, input_col: str = "input") -> DataFrame:
    """L3: add ``prediction`` and ``level`` (pair, prev, global, none) by back-off.

    Contexts may be very unevenly frequent: both joins are split by ``heavy_keys``.
    """
    ex = with_context(examples, input_col)
    pair = model["pair"].select("ctx_prev", "ctx_next", F.col("prediction").alias("_p1"))
    prev = model["prev"].select("ctx_prev", F.col("prediction").alias("_p2"))
    both = ["ctx_prev", "ctx_next"]
    out = split_join(ex, pair, both, heavy_keys(ex, both))
    out = split_join(out, prev, ["ctx_prev"], heavy_keys(ex, ["ctx_prev"]))
    glob = F.lit(model["global"]).cast("string")
    level = (F.when(F.col("_p1").isNotNull(), "pair").when(F.col("_p2").isNotNull(), "prev")
             .when(glob.isNotNull(), "global").otherwise("none"))
    return (out.withColumn("prediction", F.coalesce("_p1", "_p2", glob)).withColumn("level", level)
               .drop("_p1", "_p2", "ctx_prev", "ctx_next"))


def predict_batch(examples: DataFrame, make_predict_fn: Callable[[], Callable], input_col: str = "input",
                  keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """L1: score masked inputs with a user model: ``make_predict_fn()`` runs once per task and
    returns ``f(list[str]) -> list[str]``; batches come as Arrow record batches."""
    keep = [k for k in keep if k in examples.columns]
    schema = T.StructType([examples.schema[k] for k in keep] + [T.StructField("prediction", T.StringType())])

    def run(batches):
        fn = make_predict_fn()
        for pdf in batches:
            preds = [None if p is None else str(p).strip() for p in fn(pdf[input_col].tolist())]
            out = pdf[keep].copy()
            out["prediction"] = preds
            yield out
    return examples.select(*keep, input_col).mapInPandas(run, schema)
