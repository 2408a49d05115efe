"""Token corruption and its properties."""

import numpy as np
from pyspark.sql import functions as F

from maskcorpus.operators.corrupt import corrupt_tokens, doc_seed, min_tokens, mix32, mix32_np, sample_positions


def _docs(spark, texts):
    return spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "id long, tokens array<string>")


def test_mixer_spark_equals_numpy(spark):
    xs = [0, 1, 2, 12345, 2**31 - 1, 2**32 - 1, 3735928559]
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    got = [r[0] for r in df.select(mix32(F.col("x"))).collect()]
    assert got == [int(v) for v in mix32_np(np.array(xs, dtype=np.uint64))]
    assert len(set(int(v) for v in mix32_np(np.arange(100_000, dtype=np.uint64)))) == 100_000  # bijective


def test_positions_count_sorted_distinct(spark):
    texts = [" ".join(f"w{j}" for j in range(n)) for n in (10, 11, 57, 999, 5000)]
    out = sample_positions(_docs(spark, texts), "tokens", "id").collect()
    for r in out:
        n = len(r["tokens"])
        p = r["positions"]
        assert len(p) == max(1, int(n * 0.15)) and p == sorted(set(p)) and all(0 <= x < n for x in p)


def test_corrupt_then_fill_restores_tokens(spark):
    texts = [" ".join(f"t{j}" for j in range(n)) for n in (10, 33, 800)]
    for r in corrupt_tokens(_docs(spark, texts), "tokens", "id").collect():
        inp, tgt = r["input"].split(" "), r["target"].split(" ")
        fill = dict(zip(tgt[0::2], tgt[1::2]))
        assert [fill.get(x, x) for x in inp] == r["tokens"]
        sentinels = tgt[0::2]
        assert sentinels == [f"<extra_id_{i}>" for i in range(len(sentinels))]  # own sentinel each, unbounded


def test_more_than_100_masks_keep_counting(spark):
    text = " ".join(f"x{j}" for j in range(1000))
    r = corrupt_tokens(_docs(spark, [text]), "tokens", "id").first()
    assert "<extra_id_149>" in r["target"] and "<extra_id_150>" not in r["target"]


def test_min_tokens_and_reproducible(spark):
    df = _docs(spark, ["a b c", " ".join(f"y{j}" for j in range(40))])
    assert min_tokens(df, "tokens", 10).count() == 1
    long_ = df.where(F.size("tokens") >= 10)
    a = corrupt_tokens(long_, "tokens", "id", seed=7).first()
    b = corrupt_tokens(long_, "tokens", "id", seed=7).first()
    c = corrupt_tokens(long_, "tokens", "id", seed=8).first()
    assert a == b and a["target"] != c["target"]


def test_corrupt_plan_has_no_shuffle(spark):
    df = _docs(spark, ["a b c d e f g h i j k"])
    plan = corrupt_tokens(df, "tokens", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_doc_seed_is_32_bit(spark):
    r = spark.range(5).select(doc_seed(42, "id").alias("s")).collect()
    assert all(0 <= x["s"] < 2**32 for x in r)
