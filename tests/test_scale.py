"""What must not grow with the input: broadcasts, Arrow batches and the learner's arrays."""

import os
import tracemalloc
import zipfile

import numpy as np
from pyspark.sql import functions as F

from maskcorpus import session
from maskcorpus.operators import bpe, ordering, pair_state
from maskcorpus.operators.extract import extracted_from_archives


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_of_archives_are_never_joined(spark, tmp_dir):
    """Ranks meet the listing: a join behind the reader was planned as a broadcast of all texts."""
    for k in range(3):
        with zipfile.ZipFile(os.path.join(tmp_dir, f"a{k}.zip"), "w") as z:
            z.writestr("x.py", f"def f{k}(x):\n    if x:\n        pass\n")
            z.writestr("y.py", "def (")
    with open(os.path.join(tmp_dir, "a3.zip"), "wb") as fh:
        fh.write(b"no archive")
    big = 2**53 + 1  # lost where whole numbers become floats beside a null
    ranks = [(f"file:{tmp_dir}/a0.zip", big), (f"file:{tmp_dir}/a1.zip", None), (f"file:{tmp_dir}/a1.zip", 7), (f"file:{tmp_dir}/a3.zip", 9)]
    out = extracted_from_archives(spark, tmp_dir, spark.createDataFrame(ranks, "path string, repo_rank long"))
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("Join" in x for x in lines[:min(i for i, x in enumerate(lines) if "MapInPandas" in x)])
    assert out.columns[-1] == "repo_rank" and out.schema["repo_rank"].dataType.typeName() == "long"
    got = sorted((str(r.path)[-6:], str(r.member), r.status, str(r.repo_rank)) for r in out.collect())
    assert got == sorted([("a0.zip", "x.py", "ok", str(big)), ("a0.zip", "y.py", "syntax_error", str(big)),
                          ("a1.zip", "x.py", "ok", "None"), ("a1.zip", "y.py", "syntax_error", "None"),
                          ("a1.zip", "x.py", "ok", "7"), ("a1.zip", "y.py", "syntax_error", "7"), ("a3.zip", "None", "bad_archive", "9")])


def test_many_positions_are_not_broadcast(spark, monkeypatch):
    rows = spark.range(500).select((F.col("id") % 100).alias("k"), "id")
    monkeypatch.setattr(ordering, "BROADCAST_KEYS", 99)
    out, n = ordering.global_index(rows, ["k"], "i")
    assert n == 500 and "Broadcast" not in _plan(out) and sorted(r.i for r in out.collect()) == list(range(500))
    monkeypatch.setattr(ordering, "BROADCAST_KEYS", 100)
    assert "BroadcastHashJoin" in _plan(ordering.global_index(rows, ["k"], "i")[0])


def _peak(run) -> float:
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_a_shard_is_never_laid_out_whole():
    """Counting pairs and triples of all words took some 100 bytes a symbol."""
    rng = np.random.default_rng(1)
    words = pair_state.Words(rng.integers(0, 40, (120_000, 9)).tolist(), [1] * 120_000)
    pairs, _ = words.counts()
    assert _peak(words.counts) < 50 and _peak(lambda: words.triples(pairs[:64])) < 50
    assert bpe.SHARD_WORDS <= 120_000


def test_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    listed = [rng.integers(0, 5, n).tolist() for n in rng.integers(1, 9, 400)]
    got = []
    for block in (1, 64, 1 << 20):
        monkeypatch.setattr(pair_state, "BLOCK", block)
        words = pair_state.Words(listed, list(range(1, 401)))
        got.append([x.tolist() for y in (words.counts(), words.apply([(0, 1, 5), (5, 5, 6)]), words.triples(words.counts()[0]), words.counts()) for x in y])
    assert got[0] == got[1] == got[2]


def test_batches_of_texts_are_bounded_by_bytes(spark):
    """Ten thousand rows of any length made one batch, held several times by each Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    bpe.word_frequencies(spark.range(1).select(F.lit("a b").alias("text")))
    assert int(spark.conf.get(key).rstrip("b")) == session.ARROW_BYTES
    spark.conf.set(key, "1000")
    session.bounded_batches(spark)
    assert spark.conf.get(key).rstrip("b") == "1000"
    spark.conf.unset(key)


def test_words_are_kept_over_batches():
    """A task segments a word once, not once a batch."""
    from types import SimpleNamespace

    import pandas as pd

    from maskcorpus.operators import encode

    class Counting(encode.Encoder):
        calls = 0

        def word_ids(self, word):
            self.calls += 1
            return [self.calls]

    model = bpe.BpeModel(["<pad>", "<unk>", "</s>"], ["a", "b"], [])
    ids = encode._ids_udf(SimpleNamespace(value=Counting(model))).func
    batches = [pd.Series([["abab"], ["abab", "b"]]) for _ in range(5)]
    assert [x for got in ids(iter(batches)) for x in got] == [[1], [1, 2]] * 5
