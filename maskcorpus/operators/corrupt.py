"""Token corruption for pre-training examples.

Per row: rank token positions by a seeded integer hash, keep the
``max(1, n*15 div 100)`` smallest, and replace each kept token with its own
sentinel ``<extra_id_j>`` (j = rank among kept positions, no span merging,
unbounded j). All array work stays inside one narrow projection: no explode,
no shuffle, O(n log n) per row with primitive sorts only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskcorpus.functions.text import mask_budget, py_split, seeded_key, sentinel


def min_tokens(df: DataFrame, tokens: str = "tokens", n: int = 10) -> DataFrame:
    """Drop rows with fewer than ``n`` tokens."""
    return df.where(F.size(tokens) >= n)


_M32 = 4294967296  # 2**32
_MUL = 73244475     # odd 27-bit multiplier: products stay below 2**63, no overflow


def doc_seed(seed: int, key) -> Column:
    """32-bit per-row seed: the first 8 hex digits of sha256("seed:key") (one hash per row)."""
    return F.conv(F.substring(seeded_key(seed, key), 1, 8), 16, 10).cast("long")


def mix32(x: Column) -> Column:
    """A bijective 32-bit integer mixer (xor-shift-multiply, twice): distinct inputs, distinct outputs."""
    x = (F.shiftright(x, 16).bitwiseXOR(x) * _MUL) % _M32
    x = (F.shiftright(x, 16).bitwiseXOR(x) * _MUL) % _M32
    return F.shiftright(x, 16).bitwiseXOR(x)


def mix32_np(x):
    """numpy twin of ``mix32`` (uint64 arithmetic, same constants, same results)."""
    import numpy as np
    x = x.astype(np.uint64)
    m = np.uint64(_M32 - 1)
    x = (((x >> np.uint64(16)) ^ x) * np.uint64(_MUL)) & m
    x = (((x >> np.uint64(16)) ^ x) * np.uint64(_MUL)) & m
    return (x >> np.uint64(16)) ^ x


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _pick(n, k, seed):
    """Per row: the ``k`` positions of ``0..n-1`` with the smallest ``mix32(seed xor i)``, ascending; null for k below 0.

    Only two numbers per row cross into Python; numpy does the per-token work.
    """
    import numpy as np
    import pandas as pd

    def one(nn, kk, ss):
        if kk < 0:
            return None
        if nn <= 0:
            return np.zeros(0, dtype=np.int32)
        h = mix32_np(np.arange(nn, dtype=np.uint64) ^ np.uint64(ss))
        sel = np.argpartition(h, kk - 1)[:kk] if kk < nn else np.arange(nn)
        return np.sort(sel).astype(np.int32)
    return pd.Series([one(int(a), int(b), int(c)) for a, b, c in zip(n, k, seed)])


# The optimizer must not copy the sampler into filters further down, where it and the tokenisation would run again.
_pick = _pick.asNondeterministic()


def sample_positions(df: DataFrame, tokens: str = "tokens", key: str = "id", seed: int = 42,
                     rate_percent: int = 15, out: str = "positions", min_n: int = 0) -> DataFrame:
    """F1 (+ B6): ``max(1, int(n*rate))`` distinct positions without replacement, ascending.

    Rows of fewer than ``min_n`` tokens go: the sampler answers null for them
    and the filter is on its answer, so it stays above the one tokenisation.

    Position ``i`` ranks by ``mix32(seed32 xor i)`` with ``seed32`` from one
    sha256 per row; the mixer is a bijection, so ranks never tie.
    """
    n = F.size(tokens)
    k = F.when(n >= min_n, mask_budget(n, rate_percent)).otherwise(-1)
    picked = df.withColumn(out, _pick(n, k, doc_seed(seed, key)))
    return picked.where(F.col(out).isNotNull()) if min_n else picked


def corrupt_tokens(df: DataFrame, tokens: str = "tokens", key: str = "id", seed: int = 42,
                   rate_percent: int = 15, min_n: int = 0) -> DataFrame:
    """add ``input`` (tokens with sentinels) and ``target`` (sentinel, token, sentinel, token ...).

    ``input`` is built from the slices between consecutive masked positions,
    O(n + k). Needs at least one token per row (``min_n``, as the reference).
    """
    s = sample_positions(df, tokens, key, seed, rate_percent, "_pos", min_n)
    tok, pos = F.col(tokens), F.col("_pos")
    n, k = F.size(tokens), F.size("_pos")

    def piece(j):
        start = F.when(j == 0, F.lit(1)).otherwise(F.get(pos, j - 1) + 2)
        stop = F.when(j < k, F.get(pos, j)).otherwise(n)  # exclusive, 0-based
        run = F.slice(tok, start, stop - start + 1)
        return F.when(j < k, F.concat(run, F.array(sentinel(j)))).otherwise(run)

    inp = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), k), piece)), " ")
    tgt = F.array_join(F.transform(pos, lambda p, j: F.concat(sentinel(j), F.lit(" "), F.get(tok, p))), " ")
    return s.withColumn("input", inp).withColumn("target", tgt).drop("_pos")


def pretrain_examples(functions: DataFrame, code: str = "code", key: str = "id", seed: int = 42,
                      rate_percent: int = 15, min_n: int = 10) -> DataFrame:
    """The reference's pre-training example builder: ``code.split()`` -> filter -> corrupt."""
    t = functions.withColumn("tokens", py_split(code))
    return corrupt_tokens(t, "tokens", key, seed, rate_percent, min_n).drop("tokens")
