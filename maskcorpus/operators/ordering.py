"""Reproducible shuffles, dense global positions and splits.

Randomness is a key: ``sha256("seed:key")``. Equal seeds give equal permutations
in any engine, so the oracle can check them by value.

Exact splits need no sort: a slice of the permutation ends at a key, the k-th
smallest, which is found from counts per leading hash digits (at most 65,536
counters a level) and then exactly inside the one prefix that holds it. Rows
are labelled by comparing their key with the cut keys; no row moves.

``global_index`` orders keys only: distinct keys are range-partitioned, numbered
inside each partition and written once; a vector of partition counts gives the
offsets, and rows get their position by a join on the key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskcorpus.functions.text import seeded_key
from maskcorpus.session import written_once

SHUFFLE_KEY = "shuffle_key"
#: Hash digits per level of the search for a cut, and the rows a prefix may hold to be searched directly.
PREFIX_DIGITS = 4
DIRECT_ROWS = 4096
#: Distinct keys up to which the positions of ``global_index`` may be broadcast (some 200 bytes each).
BROADCAST_KEYS = 100_000


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _numbered(rows: DataFrame, names: list[str], num_partitions: int | None, what: str) -> DataFrame:
    """``rows`` range-partitioned by ``names`` and written once, with the partition (``_pid``) and the place in it (``_mid``)."""
    parted = rows.repartitionByRange(num_partitions, *names) if num_partitions else rows.repartitionByRange(*names)
    return written_once(parted.sortWithinPartitions(*names).withColumn("_pid", F.spark_partition_id())
                        .withColumn("_mid", F.monotonically_increasing_id()), what)


def _before(sums: dict[int, int]) -> tuple[Column, int]:
    """(sum of all earlier partitions as a column over ``_pid``, sum of all).

    The numbers are one literal string, split once by constant folding: the plan stays small with many partitions.
    """
    offsets, total = [], 0
    for p in range(max(sums) + 1):
        offsets.append(total)
        total += sums.get(p, 0)
    table = F.split(F.lit(",".join(str(v) for v in offsets)), ",")
    return F.element_at(table, F.col("_pid") + 1).cast("long"), total


def prefix_sum(df: DataFrame, order: Sequence[str], value: str, name: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` (whole numbers) over all rows before a row in ``order``.

    Two levels: rows are range-partitioned by ``order`` and written once, each
    partition is summed on its own, the sums of earlier partitions come as one
    folded literal, and a running sum inside each partition gives the rest. No
    task reads more than its range. Rows that are equal in ``order`` follow one
    another in arbitrary order; null values count as 0; an empty frame stays empty.
    """
    numbered = _numbered(df, list(order), num_partitions, "ranges")
    sums = {r["_pid"]: r["s"] for r in numbered.groupBy("_pid").agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("s")).collect()}
    if not sums:
        return df.withColumn(name, F.lit(0).cast("long"))
    start, _ = _before(sums)
    inside = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.withColumn(name, (start + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long")).select(*df.columns, name)


def global_index(df: DataFrame, order: Sequence, name: str = "idx",
                 num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Add a dense 0-based position in ``order``; return ``(frame, row count)``.

    Only the order columns are sorted and written; the other columns move once,
    in the join that brings the positions back. Rows with equal keys get
    consecutive positions in arbitrary order.
    """
    o = _cols(order)
    names = [f"_o{i}" for i in range(len(o))]
    keys = df.select(*[c.alias(n) for c, n in zip(o, names)]).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    numbered = _numbered(keys, names, num_partitions, "index")
    stats = numbered.groupBy("_pid").agg(F.sum("_n").alias("n"), F.max("_n").alias("most"), F.count(F.lit(1)).alias("keys")).collect()
    if not stats:
        return df.withColumn(name, F.lit(0).cast("long")), 0
    start, total = _before({r["_pid"]: r["n"] for r in stats})
    repeats = max(r["most"] for r in stats) > 1
    if repeats:
        before = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
        at = start + F.coalesce(F.sum("_n").over(before), F.lit(0))
    else:
        at = start + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    index = numbered.select(*[F.col(n).alias(f"{n}r") for n in names], at.alias(name))
    keyed = df.select("*", *[c.alias(n) for c, n in zip(o, names)])
    same = None
    for n in names:
        eq = F.col(n).eqNullSafe(F.col(f"{n}r"))
        same = eq if same is None else same & eq
    # files of sorted keys are far smaller than their rows in memory, so their size must not make them a broadcast
    out = keyed.join(index.hint("merge") if sum(r["keys"] for r in stats) > BROADCAST_KEYS else index, same)
    if repeats:
        own = Window.partitionBy(*names).orderBy(F.lit(0))
        out = out.withColumn(name, F.col(name) + F.row_number().over(own) - 1)
    return out.select(*df.columns, name), total


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "idx") -> tuple[DataFrame, int]:
    """C4 + C5: position of each row in the permutation ordered by sha256("seed:key"), key."""
    keyed = df.withColumn(SHUFFLE_KEY, seeded_key(seed, key))
    out, n = global_index(keyed, [SHUFFLE_KEY, key], name)
    return out.drop(SHUFFLE_KEY), n


def cut_keys(df: DataFrame, key: str, ranks: Callable[[int], Sequence[int]], seed: int = 42) -> tuple[int, list]:
    """(row count, cuts) for the permutation by sha256("seed:key"), key.

    ``ranks`` gives the wanted numbers of rows below each cut from the row
    count. A cut is the (hash, key) of the first row that is not below it, or
    None where all rows are. Only the key column is read, and written once, as
    it may come from a long plan. Rows that repeat a key stay on one side of a
    cut, the upper one.
    """
    rows = written_once(df.select(seeded_key(seed, key).alias("h"), F.col(key).alias("k")), "keys")

    def counted(rows: DataFrame, digits: int) -> list:
        got = rows.groupBy(F.substring("h", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        return sorted((r["p"], r["n"]) for r in got)

    digits = PREFIX_DIGITS
    level = counted(rows, digits)
    total = sum(n for _, n in level)
    wanted = list(ranks(total))
    # per cut: the prefix that holds it, the rows before the prefix and the rows in it
    place: dict[int, tuple[str, int, int]] = {}

    def locate(level: list, cuts: list[int], before: int) -> None:
        for p, n in level:
            for i in cuts:
                if before <= wanted[i] < before + n:
                    place[i] = (p, before, n)
            before += n

    locate(level, list(range(len(wanted))), 0)
    while digits < 64 and any(n > DIRECT_ROWS for _, _, n in place.values()):
        digits += PREFIX_DIGITS
        inside = rows.where(F.substring("h", 1, digits - PREFIX_DIGITS).isin([p for p, _, _ in place.values()]))
        level = counted(inside, digits)
        for i, (p, before, _) in list(place.items()):
            locate([x for x in level if x[0].startswith(p)], [i], before)
    held: dict[str, list] = {}
    if place:
        near = rows.where(F.substring("h", 1, digits).isin([p for p, _, _ in place.values()]))
        for r in near.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n")).collect():
            held.setdefault(r["h"][:digits], []).append((r["h"], r["k"], r["n"]))
    cuts: list = []
    for i in range(len(wanted)):
        cut = None
        if i in place:
            p, upto, _ = place[i]
            for h, k, n in sorted(held[p]):
                upto += n
                if upto > wanted[i]:
                    cut = (h, k)
                    break
        cuts.append(cut)
    return total, cuts


def label_by_cuts(key: str, cuts: Sequence, names: Sequence[str], rest: str | None, seed: int = 42) -> Column:
    """The first of ``names`` whose cut lies above the row's key; ``rest`` above all cuts."""
    h = seeded_key(seed, key)
    out = None
    for cut, nm in zip(cuts, names):
        below = F.lit(True) if cut is None else (h < cut[0]) | ((h == cut[0]) & (F.col(key) < F.lit(cut[1])))
        out = F.when(below, F.lit(nm)) if out is None else out.when(below, F.lit(nm))
    return out.otherwise(F.lit(rest)) if out is not None else F.lit(rest)


def _running(sizes: Sequence[int]) -> list[int]:
    out, total = [], 0
    for s in sizes:
        total += s
        out.append(total)
    return out


def split_counts(df: DataFrame, key: str, counts: Sequence[int], names: Sequence[str],
                 seed: int = 42, rest: str = "unused", col: str = "split") -> DataFrame:
    """H1: first ``counts[0]`` of the permutation -> ``names[0]``, the next ``counts[1]`` -> ``names[1]``, ...

    Rows past the last slice are kept and labelled ``rest`` (the reference leaves them unused).
    """
    _, cuts = cut_keys(df, key, lambda n: _running(counts), seed)
    return df.withColumn(col, label_by_cuts(key, cuts, names, rest, seed))


def fraction_sizes(n: int, fractions: Sequence[float]) -> list[int]:
    """``int(n * f)`` per fraction, as the reference computes them (float arithmetic)."""
    return [int(n * f) for f in fractions]


def split_fractions(df: DataFrame, key: str, fractions: Sequence[float] = (0.8, 0.1),
                    names: Sequence[str] = ("train", "val", "test"), seed: int = 42,
                    col: str = "split", once: bool = False) -> DataFrame:
    """H2: train ``int(n*.8)``, val ``int(n*.1)``, test the remainder, over a seeded permutation.

    ``once``: ``df`` is the end of a costly plan (not a table). It is then run
    once and its rows are written; the cuts are found from the key column of
    what was written, and the labels are given to the rows read back.
    """
    df = written_once(df, "rows") if once else df
    _, cuts = cut_keys(df, key, lambda n: _running(fraction_sizes(n, fractions)), seed)
    return df.withColumn(col, label_by_cuts(key, cuts, names[:-1], names[-1], seed))


def holdout(df: DataFrame, key: str, test_fraction: float = 0.05, seed: int = 42,
            col: str = "split", once: bool = False) -> DataFrame:
    """H3: ``ceil(n * f)`` rows to ``test`` (first in the permutation), the rest to ``train``; ``once`` as in ``split_fractions``."""
    df = written_once(df, "rows") if once else df
    _, cuts = cut_keys(df, key, lambda n: [math.ceil(test_fraction * n)], seed)
    return df.withColumn(col, label_by_cuts(key, cuts, ["test"], "train", seed))


def hash_bucket(key, seed: int = 42, buckets: int = 10_000) -> Column:
    """Bucket in [0, buckets) from the first 32 bits of sha256("seed:key")."""
    h = F.conv(F.substring(seeded_key(seed, key), 1, 8), 16, 10).cast("long")
    return h % buckets


def split_hash(df: DataFrame, key: str, fractions: Sequence[float] = (0.8, 0.1),
               names: Sequence[str] = ("train", "val", "test"), seed: int = 42,
               col: str = "split", buckets: int = 10_000) -> DataFrame:
    """H4: sort-free split by hash bucket; stable as data grows; keyed by function it removes the Q17 leak."""
    b = hash_bucket(key, seed, buckets)
    out, edge = None, 0
    for f, nm in zip(fractions, names):
        edge += int(round(f * buckets))
        out = F.when(b < edge, F.lit(nm)) if out is None else out.when(b < edge, F.lit(nm))
    return df.withColumn(col, out.otherwise(F.lit(names[-1])))
