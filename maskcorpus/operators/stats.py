"""Counts and rates over stage outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_at_least(df: DataFrame, n: int) -> bool:
    """Is the row count at least ``n``? Reads at most ``n`` rows."""
    return df.limit(n).count() >= n


def split_sizes(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows per split label."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def masking_success_rate(functions: DataFrame, examples: DataFrame, num_ifs: str = "num_ifs") -> DataFrame:
    """Share of ``if``s that yielded an example: ``n_ifs, n_examples, rate``.

    One pass over a tagged union: no join between the two single-row aggregates.
    """
    both = functions.select(F.col(num_ifs).cast("long").alias("i"), F.lit(0).cast("long").alias("e")).unionByName(
        examples.select(F.lit(0).cast("long").alias("i"), F.lit(1).cast("long").alias("e")))
    agg = both.agg(F.coalesce(F.sum("i"), F.lit(0).cast("long")).alias("n_ifs"),
                   F.coalesce(F.sum("e"), F.lit(0).cast("long")).alias("n_examples"))
    return agg.withColumn("rate", F.coalesce(F.try_divide(F.col("n_examples").cast("double"), F.col("n_ifs")), F.lit(0.0)))


def functions_per_group(df: DataFrame, group: str = "repo_key", out: str = "n_functions") -> DataFrame:
    """Rows per group (per-repo function totals feeding the take-until cut)."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias(out))
