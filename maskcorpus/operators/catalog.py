"""Repository catalog: filter, project, rank, and the take-until-target cut
(SURVEY B1-B3, C1, C2, I7, K3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskcorpus.config import DEFAULT_BRANCH, LICENSE_ALLOW


def filter_catalog(df: DataFrame, language: str = "Python", min_stars: int = 10) -> DataFrame:
    """B1: the search query's terms: language, stars >= min, no forks, not archived."""
    return df.where((F.col("language") == language) & (F.col("stars") >= min_stars)
                    & ~F.col("fork") & ~F.col("archived"))


def filter_license(df: DataFrame, allow: Sequence[str] = LICENSE_ALLOW, col: str = "license") -> DataFrame:
    """B2: SPDX allow-list; a null licence is dropped."""
    return df.where(F.col(col).isin(list(allow)))


def project_repos(df: DataFrame, keep: Sequence[str] = ("repo_key", "stars")) -> DataFrame:
    """``owner, repo, html_url, license, default_branch`` (branch falls back to main)."""
    return df.select(*keep, "owner", "repo", "html_url", "license",
                     F.coalesce(F.col("default_branch"), F.lit(DEFAULT_BRANCH)).alias("default_branch"))


def top_repos(df: DataFrame, k: int | None = None, stars: str = "stars", tie: str = "repo_key",
              rank: str = "repo_rank") -> DataFrame:
    """The ``k`` most-starred repos (after the licence filter), ranked 1..k; None ranks all of them.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject (each partition keeps
    its own top k); the rank window then runs over at most ``k`` rows.
    """
    if k is None:
        from maskcorpus.operators.ordering import global_index
        out, _ = global_index(df, [-F.col(stars), tie], rank)
        return out.withColumn(rank, F.col(rank) + 1)
    top = df.orderBy(F.col(stars).desc(), F.col(tie).asc()).limit(k)
    w = Window.orderBy(F.col(stars).desc(), F.col(tie).asc())
    return top.withColumn(rank, F.row_number().over(w).cast("long"))


def take_until(ranked: DataFrame, counts: DataFrame, target: int, rank: str = "repo_rank",
               key: str = "repo_key", n: str = "n_functions") -> DataFrame:
    """Whole groups in rank order while the total *before* the group is below ``target`` (Q11).

    ``counts`` is the per-group count (I7); groups without one count 0. The
    totals are a two-level prefix sum (``ordering.prefix_sum``), so any number
    of groups may be ranked.
    """
    from maskcorpus.operators.ordering import prefix_sum
    g = ranked.join(counts, key, "left").withColumn(n, F.coalesce(F.col(n), F.lit(0).cast("long")))
    return prefix_sum(g, [rank], n, "functions_before").where(F.col("functions_before") < target)


def keep_groups(rows: DataFrame, kept: DataFrame, key: str = "repo_key") -> DataFrame:
    """K3: rows whose group survived the cut (left semi join on the group key)."""
    return rows.join(kept.select(key), key, "left_semi")
