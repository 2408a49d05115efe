"""Catalog reading, filters, ranking and the take-until cut."""

import json
import os

from maskcorpus.operators import catalog
from maskcorpus.sources.catalog import read_repo_catalog


def _page(items, page=1):
    return {"page": page, "items": items}


def _item(name, stars, lic="MIT", branch="dev", fork=False, archived=False, lang="Python"):
    it = {"name": name, "html_url": f"https://x/{name}", "language": lang, "stargazers_count": stars,
          "fork": fork, "archived": archived, "owner": {"login": "o"}}
    if lic is not None:
        it["license"] = {"spdx_id": lic}
    if branch is not None:
        it["default_branch"] = branch
    return it


def test_read_filter_project_rank(spark, tmp_dir):
    pages = [_page([_item("a", 50), _item("b", 5), _item("c", 70, lic=None), _item("d", 90, lic="GPL-3.0")], 1),
             _page([_item("e", 60, branch=None), _item("f", 80, fork=True), _item("g", 75, lang="Go")], 2)]
    for i, p in enumerate(pages):
        with open(os.path.join(tmp_dir, f"p{i}.json"), "w") as fh:
            json.dump(p, fh)
    df = read_repo_catalog(spark, tmp_dir)
    kept = catalog.project_repos(catalog.filter_license(catalog.filter_catalog(df)))
    ranked = catalog.top_repos(kept, k=10).orderBy("repo_rank").collect()
    assert [(r["repo"], r["default_branch"]) for r in ranked] == [("e", "main"), ("a", "dev")]


def test_top_k_plan_and_take_until(spark):
    repos = spark.createDataFrame([(i, 100 - i) for i in range(10)], "repo_key long, stars long")
    top = catalog.top_repos(repos, k=5)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    counts = spark.createDataFrame([(0, 4), (1, 4), (2, 4), (3, 4)], "repo_key long, n_functions long")
    kept = catalog.take_until(top, counts, target=9).orderBy("repo_rank").collect()
    # before-group totals 0, 4, 8 are below 9: three whole repos, 12 functions > target (Q11)
    assert [r["repo_key"] for r in kept] == [0, 1, 2]


def test_pages_of_every_layout(spark, tmp_dir):
    """Several pages per file, a list of pages, one page over many lines; no page field; nothing is lost."""
    def pages(k):
        return [{"items": [_item(f"r{k}_{i}_{j}", 10 + j) for j in range(2)]} for i in range(3)]
    with open(os.path.join(tmp_dir, "a.json"), "w") as fh:
        fh.write("\n".join(json.dumps(p) for p in pages(0)) + "\n\n")
    with open(os.path.join(tmp_dir, "b.json"), "w") as fh:
        json.dump(pages(1), fh)
    with open(os.path.join(tmp_dir, "c.json"), "w") as fh:
        json.dump(pages(2)[0], fh, indent=2)
    with open(os.path.join(tmp_dir, "d.json"), "w") as fh:
        fh.write("")
    rows = read_repo_catalog(spark, tmp_dir).orderBy("repo_key").collect()
    assert [r["repo"] for r in rows] == [f"r{k}_{i}_{j}" for k, n in ((0, 3), (1, 3), (2, 1)) for i in range(n) for j in range(2)]
    assert len({r["repo_key"] for r in rows}) == 14 and all(r["repo_key"] for r in rows)
    lines = read_repo_catalog(spark, os.path.join(tmp_dir, "a.json"), layout="lines")
    assert lines.count() == 6


def test_a_broken_page_fails(spark, tmp_dir):
    import pytest
    with open(os.path.join(tmp_dir, "a.json"), "w") as fh:
        fh.write('{"items": [\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_repo_catalog(spark, tmp_dir).collect()


def test_rank_without_a_cut(spark):
    repos = spark.createDataFrame([(f"k{i}", i % 4) for i in range(10)], "repo_key string, stars long")
    ranked = catalog.top_repos(repos).orderBy("repo_rank").collect()
    assert [r["repo_rank"] for r in ranked] == list(range(1, 11))
    assert [(-r["stars"], r["repo_key"]) for r in ranked] == sorted((-(i % 4), f"k{i}") for i in range(10))


def test_take_until_over_many_partitions(spark):
    import random

    from pyspark.sql import functions as F
    rng = random.Random(3)
    counts = [(f"k{i}", rng.choice([None, 0, 1, 5, 40])) for i in range(3000)]
    ranked = spark.range(0, 3000, 1, 7).select((F.col("id") + 1).alias("repo_rank"), F.concat(F.lit("k"), (F.col("id") * 7 % 3000).cast("string")).alias("repo_key"))
    n = dict(counts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = catalog.take_until(ranked, spark.createDataFrame(counts, "repo_key string, n_functions long"), 9000)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.repo_rank, r.repo_key, r.n_functions, r.functions_before) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, before = [], 0
    for i in range(3000):
        key = f"k{i * 7 % 3000}"
        if before < 9000:
            want.append((i + 1, key, n[key] or 0, before))
        before += n[key] or 0
    assert got == want and 100 < len(got) < 3000
    assert "SinglePartition" not in plan
    assert catalog.take_until(ranked.limit(0), spark.createDataFrame(counts, "repo_key string, n_functions long"), 5).collect() == []


def test_prefix_sum(spark):
    from maskcorpus.operators.ordering import prefix_sum
    rows = [(i % 50, f"x{i}", i if i % 3 else None) for i in range(400)]
    out = prefix_sum(spark.createDataFrame(rows, "a long, b string, v long").repartition(6), ["a", "b"], "v", "before").collect()
    total = 0
    for r in sorted(out, key=lambda r: (r.a, r.b)):
        assert r.before == total
        total += r.v or 0
    assert len(out) == 400
