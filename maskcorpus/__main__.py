"""Run the whole pipeline: ``python -m maskcorpus --pages DIR --archives DIR --out DIR [--benchmark CSV]``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from maskcorpus.config import Params


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="maskcorpus", description=__doc__)
    ap.add_argument("--pages", required=True, help="folder of landed repository-search pages (JSON)")
    ap.add_argument("--archives", required=True, help="folder of repository archives named <owner>__<repo>.zip")
    ap.add_argument("--out", required=True, help="output folder (stage tables, results, metrics.json)")
    ap.add_argument("--benchmark", help="optional benchmark CSV with a code column")
    ap.add_argument("--max-repos", type=int, help="most-starred repositories to keep (default: all)")
    ap.add_argument("--vocab-size", type=int, default=Params.vocab_size)
    ap.add_argument("--pretrain", type=int, help="functions for pre-training (default: a share of all)")
    ap.add_argument("--finetune", type=int, help="functions for fine-tuning (default: the others)")
    ap.add_argument("--target", type=int, help="stop after the repository that reaches so many functions (default: no cut)")
    ap.add_argument("--seed", type=int, default=Params.seed)
    a = ap.parse_args(argv)

    from maskcorpus.operators import catalog
    from maskcorpus.operators.extract import STATUSES, extracted_from_archives, functions_of
    from maskcorpus.operators.stats import functions_per_group
    from maskcorpus.plans.manifest import listing
    from maskcorpus.plans.stages import Stages, count_values, materialize, observed, run_pipeline
    from maskcorpus.session import build_session, clear_written
    from maskcorpus.sources.catalog import read_repo_catalog
    from maskcorpus.sources.files import read_benchmark

    p = Params(max_repos=a.max_repos, vocab_size=a.vocab_size, pretrain_target=a.pretrain,
               finetune_target=a.finetune, total_functions_target=a.target, seed=a.seed)
    spark = build_session()
    repos = catalog.top_repos(catalog.project_repos(catalog.filter_license(catalog.filter_catalog(
        read_repo_catalog(spark, a.pages), p.language, p.min_stars), p.licenses)), k=p.max_repos)
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(a.archives).select("path")
    names = archives.withColumn("name", F.regexp_extract("path", r"([^/]+)__([^/]+)\.zip$", 0))
    st = Stages(a.out)
    landed = {"pages": listing(spark, [a.pages]), "archives": listing(spark, [a.archives])}
    chosen = {**landed, "language": p.language, "min_stars": p.min_stars, "licenses": p.licenses, "max_repos": p.max_repos}
    # written once: every later use sees the same ranks
    ranked = materialize(spark, "ranked", lambda: repos.join(names, F.col("name") == F.concat("owner", F.lit("__"), "repo", F.lit(".zip"))),
                         st.path("ranked"), depends=chosen)

    def functions():
        found = materialize(spark, "extracted", lambda: extracted_from_archives(spark, a.archives, ranked.select("path", "repo_rank")),
                            st.path("extracted"), depends=chosen, counts=count_values("status", STATUSES))
        # counted while the extraction was written
        report = observed(spark, st.path("extracted"), "status")
        materialize(spark, "extraction_report", lambda: report, st.path("extraction_report"), depends=chosen).show()
        if p.total_functions_target is not None:
            # whole repos in rank order while the total before each is below the target (Q11)
            with_ifs = found.where((F.col("status") == "ok") & (F.col("num_ifs") > 0))
            kept = catalog.take_until(ranked.select("repo_rank"), functions_per_group(with_ifs, "repo_rank"),
                                      p.total_functions_target, key="repo_rank")
            found = found.join(kept.select("repo_rank"), "repo_rank", "left_semi")
        return functions_of(found)

    bench = (lambda: read_benchmark(spark, a.benchmark)) if a.benchmark else None
    out = run_pipeline(spark, functions, a.out, p, benchmark=bench, inputs=[a.pages, a.archives], chosen=chosen)
    out["left_out"].show()
    out["all_metrics"].show(truncate=False)
    clear_written(spark)


if __name__ == "__main__":
    main()
