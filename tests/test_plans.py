"""Plan shape at scale: no single-partition funnel, map-side combine before shuffles, pruned scans."""

from pyspark.sql import functions as F

from maskcorpus.operators import ordering
from maskcorpus.operators.bpe import word_frequencies
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_index_never_funnels_through_one_partition(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # small data would be coalesced to one partition by AQE, as it should
    try:
        df = spark.range(0, 20000).select((F.col("id") * 7 % 20011).alias("k"))
        out, n = ordering.global_index(df, ["k"], "i")
        assert n == 20000
        assert "SinglePartition" not in _plan(out)
        # the range shuffle keeps many partitions: positions are assigned in parallel
        assert out.rdd.getNumPartitions() > 1
        got = sorted((r["k"], r["i"]) for r in out.collect())
        assert [i for _, i in got] == list(range(20000))
    finally:
        spark.conf.set(key, old)


def test_word_counts_combine_map_side(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = _plan(word_frequencies(docs, "text"))
    assert "partial_count" in plan and plan.index("partial_count") > plan.index("Exchange")  # partial below the shuffle


def test_scan_reads_only_needed_columns(spark):
    import __spark_entry__ as E
    df = E.queries()["mask_after_keyword"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_global_index_with_many_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.range(0, 30000).select((F.col("id") * 13 % 30011).alias("k"))
        out, n = ordering.global_index(df, ["k"], "i", num_partitions=2000)
        assert n == 30000
        assert out.agg(F.min("i"), F.max("i"), F.countDistinct("i")).first() == (0, 29999, 30000)
        assert out.where(F.col("k") == 0).first()["i"] == 0
    finally:
        spark.conf.set(key, old)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_exact_splits_move_no_payload(spark):
    rows = spark.createDataFrame([(i, "x" * 50, "y" * 50) for i in range(500)], "id long, input string, target string")
    for out in (ordering.split_counts(rows, "id", [100, 50], ["a", "b"]), ordering.split_fractions(rows, "id"),
                ordering.holdout(rows, "id")):
        plan = _plan(out)
        assert "Exchange" not in plan and "Sort" not in plan and "ExistingRDD[checkpoint" not in plan
        assert out.count() == 500


def test_global_index_sorts_keys_only(spark, monkeypatch):
    written = []
    keep = ordering.written_once
    monkeypatch.setattr(ordering, "written_once", lambda df, name: written.append(df.columns) or keep(df, name))
    rows = spark.createDataFrame([(i % 90, "x" * 50) for i in range(300)], "k long, code string")
    out, n = ordering.global_index(rows, ["k"], "i")
    assert n == 300 and written == [["_o0", "_n", "_pid", "_mid"]]  # no code column
    got = [(r["k"], r["i"]) for r in out.orderBy("i").collect()]
    assert [i for _, i in got] == list(range(300)) and [k for k, _ in got] == sorted(k for k, _ in got)  # ties are consecutive


def test_masking_splits_a_function_once(spark):
    import __spark_entry__ as E
    plan = _optimized(E.queries()["mask_conditions"](spark, SF_SMALL))
    assert plan.count("split(") == 1  # the code of a function, below the generator


def test_corruption_tokenises_once(spark):
    import __spark_entry__ as E
    plan = _optimized(E.queries()["corrupt_tokens"](spark, SF_SMALL))
    assert plan.count("split(") == 1, plan


def test_spreading_is_one_plan_at_every_size(spark):
    from maskcorpus.session import spread_rows
    small, large = (_optimized(spread_rows(spark.range(0, n, 1, p).selectExpr("id", "id as text"))) for n, p in ((10, 1), (10**6, 64)))
    assert "RebalancePartitions" in small and "RebalancePartitions" in large


def test_splits_run_their_input_once(spark, tmp_dir):
    """Masking and sampling are in the job that writes the rows, and neither in the search for cuts nor in the labels."""
    from pyspark.sql import types as T
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    rows = spark.range(0, 3000, 1, 4).selectExpr("cast(id as string) id", "repeat('x', 20) input").mapInArrow(
        counted, T.StructType([T.StructField("id", T.StringType()), T.StructField("input", T.StringType())]))
    want = ordering.split_fractions(spark.range(3000).selectExpr("cast(id as string) id"), "id").collect()
    got = ordering.split_fractions(rows, "id", once=True)
    assert sorted((r.id, r.split) for r in got.collect()) == sorted(map(tuple, want)) and ran.value == 3000
    assert "MapInArrow" not in _plan(got)
    held = ordering.holdout(rows, "id", once=True)
    assert held.where("split = 'test'").count() == 150 and ran.value == 6000


def test_registered_splits_mask_and_sample_once(spark):
    import __spark_entry__ as E
    for name in ("split_80_10_10", "holdout_95_5"):
        plan = _optimized(E.queries()[name](spark, SF_SMALL))
        assert "split(" not in plan and "ArrowEvalPython" not in plan, name  # labels are read from what was written
