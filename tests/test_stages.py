"""Sources, stage materialisation, the incremental stream and the whole pipeline."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from maskcorpus.config import Params
from maskcorpus.operators.extract import extract_functions, filter_length
from maskcorpus.operators.stats import count_at_least
from maskcorpus.plans.stages import is_complete, materialize, progress_report, run_pipeline
from maskcorpus.sources.archives import read_archives
from maskcorpus.sources.files import read_benchmark, read_functions, read_vocab, write_functions, write_vocab

CODE = "def f(x):\n    if x > 1:\n        return 1\n    return 0\n"


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())


def test_archives_to_functions(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "r1.zip"), {"r1/a.py": CODE, "r1/README.md": "x", "r1/b.py": b"def g(y):\n    if y:\n        pass\n\xff"})
    _zip(os.path.join(tmp_dir, "r2.zip"), {"r2/c.py": "def h(:\n"})
    with open(os.path.join(tmp_dir, "bad.zip"), "wb") as fh:
        fh.write(b"not a zip")
    members = read_archives(spark, tmp_dir)
    st = sorted(((r["member"], r["status"]) for r in members.collect()), key=lambda t: (t[0] or "", t[1]))
    assert st == [(None, "bad_archive"), ("r1/a.py", "ok"), ("r1/b.py", "ok"), ("r2/c.py", "ok")]
    funcs = extract_functions(members.where(F.col("status") == "ok"), ("path", "member"))
    assert sorted(r["code"].split("(")[0] for r in funcs.collect()) == ["def f", "def g"]
    import hashlib

    from maskcorpus.operators.extract import functions_from_archives
    repos = spark.createDataFrame([(f"file:{tmp_dir}/r1.zip", 2), (f"file:{tmp_dir}/r2.zip", 1)], "path string, repo_rank long")
    with_ids = functions_from_archives(spark, tmp_dir, repos).orderBy("repo_rank", "member_ord", "fn_ord").collect()
    assert [r["member"] for r in with_ids] == ["r1/a.py", "r1/b.py"]
    assert [r["id"] for r in with_ids] == [hashlib.sha256(f"{i}:{r['code'][:100]}".encode()).hexdigest()
                                           for i, r in enumerate(with_ids)]


def test_functions_jsonl_round_trip_and_length_filter(spark, tmp_dir):
    f = spark.createDataFrame([("i1", CODE, [("x > 1", 2, 3)], 1, 5)],
                              "id string, code string, if_statements array<struct<condition:string,line:int,depth:int>>, num_ifs int, lines int")
    path = os.path.join(tmp_dir, "fn")
    write_functions(f, path, fmt="json")
    back = read_functions(spark, path)
    assert back.first()["if_statements"][0]["condition"] == "x > 1"
    assert filter_length(back, 5, 500).count() == 1 and filter_length(back, 6, 500).count() == 0
    assert count_at_least(back, 1) and not count_at_least(back, 2)


def test_benchmark_csv_multiline(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bench.csv")
    with open(path, "w") as fh:
        fh.write('id,code,other\n1,"def f(x):\n    if x == ""a"":\n        pass",z\n2,,y\n')
    rows = read_benchmark(spark, path).collect()
    assert [r["code"] for r in rows] == ['def f(x):\n    if x == "a":\n        pass']


def test_materialize_skips_when_complete(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stage")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    assert not is_complete(spark, path)
    materialize(spark, "s", build, path)
    materialize(spark, "s", build, path)
    assert len(calls) == 1 and is_complete(spark, path, min_rows=5) and not is_complete(spark, path, min_rows=6)
    rep = progress_report(spark, {"s": path, "missing": os.path.join(tmp_dir, "nope")}).collect()
    assert {(r["stage"], r["complete"], r["rows"]) for r in rep} == {("s", True, 5), ("missing", False, None)}


def test_incremental_stream_processes_new_files_once(spark, tmp_dir):
    from maskcorpus.streaming.incremental import incremental_examples
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    schema = "id string, code string, if_statements array<struct<condition:string,line:int,depth:int>>, num_ifs int, lines int"
    spark.createDataFrame([("a", CODE, [("x > 1", 2, 3)], 1, 5)], schema).write.parquet(os.path.join(src, "b1"))
    incremental_examples(spark, os.path.join(src, "*"), out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2  # one corrupted function, one masked condition
    spark.createDataFrame([("b", CODE.replace("x > 1", "x < 0"), [("x < 0", 2, 3)], 1, 5)], schema).write.parquet(os.path.join(src, "b2"))
    incremental_examples(spark, os.path.join(src, "*"), out, ck).awaitTermination()
    both = spark.read.parquet(out)
    got = both.where("kind = 'finetune'")
    assert both.count() == 4 and both.groupBy("func_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert got.count() == 2 and {r["target"] for r in got.collect()} == {"x > 1", "x < 0"}


def test_landing_again_gives_no_second_example(spark, tmp_dir):
    """State outlives the query: the same function in a third file, and twice in one, adds no row after a restart."""
    from maskcorpus.streaming.incremental import incremental_examples
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    schema = "id string, code string, if_statements array<struct<condition:string,line:int,depth:int>>, num_ifs int, lines int"
    one, two = (("a", CODE, [("x > 1", 2, 3)], 1, 5), ("b", CODE.replace("x > 1", "x < 0"), [("x < 0", 2, 3)], 1, 5))
    seen = []
    for k, rows in enumerate(([one, one], [two], [one], [two, one])):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(src, f"b{k}"))
        incremental_examples(spark, os.path.join(src, "*"), out, ck).awaitTermination()
        seen.append(spark.read.parquet(out).count())
    assert seen == [2, 4, 4, 4]
    assert spark.read.parquet(out).select("kind", "id").distinct().count() == 4


def test_run_pipeline_end_to_end(spark, tmp_dir):
    from __spark_entry__ import SMOKE_DIR
    from maskcorpus.plans.queries import functions_with_ids
    p = Params(pretrain_target=100, finetune_target=100, vocab_size=250, max_length=64)
    out = run_pipeline(spark, lambda: functions_with_ids(spark, SMOKE_DIR), os.path.join(tmp_dir, "run"), p)
    kinds = {r["kind"] for r in out["datasets"].select("kind").distinct().collect()}
    assert kinds == {"pretrain", "finetune"}
    enc = out["encoded"].first()
    assert len(enc["input_ids"]) == 64 and enc["input_ids"][0] == 2
    m = out["metrics"].first()
    assert m["total"] == out["results"].count() and 0.0 <= m["accuracy"] <= 1.0
    write_vocab(out["vocab"], out["merges"], os.path.join(tmp_dir, "tok"))
    model = read_vocab(spark, os.path.join(tmp_dir, "tok"))
    assert model.tokens() == [r["token"] for r in out["vocab"].orderBy("id").collect()]
    assert [(a, b) for a, b, _ in model.merges] == [(r["left"], r["right"]) for r in out["merges"].orderBy("rank").collect()]


def test_archives_are_listed_by_several_tasks(spark, tmp_dir, monkeypatch):
    from maskcorpus.sources import archives as A
    for i in range(40):
        _zip(os.path.join(tmp_dir, f"r{i}.zip"), {f"r{i}/a.py": CODE})
    seen = []
    keep = A._list_members

    def counted(batches, suffix):
        from pyspark import TaskContext
        for pdf in keep(batches, suffix):
            pdf["member"] = pdf["member"] + f"|{TaskContext.get().partitionId()}"
            yield pdf
    dealt = A.listing_tasks(spark, 40)
    assert dealt == min(40, spark.sparkContext.defaultParallelism) and A.listing_tasks(spark, 10 ** 6) == 5000 and A.listing_tasks(spark, 0) == 1
    monkeypatch.setattr(A, "_list_members", counted)
    import maskcorpus.session as S
    write = S.written_once
    monkeypatch.setattr(S, "written_once", lambda df, name: seen.append((name, write(df, name))) or seen[-1][1])
    A.read_archives(spark, tmp_dir)
    rows = [r.member.split("|") for r in dict(seen)["members"].collect()]
    by_task = {t: sum(x[1] == t for x in rows) for _, t in rows}
    assert len(rows) == 40 and len(by_task) >= min(6, dealt) and max(by_task.values()) <= 12


def test_split_reader_spreads_one_hot_archive(spark, tmp_dir):
    members = {f"big/m{i:03d}.py": f"def f{i}(x):\n    if x > {i}:\n        return {i}\n" for i in range(120)}
    members["big/notes.txt"] = "skip me"
    _zip(os.path.join(tmp_dir, "big.zip"), members)
    _zip(os.path.join(tmp_dir, "small.zip"), {"s/a.py": CODE})
    split = read_archives(spark, tmp_dir, num_partitions=8)
    whole = read_archives(spark, tmp_dir, split_members=False)
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    tasks = split.where(F.col("path").endswith("big.zip")).groupBy(F.spark_partition_id()).count().count()
    assert tasks > 1  # the hot archive's members were read by several tasks


def test_examples_and_metrics_files(spark, tmp_dir):
    import json as _json

    from maskcorpus.operators.evaluate import assemble_metrics
    from maskcorpus.sources.files import read_examples, write_examples, write_metrics
    ex = spark.createDataFrame([("a", "in1", "t1", "train"), ("b", "in\n2", 't"2', "test"), (None, "p", "q", "pretrain")],
                               "id string, input string, target string, split string")
    path = os.path.join(tmp_dir, "examples")
    write_examples(ex, path, fmt="json")
    assert sorted(f for f in os.listdir(path) if not f.startswith(".")) == ["_SUCCESS", "split=pretrain", "split=test", "split=train"]
    back = read_examples(spark, os.path.join(path, "split=test"))
    assert [tuple(r) for r in back.collect()] == [("b", "in\n2", 't"2')]
    gen = spark.createDataFrame([(1.0, 2, 2)], "accuracy double, exact_match long, total long")
    mpath = os.path.join(tmp_dir, "metrics")
    write_metrics(assemble_metrics(gen, None), mpath)
    txt = [f for f in os.listdir(mpath) if f.startswith("part-")]
    with open(os.path.join(mpath, txt[0])) as fh:
        assert _json.loads(fh.read()) == {"generated_testset": {"accuracy": 1.0, "exact_match": 2, "total": 2},
                                          "provided_testset": None}


def test_unselected_archives_are_never_opened(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "r1.zip"), {"r1/a.py": CODE})
    with open(os.path.join(tmp_dir, "bad.zip"), "wb") as fh:
        fh.write(b"not a zip")  # would give a bad_archive row if it were opened
    only = spark.createDataFrame([(f"file:{tmp_dir}/r1.zip", 1)], "path string, repo_rank long")
    for split in (True, False):
        rows = read_archives(spark, tmp_dir, split_members=split, only=only).collect()
        assert [(r["member"], r["status"]) for r in rows] == [("r1/a.py", "ok")]


def test_second_run_learns_nothing_and_keeps_every_stage(spark, tmp_dir, monkeypatch):
    from __spark_entry__ import SMOKE_DIR
    from maskcorpus.operators import bpe
    from maskcorpus.plans.queries import _functions_table, table
    p = Params(vocab_size=215, max_length=32, pretrain_target=60, finetune_target=40)
    root = os.path.join(tmp_dir, "run")

    def run():
        return run_pipeline(spark, lambda: _functions_table(spark, SMOKE_DIR), root, p,
                            benchmark=lambda: table(spark, SMOKE_DIR, "benchmark_code").select("code"))
    first = run()
    left = {r["part"]: r["n"] for r in first["left_out"].collect()}
    assert left["pretrain"] == 60 and left["finetune"] == 40 and left["unused"] == first["functions"].count() - 100
    splits = {(r["kind"], r["split"]): r["count"] for r in first["encoded"].groupBy("kind", "split").count().collect()}
    assert {("pretrain", "train"), ("pretrain", "test"), ("finetune", "train"), ("finetune", "val")} == set(splits)
    assert splits["pretrain", "test"] == -(-sum(n for (k, _), n in splits.items() if k == "pretrain") * 5 // 100)
    before = [r.asDict() for r in first["all_metrics"].collect()]

    def refuse(*a, **k):
        raise AssertionError("the vocabulary was learned again")
    monkeypatch.setattr(bpe, "learn_bpe", refuse)
    monkeypatch.setattr(bpe, "word_frequencies", refuse)
    second = run()
    assert [r.asDict() for r in second["all_metrics"].collect()] == before
    assert {"examples", "generated-testset.csv", "provided-testset.csv", "metrics.json"} <= set(os.listdir(root))


def test_every_archive_is_read(spark):
    from __spark_entry__ import SMOKE_DIR, queries
    registered = queries()
    want = {(f"src/f{r.file_no}.py", r.fn_ord) for r in registered["extract_functions"](spark, SMOKE_DIR).collect()}
    got = [(r.member, r.fn_ord) for r in registered["functions_from_all_archives"](spark, SMOKE_DIR).collect()]
    assert set(got) == want and len(got) == len(want)


def test_pipeline_metrics_encodes_with_a_learned_vocabulary(spark, monkeypatch):
    from __spark_entry__ import SMOKE_DIR, queries
    from maskcorpus.plans import stages
    seen = {}
    run = stages.run_pipeline
    monkeypatch.setattr(stages, "run_pipeline", lambda *a, **k: seen.update(run(*a, **k)) or seen)
    assert queries()["pipeline_metrics"](spark, SMOKE_DIR).count() == 1
    assert seen["vocab"].count() == 660 and seen["merges"].count() > 300
    sizes = seen["encoded"].select(F.size("input_ids"), F.size("labels")).distinct().collect()
    assert [tuple(r) for r in sizes] == [(512, 512)]


def _rows(df):
    return sorted(df.collect(), key=str)


def test_changed_stage_is_rebuilt(spark, tmp_dir):
    import pytest

    from maskcorpus.plans import manifest as M
    path, source = os.path.join(tmp_dir, "stage"), os.path.join(tmp_dir, "in")
    spark.range(5).write.parquet(source)
    calls = []

    def run(seed, fail=False):
        def build():
            calls.append(seed)
            df = spark.read.parquet(source).selectExpr("id", f"{seed} as seed")
            return df.selectExpr("id", "if(id = 3, raise_error('stopped'), 1) as seed") if fail else df
        return materialize(spark, "s", build, path, depends={"seed": seed, "in": M.listing(spark, [source])}).count()

    assert run(1) == 5 and run(1) == 5 and calls == [1]
    assert run(2) == 5 and calls == [1, 2]
    spark.range(3).write.mode("append").parquet(source)  # a landed file
    assert run(2) == 8 and run(2) == 8 and calls == [1, 2, 2]
    found = M.read_manifest(spark, path)
    assert found["rows"] == 8 and found["name"] == "s" and is_complete(spark, path, 8) and not is_complete(spark, path, 9)
    with pytest.raises(Exception, match="stopped"):
        run(3, fail=True)  # a stage that broke off is no stage
    assert run(3) == 8 and calls[-1] == 3
    os.remove(os.path.join(path, M.MANIFEST))  # ended before the manifest was written
    assert run(3) == 8 and calls[-2:] == [3, 3]
    with open(os.path.join(path, M.MANIFEST), "w") as f:
        f.write('{"key": "')
    assert M.read_manifest(spark, path) is None and run(3) == 8 and len(calls) == 7


def test_changed_run_equals_a_fresh_one(spark, tmp_dir):
    from __spark_entry__ import SMOKE_DIR
    from maskcorpus.plans import manifest as M
    from maskcorpus.plans.queries import _functions_table
    first = Params(vocab_size=240, max_length=32)
    other = Params(vocab_size=246, max_length=32, seed=7)
    functions = _functions_table(spark, SMOKE_DIR).persist()
    folder, fresh = os.path.join(tmp_dir, "run"), os.path.join(tmp_dir, "fresh")

    def run(root, p):
        return run_pipeline(spark, lambda: functions, root, p, inputs=[f"{SMOKE_DIR}/documents.parquet"])

    def written():
        return {d: M.read_manifest(spark, os.path.join(folder, d))["key"] + str(os.stat(os.path.join(folder, d, M.MANIFEST)).st_mtime_ns)
                for d in os.listdir(folder) if d != "metrics.json"}

    run(folder, first)
    before = written()
    run(folder, first)
    assert written() == before  # nothing was written again
    changed, want = run(folder, other), run(fresh, other)
    for name in ("functions", "left_out", "datasets", "vocab", "merges", "encoded", "results", "all_metrics"):
        assert _rows(changed[name]) == _rows(want[name]), name
    assert {d for d, x in written().items() if x == before[d]} == {"functions"}
    functions.unpersist()


def test_counts_are_observed_while_rows_are_written(spark, tmp_dir):
    """Manifest counts equal those of a run of their own, and reading them starts no job."""
    from __spark_entry__ import SMOKE_DIR
    from maskcorpus.plans import stages as S
    from maskcorpus.plans.manifest import read_manifest
    from maskcorpus.plans.queries import _functions_table
    functions = _functions_table(spark, SMOKE_DIR).persist()
    p = Params(pretrain_target=90, finetune_target=40)
    path, parts = os.path.join(tmp_dir, "datasets"), S.Observation()
    ds = S.materialize(spark, "datasets", lambda: S.build_datasets(functions, p, parts), path, partition_by="kind", depends={},
                       counts=S.count_values("split", ("train", "val", "test")), seen=parts)
    found = read_manifest(spark, path)
    assert found["rows"] == ds.count()
    spark.sparkContext.setJobGroup("observed", "reads manifests only")
    left, splits = S.observed(spark, path, "part", "seen"), S.observed(spark, path, "split")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("observed")
    spark.sparkContext.setJobGroup("", "")
    assert _rows(left) == _rows(S.cut_report(functions, p)) and left.count() == 3
    assert {r.split: r.n for r in splits.collect()} == {r.split: r["count"] for r in ds.groupBy("split").count().collect()}
    functions.unpersist()


def test_every_status_is_counted(spark, tmp_dir):
    from maskcorpus.operators.extract import STATUSES, extract_all, extraction_report
    from maskcorpus.plans import stages as S
    files = spark.createDataFrame([(1, CODE), (2, "def ("), (3, None), (4, "x = 1")], "file_no long, code string")
    path = os.path.join(tmp_dir, "extracted")
    rows = S.materialize(spark, "extracted", lambda: extract_all(files, ("file_no",)), path, counts=S.count_values("status", STATUSES))
    assert _rows(S.observed(spark, path, "status")) == _rows(extraction_report(rows))
