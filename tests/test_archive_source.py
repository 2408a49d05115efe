"""The archive data source against the archive reader."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from maskcorpus.sources import archive_source as S
from maskcorpus.sources.archives import read_archives


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())


@pytest.fixture()
def folder(spark, tmp_dir):
    S.register_archives(spark)
    _zip(os.path.join(tmp_dir, "big.zip"), {f"big/m{i:03d}.py": f"x = {i}\n" * 200 for i in range(120)} | {"big/notes.txt": "skip"})
    _zip(os.path.join(tmp_dir, "small.zip"), {"s/a.py": b"def g(y):\n    pass\n\xff", "s/b.md": "x"})
    _zip(os.path.join(tmp_dir, "empty.zip"), {})
    os.mkdir(os.path.join(tmp_dir, "sub"))
    _zip(os.path.join(tmp_dir, "sub", "deep.zip"), {"d/é.py": "z = 1"})
    with open(os.path.join(tmp_dir, "bad.zip"), "wb") as fh:
        fh.write(b"not a zip")
    with open(os.path.join(tmp_dir, "other.txt"), "w") as fh:
        fh.write("no archive")
    return tmp_dir


def _load(spark, folder, **options):
    return spark.read.format("repo_archives").options(**options).load(folder)


def test_rows_equal_the_reader(spark, folder):
    want = sorted(map(str, read_archives(spark, folder).union(read_archives(spark, os.path.join(folder, "sub"))).collect()))
    for size in ("64000000", "20000", "500"):
        got = _load(spark, folder, partitionBytes=size)
        assert sorted(map(str, got.collect())) == want, size
    every = _load(spark, folder, suffix="").where("status = 'ok'")
    assert every.count() == 124


def test_a_large_archive_is_read_by_several_tasks(spark, folder):
    rows = _load(spark, folder, partitionBytes="20000").where(F.col("path").endswith("big.zip"))
    by_task = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) > 3 and sum(by_task) == 120 and max(by_task) <= 2 * min(by_task) + 2


def test_filters_choose_before_opening(spark, folder):
    one = f"file:{folder}/small.zip"
    rows = _load(spark, folder).where(F.col("path") == one)
    assert [r.member for r in rows.collect()] == ["s/a.py"]
    _load(spark, folder).where(F.col("member").startswith("big/m01")).count()
    assert _load(spark, folder).where(F.col("member").startswith("big/m01")).count() == 10
    assert _load(spark, folder).where(F.col("member").endswith("9.py") & F.col("path").isin(one, f"file:{folder}/big.zip")).count() == 12
    # an unselected archive is not opened: reading it would give its fault row
    reader = S.ArchiveReader({"path": folder})
    left = list(reader.pushFilters([S.EqualTo(("path",), one), S.StringEndsWith(("member",), "a.py")]))
    assert len(left) == 1 and [p.archives for p in reader.partitions()] == [[(one, f"file://{folder}/small.zip")]]
    none = S.ArchiveReader({"path": folder})
    assert list(none.pushFilters([S.In(("path",), ("a",)), S.EqualTo(("path",), one)])) == [] and [p.archives for p in none.partitions()] == [[]]


def test_planning():
    files = [("a", "a", 10), ("b", "b", 10), ("c", "c", 95), ("d", "d", 5)]
    parts = S.planned(files, 20)
    assert [(len(p.archives), p.part, p.parts) for p in parts] == [(1, 0, 5), (1, 1, 5), (1, 2, 5), (1, 3, 5), (1, 4, 5), (2, 0, 1), (1, 0, 1)]
    assert S.planned([], 20) == []
    for sizes, n in (([5] * 100, 7), ([1000, 1, 1, 1], 3), ([0, 0], 4), ([], 2)):
        got = S.shares(sizes, n)
        assert got == sorted(got) and len(got) == len(sizes) and all(0 <= k < n for k in got)


def test_empty_folder(spark, tmp_dir):
    S.register_archives(spark)
    assert _load(spark, tmp_dir).collect() == []
