"""A2: repository archives -> one row per source member.

``binaryFile`` reads each archive as one row (path + bytes); an Arrow-batched
``mapInPandas`` opens it with ``zipfile`` and yields its ``.py`` members,
UTF-8 decoded with invalid bytes dropped. A member or archive that cannot be
read yields a status row instead of failing the job. Members are then spread
round-robin so one huge repository does not keep one task busy for the
extraction that follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskcorpus.config import SOURCE_SUFFIX

MEMBER = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("member", T.StringType()),
    T.StructField("member_ord", T.IntegerType()), T.StructField("code", T.StringType()),
    T.StructField("status", T.StringType()),
])


def _members(batches, suffix: str = SOURCE_SUFFIX):
    import io
    import zipfile

    import pandas as pd
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for i, info in enumerate(z.infolist()):
                        if not info.filename.endswith(suffix):
                            continue
                        try:
                            with z.open(info) as fh:
                                code = fh.read().decode("utf-8", errors="ignore")
                            rows.append((path, info.filename, i, code, "ok"))
                        except Exception:  # noqa: BLE001 - bad member: report, continue
                            rows.append((path, info.filename, i, None, "bad_member"))
            except Exception:  # noqa: BLE001 - bad archive: report, continue
                rows.append((path, None, -1, None, "bad_archive"))
        yield pd.DataFrame(rows, columns=[f.name for f in MEMBER.fields])


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip", suffix: str = SOURCE_SUFFIX,
                  num_partitions: int | None = None, split_members: bool = True, only: DataFrame | None = None,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Every ``suffix`` member of every archive under ``path``: ``path, member, member_ord, code, status``.

    ``split_members`` (default): members of one archive are read by many tasks
    (see ``read_archives_split``). Otherwise each archive is read whole by one task.
    ``only(path)`` names the archives to read; others are not opened. Its columns ``carry`` are
    added to every member (a path that it names twice gives its members twice); they need ``split_members``.
    """
    if split_members:
        return read_archives_split(spark, path, glob, suffix, num_partitions, only, carry)
    if carry:
        raise ValueError("carry needs split_members")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    if only is not None:
        raw = raw.join(only.select("path").distinct(), "path", "left_semi")
    out = raw.mapInPandas(lambda it: _members(it, suffix), MEMBER)
    return out.repartition(num_partitions) if num_partitions else out.hint("rebalance")


LISTING = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("member", T.StringType()),
    T.StructField("member_ord", T.IntegerType()), T.StructField("size", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _open(path: str):
    """Random-access handle for a Spark file path (local, HDFS, S3... as pyarrow supports)."""
    from pyarrow import fs
    filesystem, p = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return filesystem.open_input_file(p)


def _list_members(batches, suffix: str):
    import zipfile

    import pandas as pd
    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            try:
                with _open(path) as fh, zipfile.ZipFile(fh) as z:  # reads the central directory only
                    for i, info in enumerate(z.infolist()):
                        if info.filename.endswith(suffix):
                            rows.append((path, info.filename, i, int(info.compress_size), "ok"))
            except Exception:  # noqa: BLE001 - bad archive: report, continue
                rows.append((path, None, -1, 0, "bad_archive"))
        yield pd.DataFrame(rows, columns=[f.name for f in LISTING.fields])


#: Decoded text that a task holds before it hands rows on.
BATCH_BYTES = 16_000_000
#: Archives whose central directories one task reads.
LISTED_ARCHIVES = 200
#: Compressed bytes of members that one task reads.
TASK_BYTES = 64_000_000


def _read_members(batches, carry: list[str]):
    import zipfile

    import pandas as pd
    columns = [f.name for f in MEMBER.fields] + carry
    for pdf in batches:
        rows, held = [], 0
        for path, grp in pdf.groupby("path", sort=False):
            todo = []
            for member, ordinal, status, *more in zip(*(grp[c] for c in ("member", "member_ord", "status", *carry))):
                if status == "ok":
                    todo.append((member, int(ordinal), more))
                else:
                    rows.append((path, None, -1, None, status, *more))
            if not todo:
                continue
            read = 0
            try:
                with _open(path) as fh, zipfile.ZipFile(fh) as z:  # one open per archive per batch
                    infos = z.infolist()
                    for member, ordinal, more in todo:
                        try:
                            with z.open(infos[ordinal]) as m:
                                code = m.read().decode("utf-8", errors="ignore")
                            rows.append((path, member, ordinal, code, "ok", *more))
                            held += len(code)
                        except Exception:  # noqa: BLE001 - bad member: report, continue
                            rows.append((path, member, ordinal, None, "bad_member", *more))
                        read += 1
                        if held >= BATCH_BYTES:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
            except Exception:  # noqa: BLE001
                rows += [(path, member, ordinal, None, "bad_archive", *more) for member, ordinal, more in todo[read:]]
        yield pd.DataFrame(rows, columns=columns)


def listing_tasks(spark: SparkSession, n_archives: int) -> int:
    """Tasks that read central directories: LISTED_ARCHIVES each, and all cores where there are archives for them."""
    return max(1, min(n_archives, spark.sparkContext.defaultParallelism), -(-n_archives // LISTED_ARCHIVES))


def read_archives_split(spark: SparkSession, path: str, glob: str = "*.zip", suffix: str = SOURCE_SUFFIX,
                        num_partitions: int | None = None, only: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Archives read member by member, so one huge repository is decompressed by many tasks.

    1. list archive paths (``binaryFile`` with the content column pruned: no bytes
       read), and keep those of ``only(path)`` if given: no other archive is opened;
    2. list each archive's members from its central directory, once, into a small table, by
       ``listing_tasks`` tasks;
    3. deal the members by ``(path, member_ord)`` over as many tasks as their bytes ask
       for: a hot archive's members land on every task;
    4. each task opens its archives with random access, reads only its members and
       hands rows on every BATCH_BYTES.

    Columns ``carry`` of ``only`` meet the narrow listing, before any text is read: a join
    behind the reader would take the texts for as small as the listing and broadcast them.
    """
    from maskcorpus.session import written_once
    paths = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    if only is not None:
        paths = paths.join(only.select("path").distinct(), "path", "left_semi")
    # an explicit number of partitions is not coalesced: a list of paths is tiny, but opening archives is not
    paths = written_once(paths.withColumn("deal", F.xxhash64("path")), "archives")
    dealt = paths.repartitionByRange(listing_tasks(spark, paths.count()), "deal").select("path")
    listing = written_once(dealt.mapInPandas(lambda it: _list_members(it, suffix), LISTING), "members")
    if num_partitions is None:
        size = listing.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        num_partitions = max(spark.sparkContext.defaultParallelism, -(-int(size) // TASK_BYTES))
    todo, carry = listing.select("path", "member", "member_ord", "status"), list(carry)
    if carry:  # as strings through Python, where a null would turn whole numbers into floats
        todo = todo.hint("merge").join(only.select("path", *[F.col(c).cast("string").alias(c) for c in carry]), "path")
    todo = todo.repartition(num_partitions, "path", "member_ord").sortWithinPartitions("path", "member_ord")
    schema = T.StructType(MEMBER.fields + [T.StructField(c, T.StringType()) for c in carry])
    members = todo.mapInPandas(lambda it: _read_members(it, carry), schema)
    return members.select(*MEMBER.names, *[F.col(c).cast(only.schema[c].dataType).alias(c) for c in carry]) if carry else members


def filter_members(df: DataFrame, suffix: str = SOURCE_SUFFIX, col: str = "member") -> DataFrame:
    """Keep members by name suffix."""
    return df.where(F.col(col).endswith(suffix))
