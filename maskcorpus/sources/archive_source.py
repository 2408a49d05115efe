"""A2 as a data source: ``spark.read.format("repo_archives").load(folder)``, one row per member of the zip archives.

Partitions are planned from the sizes of the archive files alone, so planning
opens none of them: small archives share a partition, a large one is cut into
as many parts as its bytes ask for. A task reads the central directory of its
archive and takes the members whose bytes fall into its part, so listing and
reading are both spread. Filters on ``path`` (equality, list) choose archives
before anything is opened, those on ``member`` (ending, beginning, equality)
choose members before anything is decompressed.

Options: ``suffix`` (default ``.py``; empty for all members), ``glob`` (default
``*.zip``), ``partitionBytes``.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, StringEndsWith, StringStartsWith

from maskcorpus.config import SOURCE_SUFFIX
from maskcorpus.sources.archives import BATCH_BYTES, MEMBER, TASK_BYTES

ARROW = pa.schema([("path", pa.string()), ("member", pa.string()), ("member_ord", pa.int32()), ("code", pa.string()), ("status", pa.string())])


@dataclass
class Part(InputPartition):
    """Archives (path as Spark writes it, path in its file system) read whole, or the ``part``-th of ``parts`` shares of one."""

    archives: list
    part: int = 0
    parts: int = 1


@dataclass
class Chosen:
    """What the pushed filters leave; None: everything."""

    paths: set | None = None
    members: list = field(default_factory=list)

    def member(self, name: str) -> bool:
        return all(test(name, value) for test, value in ((getattr(str, t) if t else _equal, v) for t, v in self.members))


def _equal(name: str, value: str) -> bool:
    return name == value


def shares(sizes: list[int], parts: int) -> list[int]:
    """The part of each member: members in order, cut where the bytes before them pass another 1 / ``parts`` of all."""
    total, before, out = sum(sizes) + len(sizes), 0, []
    for size in sizes:
        out.append(min(parts - 1, before * parts // total))
        before += size + 1
    return out


def planned(files: list[tuple[str, str, int]], part_bytes: int) -> list[Part]:
    """Partitions of about ``part_bytes`` bytes for archives (name, path, size)."""
    out, held, size = [], [], 0
    for name, path, n in sorted(files):
        if n > part_bytes:
            parts = -(-n // part_bytes)
            out += [Part([(name, path)], k, parts) for k in range(parts)]
            continue
        if held and size + n > part_bytes:
            out.append(Part(held))
            held, size = [], 0
        held.append((name, path))
        size += n
    return out + ([Part(held)] if held else [])


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.chosen = options, Chosen()

    def pushFilters(self, filters) -> Iterator:
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column == "path" and isinstance(f, (EqualTo, In)):
                paths = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.chosen.paths = paths if self.chosen.paths is None else self.chosen.paths & paths
            elif column == "member" and isinstance(f, (StringEndsWith, StringStartsWith, EqualTo)):
                self.chosen.members.append(("endswith" if isinstance(f, StringEndsWith) else "startswith" if isinstance(f, StringStartsWith) else None, f.value))
                # a broken archive has a row without a member: Spark drops it
                yield f
            else:
                yield f

    def partitions(self) -> list[Part]:
        from pyarrow import fs
        uri = self.options["path"]
        local = uri.startswith("file:") or "://" not in uri
        system, base = fs.FileSystem.from_uri("file://" + "/" + uri.removeprefix("file:").lstrip("/") if local else uri)
        front = "file:" if local else uri[:uri.index(base)] if base in uri else uri.split("://")[0] + "://"
        info = system.get_file_info(base)
        infos = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base, recursive=True))
        glob = self.options.get("glob", "*.zip")
        files = [(front + i.path, (front if not local else "file://") + i.path, i.size) for i in infos
                 if i.type == fs.FileType.File and fnmatch.fnmatch(i.base_name, glob) and not i.base_name.startswith(("_", "."))]
        files = [f for f in files if self.chosen.paths is None or f[0] in self.chosen.paths]
        return planned(files, int(self.options.get("partitionbytes", self.options.get("partitionBytes", TASK_BYTES)))) or [Part([])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        import zipfile

        from pyarrow import fs
        suffix = self.options.get("suffix", SOURCE_SUFFIX)
        rows, held = [], 0
        for name, path in partition.archives:
            try:
                system, base = fs.FileSystem.from_uri(path)
                with system.open_input_file(base) as fh, zipfile.ZipFile(fh) as z:
                    infos = z.infolist()
                    own = shares([i.compress_size for i in infos], partition.parts)
                    for at, info in enumerate(infos):
                        if own[at] != partition.part or not info.filename.endswith(suffix) or not self.chosen.member(info.filename):
                            continue
                        try:
                            with z.open(info) as m:
                                code, status = m.read().decode("utf-8", errors="ignore"), "ok"
                        except Exception:  # noqa: BLE001 - bad member: report, continue
                            code, status = None, "bad_member"
                        rows.append((name, info.filename, at, code, status))
                        held += len(code or "")
                        if held >= BATCH_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
            except Exception:  # noqa: BLE001 - bad archive: report once, continue
                if partition.part == 0:
                    rows.append((name, None, -1, None, "bad_archive"))
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)


class ArchiveSource(DataSource):
    """``repo_archives``: path, member, member_ord, code, status (``ok``, ``bad_member``, ``bad_archive``)."""

    @classmethod
    def name(cls) -> str:
        return "repo_archives"

    def schema(self):
        return MEMBER

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def register_archives(spark: SparkSession) -> None:
    """Make the source known to a session, with pushdown of filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveSource)
