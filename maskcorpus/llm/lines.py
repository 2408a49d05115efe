"""Line dedup with two Bloom filters, once seen and twice seen, and an exact check of suspected repeats.

1. Sketch: every task packs the 64-bit hashes of its documents' distinct keys
   (stripped, lower-cased lines) by the hash's leading bits. Eight bytes a key
   are written; texts do not move.
2. Filters: one task per part of the hash space streams the packed hashes. A
   hash that the once filter already holds enters the twice filter. The parts
   of the twice filter are files in the shared folder; together they have at
   most MAX_FILTER_BITS bits, so what a worker loads is bounded. A crowded
   filter suspects more lines, but never misses a repeat.
3. Confirmation: only keys that the twice filter holds are shuffled, as text,
   for the exact smallest and largest doc_id; a key with two ids is a repeat.
4. Dropping: documents without a suspected key go straight through. The others
   were written once in step 3, and meet the keys that they lose by a join.

No step groups by a line without combining in the map tasks first, and both
sides of each join are written tables, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import scratch_path, staged
from .warc import open_folder

MIN_CHARS = 10
#: Bits of a hash that name its part of the hash space.
PART_BITS = 10
PARTS = 1 << PART_BITS
#: Bits of a filter for each key, and places that a key sets.
BITS_PER_KEY = 16
PLACES = 4
MAX_FILTER_BITS = 1 << 31
#: Hashes that a sketching task holds before it packs them, and bytes of text a batch stands for.
SKETCH_KEYS = 2_000_000
BATCH_BYTES = 8_000_000


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Key of a line in UTF-8: blanks (``[\\x20\\x09-\\x0D]``) stripped at both ends and A-Z lower-cased; None if too short."""
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    return key


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _keys(text: str | None, min_chars: int) -> list[bytes]:
    """Distinct keys of a text."""
    return list({k for line in _lines(text) if (k := line_key(line, min_chars)) is not None})


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PLACES places in a part of ``bits`` bits (a power of two) for each hash, by double hashing."""
    first = (hashes & np.uint64(0xFFFFFFFF)).astype(np.int64)
    step = ((hashes >> np.uint64(22)) & np.uint64(0xFFFFFFFF)).astype(np.int64) | 1
    return (first[:, None] + step[:, None] * np.arange(PLACES)) & (bits - 1)


def part_bits(n_keys: int) -> int:
    """Bits of one part of a filter for ``n_keys`` keys in all, a power of two; all parts have at most MAX_FILTER_BITS."""
    wanted = max(1, -(-n_keys * BITS_PER_KEY // PARTS))
    return min(max(64, 1 << (wanted - 1).bit_length()), MAX_FILTER_BITS // PARTS)


def _pack(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (part, n, hashes): the distinct hashes by part; a hash that several documents hold is in the row twice."""
    found, times = np.unique(np.concatenate(hashes), return_counts=True)
    found = np.sort(np.concatenate([found, found[times > 1]]))
    part = (found >> np.uint64(64 - PART_BITS)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part)) + 1
    pieces = np.split(found, cuts) if len(found) else []
    yield pa.RecordBatch.from_arrays(
        [pa.array([int(p[0]) >> (64 - PART_BITS) for p in pieces], pa.int32()), pa.array([len(p) for p in pieces], pa.int64()),
         pa.array([p.tobytes() for p in pieces], pa.binary())], names=["part", "n", "hashes"])


def sketch(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(part, n, hashes): packed hashes of the distinct keys of each document, by part of the hash space."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                held.append(_hashes(_keys(value.as_py(), min_chars)))
                size += len(held[-1])
                if size >= SKETCH_KEYS:
                    yield from _pack(held)
                    held, size = [], 0
        if size:
            yield from _pack(held)

    return docs.select(text).mapInArrow(run, "part int, n long, hashes binary")


def twice_filter(packed: DataFrame, bits: int) -> DataFrame:
    """(part, twice): the packed bits of every part's twice filter, from sketches; ``bits`` is ``part_bits``'s."""

    def run(batches):
        now, once, twice = None, None, None
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now:
                    if now is not None:
                        yield _part_row(now, twice)
                    now, once, twice = part, np.zeros(bits, bool), np.zeros(bits, bool)
                hashes = np.frombuffer(raw.as_buffer(), np.uint64)
                again = np.zeros(len(hashes), bool)
                again[1:] = hashes[1:] == hashes[:-1]
                places = _places(hashes, bits)
                again |= once[places].all(axis=1)
                twice[places[again]] = True
                once[places] = True
        if now is not None:
            yield _part_row(now, twice)

    return (packed.select("part", "hashes").repartition("part").sortWithinPartitions("part")
            .mapInArrow(run, "part int, twice binary"))


def _part_row(part: int, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())],
                                      names=["part", "twice"])


class Filter:
    """The whole twice filter in a worker, from the written parts."""

    def __init__(self, folder: str, bits: int):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        self.bits = bits
        self.bytes = np.zeros(PARTS * bits // 8, np.uint8)
        files, base = open_folder(folder)
        for info in files.get_file_info(pafs.FileSelector(base)):
            if info.path.endswith(".parquet"):
                with files.open_input_file(info.path) as f:
                    for batch in pq.ParquetFile(f).iter_batches():
                        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                            self.bytes[part * bits // 8:(part + 1) * bits // 8] = np.frombuffer(raw.as_buffer(), np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - PART_BITS)).astype(np.int64)[:, None] * self.bits + _places(hashes, self.bits)
        return (self.bytes[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1)


@lru_cache(maxsize=1)
def _filter(folder: str, bits: int) -> Filter:
    return Filter(folder, bits)


def _suspects(texts: list, folder: str, bits: int, min_chars: int) -> list[list[bytes]]:
    """For each text the keys that the twice filter holds."""
    keys = [_keys(t, min_chars) for t in texts]
    flat = [k for ks in keys for k in ks]
    held = iter(_filter(folder, bits).holds(_hashes(flat)).tolist()) if flat else iter(())
    return [[k for k in ks if next(held)] for ks in keys]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list]]:
    """(start, texts) of about BATCH_BYTES bytes together."""
    start, size, held = 0, 0, []
    for i, t in enumerate(texts):
        held.append(t.as_py())
        size += len(held[-1] or "")
        if size >= BATCH_BYTES:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def _dropped(text: str | None, drop: set[bytes], min_chars: int) -> tuple[str, int, int]:
    """(kept text, lines, lines dropped)."""
    lines = _lines(text)
    kept = [x for x in lines if line_key(x, min_chars) not in drop] if drop else lines
    return b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``, and with n_lines (before dropping) and n_dropped.

    A key of at least ``min_chars`` code points that documents of two or more
    ids hold stays only in those of the smallest id, with all its lines there.
    Null and empty texts are one empty line; a null id counts as one more id,
    larger than all others; rows that repeat an id are one document, and each
    stays; columns called n_lines or n_dropped are replaced, all other columns
    are kept under their names; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    packed = staged(sketch(docs, text, min_chars), "line-sketch")
    bits = part_bits(packed.agg(F.sum("n")).first()[0] or 0)
    folder = scratch_path(spark, "line-filter")
    twice_filter(packed, bits).write.parquet(folder)

    # all other columns travel as one struct, so that their names cannot clash with those of the work
    rows = docs.select(F.struct(*keep, F.lit(0).alias("_")).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("value"))
    done = rows.select("row", F.lit("").alias("value"), F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).schema
    marked = rows.select("*", F.array(F.lit(b"")).alias("keys")).schema

    def clean(batches):
        for batch in batches:
            for start, texts in _chunks(batch.column(2)):
                found = _suspects(texts, folder, bits, min_chars)
                at = [i for i, keys in enumerate(found) if not keys]
                yield _finished(batch.column(0).take(pa.array([start + i for i in at], pa.int64())),
                                [_dropped(texts[i], set(), min_chars) for i in at])

    def suspected(batches):
        for batch in batches:
            for start, texts in _chunks(batch.column(2)):
                found = _suspects(texts, folder, bits, min_chars)
                at = pa.array([start + i for i, keys in enumerate(found) if keys], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(at) for c in batch.columns), pa.array([k for k in found if k], pa.list_(pa.binary()))],
                    names=["row", "id", "value", "keys"])

    def drop(batches):
        for batch in batches:
            for start, texts in _chunks(batch.column(1)):
                keys = batch.column(2).slice(start, len(texts)).to_pylist()
                yield _finished(batch.column(0).slice(start, len(texts)),
                                [_dropped(t, set(k or ()), min_chars) for t, k in zip(texts, keys)])

    dirty = staged(rows.mapInArrow(suspected, marked), "line-suspects").withColumn("at", F.xxhash64("value"))
    lost = staged(_lost(dirty.select(F.explode("keys").alias("key"), "id", "at")), "line-drops")
    lost = lost.select(F.col("id").alias("of"), F.col("at").alias("of_at"), "lost")
    kept = (dirty.join(lost, F.col("id").eqNullSafe(F.col("of")) & (F.col("at") == F.col("of_at")), "left")
            .select("row", "value", "lost").mapInArrow(drop, done))
    out = rows.mapInArrow(clean, done).unionAll(kept)
    columns = [F.col("value").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns if c in (*keep, text)]
    return out.select(*columns, "n_lines", "n_dropped")


def _finished(rows: pa.Array, texts: list[tuple[str, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [rows, pa.array([t[0] for t in texts], pa.string()), *(pa.array([t[i] for t in texts], pa.int64()) for i in (1, 2))],
        names=["row", "value", "n_lines", "n_dropped"])


def _lost(pairs: DataFrame) -> DataFrame:
    """(id, at, lost): the keys that a document loses, from suspected ``pairs(key, id, at)``.

    The smallest and the largest id of a key are combined in the map tasks; a
    key with two ids goes from all but the smallest. The list of a document is
    at most its lines long.
    """
    ids = pairs.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("nulls"))
    repeats = staged(ids.where("first <> last or nulls and first is not null").select("key", "first"), "line-repeats")
    return (pairs.join(repeats, "key").where("id is null or id <> first")
            .groupBy("id", "at").agg(F.collect_set("key").alias("lost")))


def summary(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document; other columns than doc_id and text are not read."""
    kept = dedup_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
