"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint is the bitwise majority of the hashes of its word
shingles. Distinct fingerprints are dealt into tiles by the bit counts of
their four 16-bit quarters. Two fingerprints that differ in at most r bits
have quarter counts that differ by at most r in sum, so only such tile pairs
meet; everything inside a pair of tiles is compared exactly with numpy
exclusive-or and bit counts.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import ForestBuffer, connected_components
from .storage import staged

QUARTERS = 4
BASE = 17  # a 16-bit quarter has 0 to 16 bits
#: Distinct fingerprints of a tile that one task compares at a time.
TILE_ROWS = 8192

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: _BITS[v, k]: bit k of the byte v.
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def shingle_hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words (or of the whole shorter sequence), repeats included."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(words, len(tokens)) - 1
    digest = xxhash.xxh64_intdigest
    n = len(tokens) - span
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[span:].tolist())), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit value whose bit is 1 where over half of ``hashes`` have it; 0 for no hashes."""
    if not len(hashes):
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    bits = (2 * ones > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64).astype(np.int64))


def simhash(docs: DataFrame, words: int = 3, seed: int = 42, text: str = "text") -> DataFrame:
    """Every column of ``docs`` but ``text``, and ``fingerprint`` (long; it replaces a column of that name).

    Null text: no words.
    """
    keep = [c for c in docs.columns if c not in (text, "fingerprint")]
    part = docs.select(*keep, F.col(text).alias("_simhash_text"))
    schema = docs.select(*keep, F.lit(0).cast("long").alias("fingerprint")).schema

    def run(batches):
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py(), words, seed)) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, pa.int64())],
                                             names=[*keep, "fingerprint"])

    return part.mapInArrow(run, schema)


def _tile(fp: str):
    """Tile number of a fingerprint column: bit counts of its quarters in base 17."""
    return F.expr("+".join(f"bit_count((shiftrightunsigned({fp}, {48 - 16 * k})) & 65535) * {BASE ** (QUARTERS - 1 - k)}"
                           for k in range(QUARTERS))).cast("int")


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Half of the count differences up to ``radius`` in sum: those whose first nonzero entry is positive."""
    return [s for s in product(range(-radius, radius + 1), repeat=QUARTERS)
            if 0 < sum(map(abs, s)) <= radius and next(x for x in s if x) > 0]


def _compare(radius: int):
    """Task body: rows sorted by (tile, block, visitor), each block's own rows first."""

    def run(batches):
        key, home, own, found = None, [], np.zeros(0, np.uint64), ForestBuffer()

        def close():
            if found.parts:
                a, b = found.edges()
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

        def meet(x, y):
            for i in range(0, len(x), 512):
                near = np.bitwise_count(x[i:i + 512, None] ^ y[None, :]) <= radius
                a, b = np.nonzero(near)
                if len(a):
                    a, b = x[i + a], y[b]
                    found.add(a[a != b], b[a != b])

        for batch in batches:
            tile, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            guest, fps = batch.column(2).to_numpy(), batch.column(3).to_numpy().view(np.uint64)
            groups = tile.astype(np.int64) << 32 | block
            cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if groups[lo] != key:
                    yield from close()
                    key, home, own, found = groups[lo], [], None, ForestBuffer()
                mid = lo + int(np.searchsorted(guest[lo:hi], 1))
                if mid > lo:
                    new = fps[lo:mid]
                    for old in home:
                        meet(new, old)
                    meet(new, new)
                    home.append(new)
                if hi > mid and home:
                    if own is None:
                        own = np.concatenate(home)
                        home = [own]
                    meet(fps[mid:hi], own)
        yield from close()

    return run


def near_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links (u, v) that join all fingerprints at most ``radius`` bits apart into the same components.

    ``distinct`` holds each fingerprint once. All pairs within the radius are
    compared; a block's links leave its task as a spanning forest. There are
    at most 17^4 tiles, so the table of their sizes is bounded whatever the
    corpus; a tile of more than TILE_ROWS rows is split into blocks and every
    visitor meets each block.
    """
    own = distinct.select("fingerprint", _tile("fingerprint").alias("tile"))
    sizes = own.groupBy("tile").agg(F.expr(f"cast(ceil(count(*) / {TILE_ROWS}) as int)").alias("blocks"))
    sizes = F.broadcast(sizes)  # at most 17^4 rows of 8 bytes
    home = (own.join(sizes, "tile")
            .withColumn("block", F.expr("pmod(xxhash64(fingerprint), blocks)").cast("int")))
    place = [BASE ** (QUARTERS - 1 - k) for k in range(QUARTERS)]
    moves = F.array(*[F.struct(*[F.lit(x).alias(f"d{k}") for k, x in enumerate(s)],
                               F.lit(sum(x * p for x, p in zip(s, place))).alias("d")) for s in _steps(radius)])
    counts = [F.expr(f"(tile div {p}) % {BASE}").alias(f"c{k}") for k, p in enumerate(place)]
    inside = " and ".join(f"c{k} - m.d{k} between 0 and 16" for k in range(QUARTERS))
    guests = (own.select("fingerprint", "tile", *counts, F.explode(moves).alias("m")).where(inside)
              .select("fingerprint", (F.col("tile") - F.col("m.d")).alias("tile"))
              .join(sizes, "tile")
              .select("tile", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "fingerprint"))
    within = (home.where("block > 0")
              .select("tile", F.explode(F.expr("sequence(0, block - 1)")).alias("block"), "fingerprint"))
    rows = (home.select("tile", "block", F.lit(0).alias("guest"), "fingerprint")
            .unionAll(guests.select("tile", "block", F.lit(1).alias("guest"), "fingerprint"))
            .unionAll(within.select("tile", "block", F.lit(1).alias("guest"), "fingerprint")))
    return (rows.repartition("tile", "block").sortWithinPartitions("tile", "block", "guest")
            .mapInArrow(_compare(radius), "u long, v long"))


def group_near_duplicates(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Add ``component_id`` and ``root`` to ``prints(doc_id, fingerprint, ...)``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``radius`` bits, ``root`` the smallest fingerprint. Equal fingerprints
    collapse to one class first, so a group of exact copies, however large,
    costs one row. Repeated rows stay repeated. A component whose ids are all
    null has a null component_id.
    """
    classes = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    parts = connected_components(near_links(classes.select("fingerprint"), radius))
    member = classes.join(parts.withColumnRenamed("node", "fingerprint"), "fingerprint")
    # a plain table: the join with a component of very many fingerprints can then be split
    lowest = staged(member.groupBy("component").agg(F.min("first").alias("lowest")), "lowest")
    linked = member.join(lowest, "component").select("fingerprint", "component", "lowest")
    named = (classes.join(linked, "fingerprint", "left")
             .select("fingerprint", F.coalesce("component", "fingerprint").alias("root"),
                     F.coalesce("lowest", "first").alias("component_id")))
    named = staged(named, "named")  # a plain table: the join with a group of very many copies can then be split
    return prints.join(named, "fingerprint").select(*prints.columns, "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Null or empty texts and texts of white space have no words: fingerprint
    zero, linked like any other. Fewer words than a shingle: the whole
    sequence is the one shingle. Extra columns are not read. An empty table
    gives an empty one.
    """
    prints = staged(simhash(docs.select("doc_id", "text"), words, seed), "fingerprints")
    return group_near_duplicates(prints, radius).drop("root")


def drop_near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """One row of each group of near copies, with all its columns.

    It is the row with the smallest doc_id (nulls last); of rows that repeat
    an id, one. Columns of any name pass through: they travel as one struct.
    """
    numbered = docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"),
                           "doc_id", "text")
    rows = staged(simhash(numbered, words, seed), "documents")
    groups = group_near_duplicates(rows.select("row", "doc_id", "fingerprint"), radius)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row"))
    return rows.join(first.select("row"), "row", "left_semi").select("doc.*")
