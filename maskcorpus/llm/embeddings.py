"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector passes it if its cosine with the direction
is at least ``alpha``. Directions come from random product codes: a vector,
after a random rotation, is cut into blocks, each block has a small code of
random unit vectors, and a direction is one code word per block. Its inner
product is the sum over the blocks, so a vector's list of all filters that it
passes is decoded by branch and bound over blocks, without looking at the
code_size ** blocks directions one by one. Vectors meet where they pass the
same filter, and every meeting pair is verified by its exact cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import ForestBuffer, connected_components
from .storage import staged

#: Vectors of one filter that a task compares at a time; a larger filter is split into blocks that meet pairwise.
BUCKET_ROWS = 2048


def _cap_shares(dim: int, points: int = 200_001) -> tuple[np.ndarray, np.ndarray]:
    """Cosines from -1 to 1 and the share of the unit sphere of ``dim`` numbers that has at least that cosine with a direction."""
    u = np.linspace(-1, 1, points)
    if dim == 1:
        return u, np.full(points, 0.5)
    if dim == 2:
        return u, np.arccos(u) / np.pi
    weight = np.maximum(1 - u * u, 0) ** ((dim - 3) / 2)
    share = np.cumsum(weight[::-1])[::-1]
    return u, share / share[0]


def random_code(rng: np.random.Generator, dim: int, blocks: int, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation and ``size`` code words for each block, each of length 1 / sqrt(blocks)."""
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    words = []
    for part in np.array_split(np.arange(dim), blocks):
        w = rng.standard_normal((size, len(part)))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(blocks))
    return rotation, words


@dataclass(frozen=True)
class Code:
    """Random product codes for vectors of ``dim`` numbers: ``tables`` of them, each with a rotation of its own.

    A vector passes about ``passes`` filters of a table. The cap is never
    narrower than ``widest``, or pairs at the threshold would not share one:
    short vectors get fewer code words instead.
    """

    dim: int
    tables: int = 4
    blocks: int = 2
    code_size: int = 256
    passes: float = 6.0
    widest: float = 0.45
    seed: int = 17

    def shape(self) -> tuple[int, int, float]:
        """(blocks, code words of a block, alpha)."""
        blocks = min(self.blocks, self.dim)
        u, share = _cap_shares(self.dim)
        alpha = min(self.widest, float(u[np.count_nonzero(share * self.code_size ** blocks >= self.passes) - 1]))
        here = float(np.interp(alpha, u, share))
        return blocks, max(2, min(self.code_size, round((self.passes / here) ** (1 / blocks)))), alpha

    def build(self) -> tuple[float, list[tuple[np.ndarray, list[np.ndarray]]]]:
        """alpha, and per table the rotation and the code words of each block."""
        blocks, size, alpha = self.shape()
        rng = np.random.default_rng([self.seed, self.dim, self.tables, blocks, size])
        return alpha, [random_code(rng, self.dim, blocks, size) for _ in range(self.tables)]


def decode(unit: np.ndarray, rotation: np.ndarray, words: list[np.ndarray], alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) for every filter whose direction has inner product ``alpha`` or more with a unit vector.

    Branch and bound: a choice of code words for the first blocks lives on
    while it could still reach ``alpha`` with the best words of the rest. A
    vector that passes none gets the filter it comes nearest to.
    """
    turned = unit @ rotation
    cuts = np.cumsum([0, *(w.shape[1] for w in words)])
    products = [turned[:, a:b] @ w.T for a, b, w in zip(cuts, cuts[1:], words)]
    best = np.stack([p.max(axis=1) for p in products], axis=1)
    rest = np.concatenate([np.cumsum(best[:, ::-1], axis=1)[:, ::-1], np.zeros((len(unit), 1))], axis=1)
    row, code, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
    need = np.minimum(alpha, rest[:, 0] - 1e-12)
    for k, p in enumerate(products):
        size = p.shape[1]
        row, code = np.repeat(row, size), np.repeat(code * size, size)
        word = np.tile(np.arange(size), len(total))
        total = np.repeat(total, size) + p[row, word]
        alive = total + rest[row, k + 1] >= need[row]
        row, code, total = row[alive], code[alive] + word[alive], total[alive]
    return row, code


def usable(vector: str) -> str:
    """SQL: the vector links with others (not null, no null or non-finite component, not zero)."""
    return (f"coalesce(forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
            f"and exists({vector}, x -> x <> 0), false)")


def _units(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of one length as a matrix of doubles, their norms, and the matrix scaled to norm 1."""
    width = len(vectors[0])
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.exp2(np.floor(np.log2(scale)))  # exact, and squares cannot overflow
    norm = np.sqrt((x * x).sum(axis=1))
    return x, norm, x / norm[:, None]


def filters_of(classes: DataFrame, code_options: dict) -> DataFrame:
    """(dim, filters) added to ``classes(id, vector, weight)``: the sorted list of all filters that a vector passes."""
    schema = classes.select("id", "vector", "weight", F.lit(0).alias("dim"), F.lit(None).cast("array<long>").alias("filters")).schema

    def run(batches):
        codes: dict[int, tuple] = {}
        for batch in batches:
            width = pa.compute.list_value_length(batch.column(1)).to_numpy()
            for dim in np.unique(width).tolist():
                at = np.flatnonzero(width == dim)
                if dim not in codes:
                    codes[dim] = Code(dim, **code_options).build()
                alpha, tables = codes[dim]
                for lo in range(0, len(at), 256):
                    own = batch.take(pa.array(at[lo:lo + 256]))
                    unit = _units(own.column(1))[2]
                    rows, found = [], []
                    for t, (rotation, words) in enumerate(tables):
                        row, f = decode(unit, rotation, words, alpha)
                        rows.append(row)
                        found.append(f + t * len(words[0]) ** len(words))
                    row, found = np.concatenate(rows), np.concatenate(found)
                    order = np.lexsort((found, row))
                    ends = np.searchsorted(row[order], np.arange(own.num_rows + 1))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found[order], pa.int64()))
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.full(own.num_rows, dim), pa.int32()), lists],
                                                     names=["id", "vector", "weight", "dim", "filters"])

    return classes.select("id", "vector", "weight").mapInArrow(run, schema)


def _verify(threshold: float):
    """Task body: rows sorted by (dim, filter, home, away); rows of block ``home`` meet themselves and the ``away`` rows.

    A pair is counted in the smallest filter that both pass, so each pair
    counts once. Rows leave as (id, other, n): n direct links counted, and
    other, a node of the same component (a spanning forest of the links).
    """

    def run(batches):
        key, own, found = None, [], ForestBuffer()
        counts: dict[int, int] = {}

        def close():
            if counts:
                yield _out(list(counts), list(counts), list(counts.values()))
            if found.parts:
                a, b = found.edges()
                yield _out(a, b, np.zeros(len(a), np.int64))

        def meet(x, y, same):
            for i in range(0, len(x[0]), 512):
                cos = (x[1][i:i + 512] @ y[1].T) / (x[2][i:i + 512, None] * y[2][None, :])
                a, b = np.nonzero(cos >= threshold)
                a += i
                if same:
                    a, b = a[a < b], b[a < b]
                if not len(a):
                    continue
                mine = _uncounted(x[3], y[3], a, b)
                a, b = a[mine], b[mine]
                found.add(x[0][a], y[0][b])
                for ids, at, weight in ((x[0], a, y[4][b]), (y[0], b, x[4][a])):
                    n = np.bincount(at, weights=weight, minlength=len(ids))
                    for s in np.flatnonzero(n).tolist():
                        counts[int(ids[s])] = counts.get(int(ids[s]), 0) + int(n[s])

        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            keys = np.stack([cols[c].to_numpy().astype(np.int64) for c in ("dim", "filter", "home")], axis=1)
            away = cols["away"].to_numpy(zero_copy_only=False)
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (away[1:] != away[:-1])) + 1
            cuts = [0, *change.tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if tuple(keys[lo]) != key:
                    yield from close()
                    key, own, found = tuple(keys[lo].tolist()), [], ForestBuffer()
                    counts.clear()
                part = batch.slice(lo, hi - lo)
                x, norm, _ = _units(part.column("vector"))
                rows = (part.column("id").to_numpy(), x, norm, [np.asarray(v, np.int64) for v in part.column("lower").to_pylist()],
                        part.column("weight").to_numpy().astype(np.float64))
                for old in own:
                    meet(rows, old, False)
                if not away[lo]:
                    meet(rows, rows, True)
                    own.append(rows)
        yield from close()

    return run


def _uncounted(x: list[np.ndarray], y: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the pairs (x[a], y[b]), which have no common filter among their smaller filters ``x`` and ``y``."""
    rows_a, at_a = np.unique(a, return_inverse=True)
    rows_b, at_b = np.unique(b, return_inverse=True)

    def incidence(lists, rows):
        low = [lists[r] for r in rows.tolist()]
        return np.repeat(np.arange(len(low)), [len(v) for v in low]), np.concatenate(low) if low else np.zeros(0, np.int64)

    (ra, fa), (rb, fb) = incidence(x, rows_a), incidence(y, rows_b)
    shared = np.intersect1d(fa, fb)
    if not len(shared):
        return np.ones(len(a), bool)

    def table(r, f, n):
        at = np.searchsorted(shared, f)
        hit = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == f)
        out = np.zeros((n, len(shared)), np.float32)
        out[r[hit], at[hit]] = 1
        return out

    common = table(ra, fa, len(rows_a)) @ table(rb, fb, len(rows_b)).T
    return common[at_a, at_b] == 0


def _out(a, b, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["id", "other", "n"])


def links(classes: DataFrame, threshold: float = 0.95, **code_options) -> DataFrame:
    """(id, other, n) for ``classes(id, vector, weight)``: counted links (other = id) and a spanning forest (n = 0).

    ``n`` sums the weights of the linked classes over the filters in which
    pairs were counted. A filter of more than BUCKET_ROWS vectors is dealt
    into blocks by a hash, and each pair of blocks meets in a task.
    """
    passed = staged(filters_of(classes, code_options), "filters")
    rows = passed.select("dim", "id", "vector", "weight", "filters", F.posexplode("filters").alias("below", "filter"))
    rows = rows.select("dim", "filter", "id", "vector", "weight", F.slice("filters", F.lit(1), F.col("below")).alias("lower"))
    size = (passed.select("dim", F.explode("filters").alias("filter")).groupBy("dim", "filter").agg(F.count("*").alias("rows"))
            .where("rows > 1").select("dim", "filter", F.expr(f"cast(ceil(rows / {BUCKET_ROWS}) as int)").alias("parts")))
    dealt = rows.join(staged(size, "sizes"), ["dim", "filter"]).withColumn("block", F.expr("cast(pmod(xxhash64(id), parts) as int)"))
    dealt = dealt.withColumn("home", F.explode(F.expr("sequence(0, block)"))).withColumn("away", F.expr("home <> block"))
    return (dealt.select("dim", "filter", "home", "away", "id", "vector", "lower", "weight")
            .repartition("dim", "filter", "home").sortWithinPartitions("dim", "filter", "home", "away")
            .mapInArrow(_verify(threshold), "id long, other long, n long"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, **code_options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors(vec_id, embedding)``.

    n_links counts the other rows with cosine of at least ``threshold``,
    component_id is the smallest vec_id reachable by links, kept says that it
    is the row's own. Equal vectors form one class, however many they are,
    and a class is compared once. Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing, also not with their
    copies; vectors of different lengths do not link. Rows that repeat an id
    are rows of their own in n_links; rows without an id count as links, and
    their component_id is null if nothing in it has an id. Labels and other
    columns are not read; an empty table gives an empty one.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("vector"))
    rows = staged(rows.withColumn("good", F.expr(usable("vector")))
                  .withColumn("row", F.monotonically_increasing_id()), "vectors")
    good = rows.where("good")
    classes = staged(good.groupBy("vector").agg(F.min("row").alias("id"), F.count("*").alias("weight"), F.min("vec_id").alias("first")), "classes")
    found = staged(links(classes.select("id", "vector", "weight"), threshold, **code_options), "links")
    counted = found.groupBy("id").agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("id <> other").select(F.col("id").alias("u"), F.col("other").alias("v")))
    member = classes.select("id", "first").join(parts.withColumnRenamed("node", "id"), "id")
    # a plain table: the join with a component of very many classes can then be split
    lowest = staged(member.groupBy("component").agg(F.min("first").alias("lowest")), "lowest")
    linked = member.join(lowest, "component").select("id", "lowest")
    named = (classes.join(counted, "id", "left").join(linked, "id", "left")
             .select(F.col("vector").alias("of"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("lowest", "first").alias("component_id")))
    named = staged(named, "named")
    out = good.select("vec_id", "vector").join(named, F.col("vector") == F.col("of")).select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(alone).withColumn("kept", F.expr("coalesce(vec_id = component_id, true)"))
