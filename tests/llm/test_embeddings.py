import math

import numpy as np
import pytest

from maskcorpus.llm import embeddings as E


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def slow(rows, threshold=0.95):
    """rows (vec_id, vector) -> n_links and component ids, over all pairs."""
    n = [0] * len(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    at = [i for i, (_, v) in enumerate(rows) if good(v)]
    for dim in {len(rows[i][1]) for i in at}:
        own = [i for i in at if len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in own], np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            i, j = own[a], own[b]
            n[i] += 1
            n[j] += 1
            root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return n, [low.get(find(i)) for i in range(len(rows))]


def clustered(rng, groups, per, dim=64, noise=0.02):
    rows = []
    for _ in range(groups):
        c = rng.standard_normal(dim)
        c /= np.linalg.norm(c)
        for _ in range(int(rng.integers(1, per))):
            rows.append((c + noise * rng.standard_normal(dim)).tolist())
    return rows


@pytest.mark.parametrize("bucket", [E.BUCKET_ROWS, 16])
def test_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(E, "BUCKET_ROWS", bucket)
    rng = np.random.default_rng(3)
    vectors = clustered(rng, 60, 20, noise=0.012) + clustered(rng, 1, 3, 64) + [rng.standard_normal(64).tolist() for _ in range(200)]
    vectors += [vectors[0]] * 50 + [[0.0] * 64] * 3 + [None, None, [], [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63,
                                    [1.0, 0.0], [1.0, 0.01], [-1.0, 0.0], [5.0], [7.0], [-3.0], [1e30] * 64, [1e-30] * 64, [-0.0, 1.0], [0.0, 1.0]]
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [rows[1], (None, vectors[2]), (None, [3.0, -9.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, filters string")
    order = lambda r: (r[0] is None, r[0] or 0, r[2] is None, r[2] or 0)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()), key=order)
    n, comp = slow([(d, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for d, v in rows])
    want = sorted(((d, k, c, d == c if d is not None and c is not None else True) for (d, _), k, c in zip(rows, n, comp)), key=order)
    assert [(r[0], *r[2:]) for r in got] == [(r[0], *r[2:]) for r in want]  # components and kept
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # no link that is none
    assert sum(g[1] for g in got) >= 0.995 * sum(n)


def test_recall_at_the_threshold():
    """Pairs of cosine exactly 0.95, the hardest that count, share a filter in at least nine of ten cases."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal(x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    alpha, tables = E.Code(64).build()
    for cos, least in ((0.95, 0.96), (0.98, 0.99)):
        y = cos * x + math.sqrt(1 - cos * cos) * z
        met = np.zeros(len(x), bool)
        for rotation, words in tables:
            one, two = (set(zip(*(v.tolist() for v in E.decode(u, rotation, words, alpha)))) for u in (x, y))
            met[[r for r, _ in one & two]] = True
        assert met.mean() >= least, (cos, met.mean())


def test_decode_lists_every_filter():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((50, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for blocks, size, alpha in ((3, 7, 0.4), (2, 20, 0.6), (1, 30, 0.5), (4, 5, 0.99)):
        rotation, words = E.random_code(rng, 12, blocks, size)
        turned = x @ rotation
        cuts = np.cumsum([0, *(w.shape[1] for w in words)])
        total = np.zeros((50, 1))
        for a, b, w in zip(cuts, cuts[1:], words):
            total = (total[:, :, None] + (turned[:, a:b] @ w.T)[:, None, :]).reshape(50, -1)
        want = {(r, c) for r, c in zip(*np.nonzero(total >= alpha))} | {(r, int(total[r].argmax())) for r in range(50)}
        row, code = E.decode(x, rotation, words, alpha)
        assert set(zip(row.tolist(), code.tolist())) == {(int(r), int(c)) for r, c in want}


@pytest.mark.parametrize("dim", [1, 2, 3, 8, 16, 64, 384, 1536])
def test_codes_of_every_width(dim):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((200, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    alpha, tables = E.Code(dim).build()
    passed = sum(len(E.decode(x, *t, alpha)[0]) for t in tables) / 200
    assert 4 <= passed <= 60, (dim, alpha, passed)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_duplicates(df).collect() == []
