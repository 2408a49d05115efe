import hashlib
import random
from zlib import crc32

import pytest

from maskcorpus.llm import runs as R


def slow_runs(words):
    """Every start and period: the maximal stretch, kept if no smaller period holds over the whole of it."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i:i + length]
            smaller = any(all(a == b for a, b in zip(stretch, stretch[p:])) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and best[1] * 1000 // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_runs_against_brute_force():
    rng = random.Random(5)
    for _ in range(1200):
        words = rng.choices("ab" if rng.random() < 0.5 else "abcd", k=rng.randint(0, 50))
        for _ in range(rng.randint(0, 3)):
            at, p = rng.randint(0, len(words)), rng.randint(1, 12)
            piece = (rng.choices("abc", k=p) * 9)[:rng.randint(p, 9 * p)]
            words[at:at] = piece
        assert [tuple(r) for r in R.find_runs(words)] == slow_runs(words), words


def test_nested_and_neighbouring_runs():
    inner = ["a"] * 6 + ["b"]
    words = inner * 5 + ["x", "y"] * 4
    assert [tuple(r) for r in R.find_runs(words)] == slow_runs(words)
    assert (0, 35, 7) in [tuple(r) for r in R.find_runs(words)]


@pytest.mark.parametrize("period", [1, 2, 3, 7, 40, 999])
def test_long_runs_are_one_seed_each(period, monkeypatch):
    calls = []
    monkeypatch.setattr(R, "_reach", lambda *a, f=R._reach: calls.append(1) or f(*a))
    words = list(range(10**6, 10**6 + 50)) + [i % period for i in range(40_000)] + list(range(2 * 10**6, 2 * 10**6 + 50))
    assert R.find_runs(words) == [R.Run(50, 40_000, period)]
    assert len(calls) == 2


ODD = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "a\x0ba\x0ca\x0da\x09a\x20a", "x x x x x x x x x x x x",
       "\x1ca " * 6, "ab " * 30000, " ".join(f"w{i % 50}" for i in range(3000)), "é " * 7 + "b", "\x00 " * 6]


def test_rows_through_spark(spark, monkeypatch):
    monkeypatch.setattr(R, "BATCH_BYTES", 100)
    rng = random.Random(1)
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(i, " ".join(rng.choices("pqr", k=rng.randint(1, 90))), None) for i in range(100, 300)]
    rows += [(None, "b b b b b b", "z"), (7, "c", "c"), (7, "c", "c")]
    assert sum(crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 10
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    want = [slow_row(*r[:2]) for r in rows if len(r[1] or "") < 50_000]
    got = {str(tuple(r)) for r in R.summary(df).collect()}
    assert {str(w) for w in want} <= got and R.summary(df).count() == len(rows)
    assert R.periodic_runs(df).columns == ["doc_id", "found"]
    assert R.summary(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    from maskcorpus.llm.queries import op12_periodic_runs
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = sorted(tuple(r) for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(slow_row(r.doc_id, r.text) for r in docs)
    assert "Exchange" not in op12_periodic_runs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
