import hashlib
import random

import numpy as np

from maskcorpus.llm import lines as L

BLANKS = " \t\n\x0b\x0c\r"


def slow_dedup(rows, min_chars=10):
    """Rows (doc_id, text) -> (doc_id, kept, n_lines, n_dropped), by a dictionary of all keys."""
    order = lambda d: (d is None, d or 0)
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(BLANKS))
    holders = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(d)
    out = []
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(key(x)) < min_chars or len(holders[key(x)]) < 2 or min(holders[key(x)], key=order) == d]
        out.append((d, "\n".join(kept), len(every), len(every) - len(kept)))
    return out


def corpus(seed=3, n=400):
    rng = random.Random(seed)
    pool = [f"{'Shared' if i % 2 else 'ßhared漢字'} passage number {i}" for i in range(60)] + ["short", "", "  ", "ninechars", "ten chars!"]
    rows = []
    for d in range(n):
        text = [rng.choice(pool) if rng.random() < 0.4 else f"own line {d} {rng.random()}" for _ in range(rng.randint(0, 12))]
        text = [rng.choice(["", " ", "\t", "\r"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", "\r", "  "]) for x in text]
        rows.append((d, "\n".join(text)))
    return rows + [(None, "ten chars!\nA LINE of null ids\n"), (None, "a line of null ids"), (7, rows[7][1]), (7, "another text of 7\nten chars!"),
                   (900, None), (901, ""), (902, "\n\n"), (903, " padded with a no-break blank"), (904, "padded with a no-break blank"),
                   (905, "a very long line " * 20000), (906, "A very long line " * 20000 + "\n" + "twice in one document\ntwice in one document")]


def check(spark, rows):
    df = spark.createDataFrame([(d, t, "e", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, n_dropped string, row long")
    out = L.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "row", "n_lines", "n_dropped"]
    got = sorted(tuple(r) for r in out.select("row", "doc_id", "text", "n_lines", "n_dropped").collect())
    assert got == [(i, *r) for i, r in enumerate(slow_dedup(rows))]
    return got


def test_against_brute_force(spark):
    got = check(spark, corpus())
    assert sum(r[4] for r in got) > 300


def test_crowded_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_FILTER_BITS", L.PARTS * 8)
    monkeypatch.setattr(L, "PLACES", 2)
    assert L.part_bits(10 ** 6) == 8
    check(spark, corpus(4))


def test_no_repeats_and_empty_table(spark):
    check(spark, [(i, f"a line of document {i}\nand one more of {i}") for i in range(20)])
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.dedup_lines(df).collect() == [] and L.summary(df).collect() == []


def test_common_line_in_all_documents(spark):
    got = check(spark, [(i, f"the same line everywhere\nown words of {i}") for i in range(500, 0, -1)])
    assert sum(r[4] for r in got) == 499


def test_filters(spark):
    hashes = np.random.default_rng(1).integers(0, 2 ** 63, 20_000).astype(np.uint64) * np.uint64(2)
    places = L._places(hashes, 1 << 14)
    assert places.min() >= 0 and places.max() < 1 << 14 and L.part_bits(1 << 40) * L.PARTS == L.MAX_FILTER_BITS
    docs = spark.createDataFrame([(i, "\n".join(f"line of the key {k}" for k in range(i, 20_000, 400))) for i in range(400)]
                                 + [(1000 + i, f"line of the key {i}") for i in range(300)], "doc_id long, text string").repartition(5)
    packed = L.sketch(docs)
    n = packed.selectExpr("sum(n)").first()[0]
    assert n == 20_300
    folder = L.scratch_path(spark, "test-filter")
    L.twice_filter(packed, L.part_bits(n)).write.parquet(folder)
    held = L.Filter(folder, L.part_bits(n)).holds(L._hashes([f"line of the key {k}".encode() for k in range(20_000)]))
    assert held[:300].all() and held[300:].mean() < 0.02


def test_keys():
    assert L.line_key(b" \t ABCDEFGHIJ \r") == b"abcdefghij" and L.line_key("ÄBCDEFGHI".encode()) is None
    assert L.line_key("ÄBCDEFGHIJ".encode()) == "Äbcdefghij".encode() and L.line_key("　" * 10 and "　".encode() * 10) is not None
    assert L.line_key(b"123456789") is None and L.line_key(b"") is None


def test_query_plan_and_rows(spark):
    from maskcorpus.llm.queries import op11_line_dedup
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    want = sorted((d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, m in slow_dedup(rows))
    out = op11_line_dedup(spark, "/root/testdata/sf0.01")
    assert sorted(tuple(r) for r in out.collect()) == want
