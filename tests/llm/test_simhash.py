import random

import xxhash

from maskcorpus.llm import simhash as S
from maskcorpus.llm.components import connected_components


def slow_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [words[i:i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, radius):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(set(prints))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    low = {}
    for d, p in zip(ids, prints):
        r = find(p)
        low[r] = d if r not in low or low[r] is None else low[r] if d is None else min(low[r], d)
    return [low[find(p)] for p in prints]


def test_fingerprint_matches_plain_version():
    texts = [None, "", " \t\n\x0b\x0c\r", "One", "one TWO", "a b c", "É x  y Z é ß ZZ", "x " * 5000, "Ab cD\nef  gh\tij " * 7]
    for t in texts:
        assert S.fingerprint(S.shingle_hashes(t, 3, 42)) & (2 ** 64 - 1) == slow_fingerprint(t), t


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(1)
    vocab = ["w%d" % i for i in range(400)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 300))) for _ in range(120)]
    for t in list(texts[:60]):
        words = t.split()
        for _ in range(3):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    texts += [texts[0]] * 40 + [None, "", "  ", "Q", "q"]
    rows = [(i, t, "fp") for i, t in enumerate(texts)] + [(3, texts[3], "again"), (None, texts[5], None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted(map(tuple, S.near_duplicates(docs).collect()), key=str)
    prints = [slow_fingerprint(t) for _, t, _ in rows]
    want = slow_components([d for d, _, _ in rows], prints, 2)
    assert got == sorted(((d, p - (p >> 63 << 64), c) for (d, _, _), p, c in zip(rows, prints, want)), key=str)
    kept = S.drop_near_duplicates(docs).collect()
    assert len(kept) == len(set(want)) and {r.doc_id for r in kept} == set(want)
    assert kept[0].__fields__ == ["doc_id", "text", "fingerprint"]


def test_tiles_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_ROWS", 8)  # tiles split into blocks
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)] + [0, 2 ** 64 - 1, 1]
    prints = set(base)
    for p in base:
        for _ in range(12):
            q = p
            for _ in range(rng.randint(1, 3)):
                q ^= 1 << rng.randrange(64)
            prints.add(q)
    signed = [p - (p >> 63 << 64) for p in sorted(prints)]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    got = dict(map(tuple, connected_components(S.near_links(df, 2)).collect()))
    want = dict(zip(sorted(prints), slow_components(sorted(prints), sorted(prints), 2)))
    groups = {}
    for p, root in want.items():
        groups.setdefault(root, set()).add(p - (p >> 63 << 64))
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert S.near_duplicates(docs).collect() == [] and S.drop_near_duplicates(docs).collect() == []


def test_components_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(got[i] == 0 for i in range(51)) and all(got[i] == 1000 for i in range(1000, 1200))
    assert got[2000] == got[2001] == 2000
