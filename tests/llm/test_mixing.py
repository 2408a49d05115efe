import hashlib
import math
import random
from collections import defaultdict

import pytest

from maskcorpus.llm import mixing as M


def fill(total, items):
    """items: {key: (weight, cap)} -> {key: share}; rounds of dealing out, as the words of the rule say."""
    share, free, rest = {}, dict(items), total
    while free:
        weight = sum(w for w, _ in free.values())
        over = {k for k, (w, cap) in free.items() if rest * w / weight >= cap}
        if not over:
            share.update({k: rest * w / weight for k, (w, _) in free.items()})
            break
        for k in over:
            share[k] = free.pop(k)[1]
            rest -= share[k]
    return share


def slow_mix(rows, seed=42):
    """rows (doc_id, source, size) -> (targets, copies), by sorting whole sources."""
    per = defaultdict(int)
    for _, s, n in rows:
        per[s] += n
    order = sorted(per, key=lambda s: (s is None, s or ""))
    goal = fill(sum(per.values()), {s: ((1, 2, 3)[i % 3], 3 * per[s]) for i, s in enumerate(order)})
    copies = [0] * len(rows)
    for s in order:
        words = defaultdict(int)
        for _, t, n in rows:
            if t == s:
                words[len(bin(n)) - 2 if n else 1] += n
        words = {c: n for c, n in words.items() if n}
        share = fill(goal[s], {c: (n * (1000 + 1000 // (1 + c)), 3 * n) for c, n in words.items()})
        rate = {c: min(share[c] / n, 3) for c, n in words.items()}
        need = goal[s] - sum(math.floor(rate[c]) * n for c, n in words.items())
        ranked = defaultdict(list)
        for i, (d, t, n) in enumerate(rows):
            if t == s and n:
                r = rate[n.bit_length()]
                copies[i], p = math.floor(r), r - math.floor(r)
                if p > 0:
                    h = hashlib.md5(f"{seed}:{'null' if d is None else d}".encode()).hexdigest()
                    u = (int(h[:13], 16) + 0.5) / 2 ** 52
                    x = u * (1 - p)
                    ranked[math.floor(2 ** 30 * x / (x + p * (1 - u)))].append(i)
        total = 0
        for k in sorted(ranked):
            here = sum(rows[i][2] for i in ranked[k])
            if need <= 0 or total >= need or total + here / 2 > need:
                break
            total += here
            for i in ranked[k]:
                copies[i] += 1
    return per, goal, copies


def docs_of(spark, rows):
    text = [(d, "w " * n if n is not None else None, s, "x") for d, s, n in rows]
    return spark.createDataFrame(text, "doc_id long, text string, source string, target string")


def test_mix_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a"] * 9 + ["B", "é", "zz", None, "", "tiny"]), int(rng.paretovariate(1.1) * 20) - 19) for i in range(900)]
    rows += [(5000 + i, "rare", 3) for i in range(3)] + [(1, "a", 50)] * 4 + [(None, "a", 30), (7000, "a", 40000), (8000, "void", 0)]
    rng.shuffle(rows)
    per, goal, copies = slow_mix(rows)
    got = M.mix(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    key = lambda d, n, s: (d is None, d or 0, n, s)
    want = sorted((key(d, n, per[s]), c * n, goal[s]) for (d, s, n), c in zip(rows, copies))
    have = sorted((key(r.doc_id, r.size, r.source_size), r.taken, r.target) for r in got)
    for (k, t, g), (k2, t2, g2) in zip(want, have):
        assert k == k2 and t == t2 and g2 == pytest.approx(g, rel=1e-12)
    for (d, s, n), c in zip(rows, copies):
        taken[s] += c * n
        assert c <= 3
    for s in per:
        biggest = max(n for _, t, n in rows if t == s)
        assert abs(taken[s] - goal[s]) <= biggest * 4 + 1, (s, taken[s], goal[s])
    again = M.mix(docs_of(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_repeats_documents(spark):
    rows = [(i, "a" if i < 30 else "b", 10 + i % 7) for i in range(40)]
    df = docs_of(spark, rows)
    out = M.mixed(df)
    assert out.columns == df.columns
    want = {r.doc_id: r.taken // r.size for r in M.mix(df).collect()}
    have = defaultdict(int)
    for r in out.collect():
        have[r.doc_id] += 1
    assert {k: v for k, v in want.items() if v} == dict(have) and max(want.values()) > 1


def test_pareto_inclusion_follows_the_odds():
    rng = random.Random(9)
    p = [0.1] * 300 + [0.7] * 300
    hits = [0, 0]
    for _ in range(60):
        ranks = []
        for i, q in enumerate(p):
            u = rng.random()
            ranks.append(((u / (1 - u)) / (q / (1 - q)), i))
        for _, i in sorted(ranks)[:240]:
            hits[i >= 300] += 1
    assert abs(hits[0] / 18000 - 0.1) < 0.02 and abs(hits[1] / 18000 - 0.7) < 0.02


def test_empty_and_wordless_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(df).collect() == [] and M.mixed(df).collect() == []
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in M.mix(df).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
