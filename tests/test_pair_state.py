"""The learner's kept state and its batches against one plain merge at a time."""

import random

import numpy as np
import pytest

from maskcorpus.operators import bpe
from maskcorpus.operators.pair_state import KEY, Pairs, Words, dealt, merged, summed


def plain_merge(word, a, b, new):
    out, i = [], 0
    while i < len(word):
        if i + 1 < len(word) and word[i] == a and word[i + 1] == b:
            out.append(new)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


def plain_counts(words, counts):
    found = {}
    for w, n in zip(words, counts):
        for p in zip(w, w[1:]):
            found[p] = found.get(p, 0) + n
    return found


def plain_learn(words, counts, merges):
    words, out, new = [list(w) for w in words], [], 1000
    while len(out) < merges:
        found = plain_counts(words, counts)
        if not found:
            break
        (a, b), n = min(found.items(), key=lambda x: (-x[1], x[0]))
        out.append((a, b, n))
        words = [plain_merge(w, a, b, new) for w in words]
        new += 1
    return out


def batched_learn(words, counts, merges, head, watched_most, batch, shards=3):
    """The loop of ``learn_bpe`` without Spark."""
    states = [Words(words[i::shards], counts[i::shards]) for i in range(shards)]
    tables = [Pairs() for _ in range(shards)]

    def send(parts):
        inbox = [[] for _ in tables]
        for keys, by in parts:
            for at, message in dealt(keys, by, shards, "count"):
                inbox[at].append(message)
        for table, got in zip(tables, inbox):
            for _, keys, by in got:
                table.change(keys, by)

    send(s.counts() for s in states)
    out, rounds, bounds, overlaps = [], 0, {}, {}
    while len(out) < merges:
        heads = [t.head(head) for t in tables]
        keys, n = (np.concatenate([h[i] for h in heads]) for i in (0, 1))
        least = max([int(h[1][-1]) for h in heads if len(h[0]) == head], default=0)
        order = np.lexsort((keys, -n))
        top = [(k // KEY, k % KEY, c) for k, c in zip(keys[order].tolist(), n[order].tolist())]
        if not top:
            break
        chosen = bpe._safe_batch(top, bounds, min(batch, merges - len(out)), overlaps, least)
        steps = [(a, b, 1000 + len(out) + i) for i, (a, b, _) in enumerate(chosen)]
        out += chosen
        rounds += 1
        send([s.apply(steps) for s in states])
        taken = {(a, b) for a, b, _ in chosen}
        watched = np.array(sorted(a * KEY + b for a, b, _ in top[:watched_most] if (a, b) not in taken), np.int64)
        bounds, overlaps = {}, {}
        if len(watched):
            codes, total = summed(*(np.concatenate(x) for x in zip(*(s.triples(watched) for s in states))))
            bounds = {(k // KEY, k % KEY): 0 for k in watched.tolist()}
            for c, t in zip(codes.tolist(), total.tolist()):
                k = int(watched[c // (2 * KEY)])
                a, b, other = k // KEY, k % KEY, c % KEY
                bounds[a, b] = max(bounds[a, b], t)
                if c // KEY % 2 and b * KEY + other in watched:
                    overlaps[a, b, other] = t
    return out, rounds


@pytest.mark.parametrize("letters,longest,head,watched", [("ab", 12, 1000, 1000), ("abc", 9, 20, 10), ("abcdefgh", 7, 40, 40), ("abcdefghijklmnop", 14, 1000, 300)])
def test_batches_equal_one_merge_at_a_time(letters, longest, head, watched):
    rng = random.Random(len(letters) * 31 + longest)
    saved = 0
    for _ in range(60):
        words = [[ord(c) for c in rng.choices(letters, weights=range(1, len(letters) + 1), k=rng.randint(1, longest))] for _ in range(rng.randint(1, 120))]
        counts = [rng.choice([1, 1, 2, 3, 17]) for _ in words]
        want = plain_learn(words, counts, 60)
        got, rounds = batched_learn(words, counts, 60, head, watched, 64)
        assert got == want
        assert batched_learn(words, counts, 60, head, watched, 1)[0] == want
        saved += len(want) - rounds
    assert saved > 0


def test_state_after_merges():
    rng = random.Random(8)
    for _ in range(200):
        words = [[rng.randint(1, 4) for _ in range(rng.randint(1, 15))] for _ in range(30)]
        counts = [rng.randint(1, 9) for _ in words]
        state, new = Words(words, counts), 10
        table = Pairs()
        table.change(*state.counts())
        for _ in range(6):
            symbols = sorted({s for w in words for s in w})
            steps = []
            for _ in range(rng.randint(1, 3)):
                steps.append((rng.choice(symbols), rng.choice(symbols), new))
                new += 1
            table.change(*state.apply(steps))
            for a, b, c in steps:
                words = [plain_merge(w, a, b, c) for w in words]
            have = {(int(k) // KEY, int(k) % KEY): int(n) for k, n in zip(table.keys, table.n)}
            assert have == plain_counts(words, counts)
            assert [state.sym[s:s + z].tolist() for s, z in zip(state.start, state.size)] == words
            every = np.array(sorted(a * KEY + b for a, b in have), np.int64)
            triples = {}
            for w, n in zip(words, counts):
                for x, y, z in zip(w, w[1:], w[2:]):
                    for pair, side, other in ((x * KEY + y, 1, z), (y * KEY + z, 0, x)):
                        code = (int(np.searchsorted(every, pair)) * 2 + side) * KEY + other
                        triples[code] = triples.get(code, 0) + n
            assert dict(zip(*(v.tolist() for v in state.triples(every)))) == triples if len(every) else True
            keys, n = table.head(5)
            assert [(int(k), int(c)) for k, c in zip(keys, n)] == sorted(((a * KEY + b, c) for (a, b), c in have.items()), key=lambda x: (-x[1], x[0]))[:5]


def test_overlapping_pairs_merge_left_to_right():
    assert merged(np.array([7, 7, 7, -1, 7, 7, 7, 7, -1]), 7, 7, 9).tolist() == [9, 7, -1, 9, 9, -1]
    assert merged(np.array([1, 2, 1, 2, 2, -1]), 1, 2, 3).tolist() == [3, 3, 2, -1]


def test_empty_state():
    state = Words([], [])
    assert len(state.counts()[0]) == 0 and len(state.apply([(1, 2, 3)])[0]) == 0 and len(state.triples(np.array([5]))[0]) == 0
    assert len(Pairs().head(3)[0]) == 0


def test_learner_over_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(bpe, "REFRESH", 2)
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(400)})
    counts = [rng.randint(1, 30) for _ in words]
    df = spark.createDataFrame(list(zip(words, counts)), "word string, n long").repartition(5)
    model = bpe.learn_bpe(df, 10 ** 9, specials=[], max_merges=120, checkpoint_every=3, batch=16, head=50)
    ids = {c: i for i, c in enumerate("abcde")}
    tokens = list("abcde")
    want = []
    # ids of merged tokens follow the alphabet; a token that comes up twice keeps its first id
    found = [[ids[c] for c in w] for w in words]
    while len(want) < 120:
        pairs = plain_counts(found, counts)
        (a, b), n = min(pairs.items(), key=lambda x: (-x[1], x[0]))
        want.append((tokens[a], tokens[b], n))
        new = ids.setdefault(tokens[a] + tokens[b], len(tokens))
        if new == len(tokens):
            tokens.append(tokens[a] + tokens[b])
        found = [plain_merge(w, a, b, new) for w in found]
    assert model.merges == want and model.alphabet == list("abcde")

