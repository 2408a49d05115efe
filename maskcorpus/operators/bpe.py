"""Corpus vocabulary: word counts, pair counts and greedy BPE merges on Spark
(SURVEY J1-J4, §7.5).

Distinct words are written once and dealt into shards that stay cached
(``pair_state``): their symbols, an index pair -> words, and, dealt by pair, a
table pair -> count. Each round is one job. It carries out the merges of the
last round in the words that hold them, sends the changed counts to the pair
shards and returns the head of the pair table: highest count, then lowest
``(id(a), id(b))``. Only heads, bounds of their pairs and the merge list
(bounded by ``vocab_size``) reach the driver. Shards are partitions of an RDD,
as each needs imperative work on state that it alone owns; lineage is cut by
reliable checkpoints.
"""

from __future__ import annotations

import heapq
import math
import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskcorpus.config import SPECIAL_TOKENS
from maskcorpus.functions.bytelevel import byte_level
from maskcorpus.functions.pretokens import counting, kind_runs
from maskcorpus.operators.pair_state import KEY, Pairs, Words, dealt, summed
from maskcorpus.session import bounded_batches, ensure_checkpoint_dir, written_once


def word_frequencies(df: DataFrame, text: str = "text", normalise: bool = True) -> DataFrame:
    """``(word, n)``: byte-level pre-token counts over the corpus.

    Raw pre-tokens are counted first, by the batch and the task, so the shuffle has
    distinct words per task; the byte map then runs on distinct words only.
    """
    return counted_words(df, [text], normalise=normalise).select(byte_level("w").alias("word"), "n")


def counted_words(df: DataFrame, cols: list[str], specials: re.Pattern | None = None, normalise: bool = True) -> DataFrame:
    """``(w, n)``: how often each pre-token occurs in the text columns; with ``specials`` those stand whole."""
    spark = df.sparkSession
    bounded_batches(spark)
    texts = df.select(*[F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(cols)])
    rows = texts.mapInArrow(counting(kind_runs(spark), specials, normalise), "w string, more long")
    # a row is one occurrence and ``more`` further ones
    return rows.groupBy("w").agg((F.count(F.lit(1)) + F.sum("more")).alias("n"))


@dataclass
class BpeModel:
    """Learned vocabulary (driver-side lists, bounded by ``vocab_size``)."""

    specials: list[str]
    alphabet: list[str]
    merges: list[tuple[str, str, int]]  # (left, right, pair count)

    def tokens(self) -> list[str]:
        out, seen = [], set()
        for t in self.specials + self.alphabet + [a + b for a, b, _ in self.merges]:
            if t not in seen:
                seen.add(t)
                out.append(t)
        return out

    def vocab(self, spark: SparkSession) -> DataFrame:
        """``(token, id)``: specials, alphabet by code point, then merges in order."""
        rows = [(t, i) for i, t in enumerate(self.tokens())]
        return spark.createDataFrame(rows, "token string, id int")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, n) for r, (a, b, n) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string, pair_count long")


def alphabet(words: DataFrame, word: str = "word") -> list[str]:
    """Distinct characters of the words, by code point (byte-level input: at most 256)."""
    chars = words.select(F.explode(F.split(word, "")).alias("c")).where(F.col("c") != "").distinct()
    return sorted((r[0] for r in chars.collect()), key=ord)


def _safe_batch(top: list, bounds: dict, budget: int, overlaps: dict | None = None, least: int = 0) -> list:
    """Merges from one pair count that greedy BPE provably takes next, in order, with their counts at that time.

    ``top`` is the pair table's head, sorted by (count desc, a, b); all other
    pairs have at most ``least``. Two things can change while merges are taken:

    * Merging ``(p, q)`` takes occurrences from ``(c, p)`` and ``(q, d)`` only.
      A pair that lost some on one side is put back with its count less
      ``overlaps``, which has the counts of triples ``c p q`` and ``p q d``. This
      is exact if all occurrences of the merges it met were free when they were
      taken. For a pair that met others, or some on both sides, that is only
      the most it can have, and the batch ends where it might come next.
    * Merging ``(a, b)`` creates ``(x, ab)`` at most as often as the triple
      ``x a b`` occurred and ``(ab, y)`` at most as often as ``a b y``. ``bounds``
      has the largest such count per pair (without one: no bound), and a merge
      is taken only while its count is strictly above all bounds so far.

    So the merge sequence equals one merge per round.
    """
    def overlap(p: int, q: int, r: int) -> int | None:
        """Occurrences of a triple whose pairs were both watched; without an entry there are none."""
        return (overlaps or {}).get((p, q, r), 0) if (p, q) in bounds and (q, r) in bounds else None

    taken: list = []
    after: dict[int, list] = {}  # left symbol of taken merges -> (right symbol, free)
    before: dict[int, list] = {}  # right symbol -> (left symbol, free)
    bound = -1
    heap = [(-n, a, b, n) for a, b, n in top]
    heapq.heapify(heap)
    while heap and len(taken) < budget:
        lost, a, b, n = heapq.heappop(heap)
        count = -lost
        if taken and (count <= bound or count <= least):
            break
        right, left = after.get(b, []), before.get(a, [])
        if right or left:
            right = [overlap(a, b, q) if free else None for q, free in right]
            left = [overlap(p, a, b) if free else None for p, free in left]
            most = n if a == b else n - max(sum(x or 0 for x in right), sum(x or 0 for x in left))
            if most < count:  # merges were taken since the pair's count was last reckoned
                if most > 0:
                    heapq.heappush(heap, (-most, a, b, n))
                continue
            if a == b or right and left or None in right + left:
                break
            free = False
        else:
            free = a != b
        taken.append((a, b, count))
        after.setdefault(a, []).append((b, free))
        before.setdefault(b, []).append((a, free))
        bound = max(bound, bounds.get((a, b), math.inf))
    return taken


#: Distinct words of one shard: some 6 MB of state, of which a Python worker holds a few copies.
SHARD_WORDS = 100_000
#: Shards of one partition: a worker holds one of them at a time, and a round has fewer tasks.
PARTITION_SHARDS = 4
#: Shards are byte arrays already: neither serialised nor compressed once more in every round.
KEPT = StorageLevel.MEMORY_AND_DISK_DESER
#: Rounds after which word shards are cached anew; the first so many rounds merge in most words, which costs more than caching.
REFRESH = 8
EARLY = 24
#: Pairs of the head whose triples are counted for the next round; a batch of merges is shorter than that.
WATCHED = 128


def _word_shards(words: DataFrame, tok_id: dict[str, int], partitions: int):
    """``Words`` of SHARD_WORDS words at most, several of them one behind the other in a partition, from rows (word, n)."""
    def packed(held, counts):
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Words(held, counts), 5)], pa.large_binary())], names=["state"])

    def run(batches):
        held, counts = [], []
        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if w:
                    held.append([tok_id[c] for c in w])
                    counts.append(n)
                    if len(held) >= SHARD_WORDS:
                        yield packed(held, counts)
                        held, counts = [], []
        yield packed(held, counts)

    return words.repartition(partitions).mapInArrow(run, "state binary").rdd.map(lambda r: pickle.loads(r[0]))


def _replayed(merges: list):
    """The state after batches of merges."""
    def run(state: Words) -> Words:
        for batch in merges:
            state.apply(batch)
        return state
    return run


def _round(states, pending: list, tables, watched: np.ndarray, head: int):
    """Pair shards (table, heads, bounds, overlaps) after the last batch of ``pending``.

    Word shards are cached before the batches of ``pending``: repeating a few
    batches costs less than writing all words in every round. Without any
    batch, all counts are sent. ``watched`` are pairs whose triples are counted
    after the merges.
    """
    shards = tables.getNumPartitions()

    def step(state: Words):
        state = _replayed(pending[:-1])(state)
        keys, by = state.apply(pending[-1]) if pending else state.counts()
        yield from dealt(keys, by, shards, "count")
        if len(watched):
            yield from dealt(*state.triples(watched), shards, "triple")

    def update(one):
        (table, *_), sent = one
        bound, overlap = np.zeros(len(watched), np.int64), (np.zeros(0, np.int64),) * 3
        for kind in ("count", "triple"):
            found = [x[1:] for _, x in sent if x[0] == kind]
            keys, by = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
            if kind == "count":
                table.change(keys, by)
            elif len(keys):
                keys, total = summed(keys, by)
                place = keys // (2 * KEY)
                np.maximum.at(bound, place, total)
                # a b y where (b, y) is watched too
                follower = watched[place] % KEY * KEY + keys % KEY
                known = (keys // KEY % 2 == 1) & np.isin(follower, watched)
                overlap = (watched[place[known]], keys[known] % KEY, total[known])
        return table, table.head(head), bound, overlap

    messages = states.flatMap(step).partitionBy(shards, _same).glom()
    return tables.zip(messages).map(update).persist(KEPT)


def _same(shard: int) -> int:
    return shard


def learn_bpe(words: DataFrame, vocab_size: int, specials: list[str] | None = None, word: str = "word",
              n: str = "n", checkpoint_every: int = 20, max_merges: int | None = None,
              batch: int = 256, head: int = 1024) -> BpeModel:
    """Greedy merges until the vocabulary holds ``vocab_size`` tokens or no pair is left.

    Exact: the merge sequence equals one merge per round. A round reads the
    words that hold the last round's merges and may commit up to ``batch``
    merges when ``_safe_batch`` proves their order (``batch=1`` gives the plain
    loop). ``head`` pairs of each shard are all that reach the driver.
    """
    spark = words.sparkSession
    ensure_checkpoint_dir(spark)
    specials = list(SPECIAL_TOKENS if specials is None else specials)
    table = written_once(words.select(F.col(word).alias("word"), F.col(n).cast("long").alias("n")), "words")
    alpha = [c for c in alphabet(table) if c not in set(specials)]
    tokens = specials + alpha
    tok_id = {t: i for i, t in enumerate(tokens)}
    id_tok = dict(enumerate(tokens))
    sc = spark.sparkContext
    # whole waves of tasks, each with some shards of words
    partitions = sc.defaultParallelism * max(1, -(-table.count() // (sc.defaultParallelism * PARTITION_SHARDS * SHARD_WORDS)))
    states = _word_shards(table, tok_id, partitions).persist(KEPT)
    # pairs are few beside words, so they need no more shards with more words; a table is empty at first, in a partition of its own
    pairs = sc.defaultParallelism
    tables = sc.parallelize([(i, None) for i in range(pairs)]).partitionBy(pairs, _same).glom().map(lambda _: (Pairs(),))
    pending, watched = [], np.zeros(0, np.int64)
    merges: list[tuple[str, str, int]] = []
    old, rounds = tables, 0
    while len(tok_id) < vocab_size and (max_merges is None or len(merges) < max_merges):
        old, tables = tables, _round(states, pending, tables, watched, head)
        rounds += 1
        if rounds % checkpoint_every == 0:  # cuts lineage; reliable storage survives executor loss
            tables.checkpoint()
        found = tables.map(lambda x: x[1:]).collect()
        old.unpersist()
        if pending and (rounds <= EARLY or rounds % REFRESH == 0):
            before, states = states, states.map(_replayed(pending)).persist(KEPT)
            if rounds % (REFRESH * checkpoint_every) == 0:
                states.checkpoint()
            states.count()
            before.unpersist()
            pending = []
        keys, counts = (np.concatenate([h[i] for h, *_ in found]) for i in (0, 1))
        order = np.lexsort((keys, -counts))
        # beyond the head, and beyond any shard's head, no pair has more than this
        least = max([int(h[1][-1]) for h, *_ in found if len(h[0]) == head], default=0)
        top = [(k // KEY, k % KEY, c) for k, c in zip(keys[order].tolist(), counts[order].tolist())]
        if not top or top[0][2] < 1:
            break
        bound = np.max([x for _, x, _ in found], axis=0) if len(watched) else watched
        bounds = {(k // KEY, k % KEY): x for k, x in zip(watched.tolist(), bound.tolist())}
        overlaps = {(k // KEY, k % KEY, y): x for _, _, o in found for k, y, x in zip(*(v.tolist() for v in o))}
        budget = min(batch, vocab_size - len(tok_id), max_merges - len(merges) if max_merges is not None else batch)
        chosen = _safe_batch(top, bounds, budget, overlaps, least)
        steps = []
        for a, b, cnt in chosen:
            left, right = id_tok[a], id_tok[b]
            new = left + right
            if new not in tok_id:
                tok_id[new] = len(id_tok)
                id_tok[tok_id[new]] = new
            merges.append((left, right, int(cnt)))
            steps.append((a, b, tok_id[new]))
        pending = [*pending, steps]
        taken = {(a, b) for a, b, _ in chosen}
        watched = np.array(sorted(a * KEY + b for a, b, _ in top[:WATCHED] if (a, b) not in taken), np.int64)
    tables.unpersist()
    states.unpersist()
    return BpeModel(specials, alpha, merges)


def pair_counts(words: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """Adjacent symbol pairs weighted by word count, over single-character symbols."""
    chars = F.split(word, "")
    k = F.size(chars) - 1
    z = F.arrays_zip(F.slice(chars, 1, k).alias("l"), F.slice(chars, 2, k).alias("r"))
    return (words.where(F.length(word) >= 2).select(F.explode(z).alias("p"), n)
            .groupBy(F.col("p.l").alias("left"), F.col("p.r").alias("right")).agg(F.sum(n).alias("n")))

