"""Periodic run detection in word sequences by seeds on diagonals.

A run is a stretch of words with smallest period q that is at least
max(6, 4 q) words long and that no neighbouring word extends. Its words
agree with the words q further on (the diagonal, or lag, q) over
length - q >= max(5, 3 q) places, so every run of a lag from lo to 1.5 lo
holds a seed: a k-gram, k = max(5, 3 lo), that occurs at i and at i + q.

As k >= 2 q, a nearer occurrence of the k-gram inside the run would give the
run a smaller period; so only pairs of successive occurrences are seeds, and a
seed's lag is the smallest period of the run that it lies in. Seeds grow along
their diagonal in both directions; per lag, a table of how far the diagonal is
covered keeps later seeds of a run from growing it again. k-grams are compared
by exact ranks (pairs of ranks of shorter grams), not by hashes.

A document costs O(n log n) per level of lags and there are O(log n) levels;
levels end as soon as no k-gram occurs twice. Nothing is shuffled.
"""

from __future__ import annotations

from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
MIN_PERIODS = 4


class Run(NamedTuple):
    start: int
    length: int
    period: int


def split_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in UTF-8; splitting bytes knows exactly these six blanks."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _ranks(words: list) -> np.ndarray:
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers where both members are equal."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)


class _Grams:
    """Ranks of all k-grams for growing k, each from two overlapping grams of a power of two."""

    def __init__(self, ranks: np.ndarray):
        self.ranks, self.size = ranks, 1

    def of(self, k: int) -> np.ndarray | None:
        """Ranks of the k-grams, or None if none of them occurs twice (then no longer one does either)."""
        while 2 * self.size <= k:
            self.ranks = _paired(self.ranks[:-self.size], self.ranks[self.size:])
            self.size *= 2
            if int(self.ranks.max()) + 1 == len(self.ranks):
                return None
        n, gap = len(self.ranks) - (k - self.size), k - self.size
        return _paired(self.ranks[:n], self.ranks[gap:gap + n]) if gap else self.ranks


def _seeds(ranks: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of successive occurrences lo to hi apart; of neighbouring places on one lag only the first."""
    order = np.argsort(ranks, kind="stable")
    lag, at = np.diff(order), order[:-1]
    good = (np.diff(ranks[order]) == 0) & (lag >= lo) & (lag <= hi)
    lag, at = lag[good], at[good]
    by = np.lexsort((at, lag))
    lag, at = lag[by], at[by]
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(lag) != 0) | (np.diff(at) != 1)
    return lag[first], at[first]


def _reach(ranks: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and j on agree, going by ``step`` (1 or -1); blocks double, so long runs are few steps."""
    total, block = 0, 32
    while True:
        room = min(block, len(ranks) - j if step > 0 else i + 1)
        if room <= 0:
            return total
        a = ranks[i:i + room] if step > 0 else ranks[i - room + 1:i + 1][::-1]
        b = ranks[j:j + room] if step > 0 else ranks[j - room + 1:j + 1][::-1]
        same = a == b
        if not same.all():
            return total + int(same.argmin())
        total, i, j, block = total + room, i + step * room, j + step * room, 2 * block


def find_runs(words: list) -> list[Run]:
    """All runs of a word sequence, by start, then period; words are any hashable values."""
    n = len(words)
    runs: list[Run] = []
    if n < MIN_LENGTH:
        return runs
    ranks = _ranks(words)
    grams, lo = _Grams(ranks), 1
    while MIN_PERIODS * lo <= n:
        hi = lo + lo // 2
        seeds = grams.of(max(MIN_LENGTH - 1, (MIN_PERIODS - 1) * lo))
        if seeds is None:
            break
        covered: dict[int, int] = {}
        for lag, at in zip(*(x.tolist() for x in _seeds(seeds, lo, hi))):
            if at < covered.get(lag, 0):
                continue
            start = at - _reach(ranks, at - 1, at + lag - 1, -1)
            end = at + _reach(ranks, at, at + lag, 1)
            covered[lag] = end
            if end + lag - start >= max(MIN_LENGTH, MIN_PERIODS * lag):
                runs.append(Run(start, end + lag - start, lag))
        lo = hi + 1
    runs.sort(key=lambda r: (r.start, r.period))
    return runs


def collapse(words: list, runs: list[Run]) -> list:
    """The words without those that some run holds after its first ``period`` words."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        edge[r.start + r.period] += 1
        edge[r.start + r.length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def planted(words: list, doc_id: int | None) -> list:
    """The words of the contract's test material: a tenth of all ids repeat a period from some place to the end.

    A null id plants nothing.
    """
    h, n = crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(f, pa.int64()) for f in Run._fields]))), ("collapsed", pa.string())])
FOUND_SQL = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"
#: Bytes of text that one output batch stands for at most (a longer text is a batch of its own).
BATCH_BYTES = 4_000_000


def periodic_runs(docs: DataFrame, text: str = "text", damage: str | None = None, out: str = "found") -> DataFrame:
    """``docs`` with a struct column ``out`` (n_words, runs, collapsed) in place of ``text``.

    ``runs`` are all runs by start, then period; ``collapsed`` is the kept
    words joined by one blank. ``damage`` names an id column by which
    ``planted`` rewrites the words first (the contract's test material).
    Null, empty and blank texts have no words, no runs and an empty text;
    repeated rows stay repeated; a column that is called like ``out`` is
    replaced; an empty table gives an empty one. A text is one task's work,
    with some eight numbers a word in memory.
    """
    keep = [c for c in docs.columns if c not in (text, out)]
    part = docs.select(*keep, (F.col(damage).cast("long") if damage else F.lit(None).cast("long")).alias("_run_id"),
                       F.col(text).alias("_run_text"))
    schema = docs.select(*keep, F.lit(None).cast(FOUND_SQL).alias(out)).schema

    def found(doc_id, value):
        words = split_words(value)
        if damage:
            words = planted(words, doc_id)
        runs = find_runs(words)
        return {"n_words": len(words), "runs": [r._asdict() for r in runs],
                "collapsed": b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")}

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(len(keep)), batch.column(len(keep) + 1)
            start, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                rows.append(found(ids[i].as_py(), value))
                size += len(value or "")
                if size > BATCH_BYTES or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(start, len(rows)) for c in batch.columns[:len(keep)]), pa.array(rows, FOUND)], names=[*keep, out])
                    start, size, rows = i + 1, 0, []

    return part.mapInArrow(run, schema)


def summary(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every document.

    start, length and period are those of the longest run (ties: smallest
    start, then period), null without a run; so is the exponent, a thousand
    times length by period, rounded down. Other columns than doc_id and text
    are not read.
    """
    rows = periodic_runs(docs.select("doc_id", "text"), damage="doc_id")
    lines = F.transform("found.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.expr("array_min(transform(found.runs, r -> struct(-r.length as rest, r.start as start, r.period as period)))")
    return (rows.withColumn("best", best)
            .select("doc_id", F.size("found.runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    (-F.col("best.rest")).alias("length"), F.col("best.period").alias("period"),
                    F.expr("(-best.rest * 1000) div best.period").alias("exponent_milli"),
                    F.sha2(F.when(F.size("found.runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit("")), 256)
                    .alias("runs_sha256"),
                    F.sha2("found.collapsed", 256).alias("collapsed_sha256")))
