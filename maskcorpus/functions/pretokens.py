"""Pre-tokens of whole Arrow batches: the same as ``bytelevel.pretokenize`` gives, by array operations.

Pre-tokens cover a text without gaps, so all that is to be found is where they
begin. That takes the kind of every character (letter, number, white space,
other) and its neighbours' kinds; the words are then slices of one buffer, and
Arrow counts or numbers the distinct ones. The kinds are asked of the JVM's
regex classes once, so both ways agree on every character.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from maskcorpus.functions.bytelevel import _WS

SPACE, LETTER, NUMBER, OTHER = range(4)
#: Characters that are split at once: each takes some ten bytes on the way.
BLOCK_CHARS = 1 << 20
#: Bytes of distinct words that a task holds before it hands on their counts.
HELD_BYTES = 32 << 20


@functools.lru_cache(maxsize=None)
def _runs(_jvm_key: int) -> tuple[bytes, bytes]:
    spark = SparkSession.getActiveSession()
    java = spark._jvm.java.util.regex.Pattern
    points = np.concatenate([np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4")])
    text = points.tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, OTHER, np.uint8)
    # every character of a class becomes one that is of the class itself
    for kind, pattern, one in ((SPACE, _WS, " "), (LETTER, r"\p{L}", "A"), (NUMBER, r"\p{N}", "0")):
        got = np.frombuffer(java.compile(pattern).matcher(text).replaceAll(one).encode("utf-32-le"), "<u4")
        kinds[points[got == ord(one)]] = kind
    first = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]])).astype(np.int32)
    return first.tobytes(), kinds[first].tobytes()


def kind_runs(spark: SparkSession) -> tuple[bytes, bytes]:
    """Kinds of all characters as (first character, kind) of runs: some ten kilobytes that go along with a function."""
    return _runs(id(spark.sparkContext._jvm))


@functools.lru_cache(maxsize=1)
def _kinds(runs: tuple[bytes, bytes]) -> np.ndarray:
    first, kind = np.frombuffer(runs[0], np.int32), np.frombuffer(runs[1], np.uint8)
    return np.repeat(kind, np.diff(np.append(first, 0x110000)))


def nfkc_text(text: str) -> str:
    return text if text.isascii() or unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)


def begins(cp: np.ndarray, kind: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Which characters begin a pre-token. ``edge`` (one longer) marks where a text begins, and the end."""
    n = len(cp)
    white, blank = kind == SPACE, cp == 32
    start = edge[:n].copy()
    # a run of one kind; a blank before a letter, number or other character belongs to that
    start[1:] |= (kind[1:] != kind[:-1]) & (white[1:] | ~blank[:-1])
    # the last of several white spaces stands alone, or leads on, if more text follows
    start[1:-1] |= white[1:-1] & white[:-2] & ~white[2:] & ~edge[2:n]
    # 's 't 'm 'd 're 've 'll where a pre-token begins
    for q in np.flatnonzero(cp == 39).tolist():
        if not (edge[q] or kind[q - 1] in (LETTER, NUMBER) or white[q - 1] and not blank[q - 1]):
            continue
        a = chr(cp[q + 1]) if q + 1 < n and not edge[q + 1] else ""
        b = chr(cp[q + 2]) if a and q + 2 < n and not edge[q + 2] else ""
        size = 2 if a in ("s", "t", "m", "d") else 3 if a + b in ("re", "ve", "ll") else 0
        if size:
            start[q + 1] = False
            if q + size < n:
                start[q + size] = True
    return start


def split(texts: list[str | None], runs: tuple[bytes, bytes], specials: re.Pattern | None = None,
          normalise: bool = True) -> tuple[pa.StringArray, np.ndarray]:
    """All pre-tokens of the texts, in order, and how many each text has.

    With ``specials`` (a pattern with one group) they are cut out of the raw
    texts first and stand whole; what is between them is normalised by itself.
    """
    parts: list[str] = []
    whole: list[int] = []  # of parts, the special tokens
    held = np.zeros(len(texts), np.int64)  # characters of each text
    for i, text in enumerate(texts):
        if not text:
            continue
        for x in specials.split(text) if specials is not None and "<" in text else [text]:
            if not x:
                continue
            if normalise:  # leaves special tokens alone
                x = nfkc_text(x)
            if specials is not None and x[:1] == "<" and specials.fullmatch(x):
                whole.append(len(parts))
            parts.append(x)
            held[i] += len(x)
    joined = "".join(parts)
    if not joined:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    cp = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(size)
    edge = np.zeros(len(cp) + 1, bool)
    edge[ends - size] = edge[-1] = True
    start = begins(cp, _kinds(runs)[cp], edge)
    for k in whole:
        start[ends[k] - size[k] + 1:ends[k]] = False
    at = np.flatnonzero(start)
    data = joined.encode()
    if len(data) == len(cp):
        offsets = at
    else:
        width = 1 + (cp >= 0x80).view(np.int8) + (cp >= 0x800).view(np.int8) + (cp >= 0x10000).view(np.int8)
        offsets = (np.cumsum(width, dtype=np.int64) - width)[at]
    offsets = np.append(offsets, len(data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
    return words, np.diff(np.searchsorted(at, np.concatenate([[0], np.cumsum(held)])))


def blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in runs of BLOCK_CHARS characters, or one longer text."""
    first, chars = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > first and chars + n > BLOCK_CHARS:
            yield texts[first:i]
            first, chars = i, 0
        chars += n
    if first < len(texts):
        yield texts[first:]


def counting(runs: tuple[bytes, bytes], specials: re.Pattern | None = None, normalise: bool = True):
    """For ``mapInArrow`` over text columns: rows (w, more), each of which stands for one occurrence of a word and ``more`` further ones.

    A task joins the counts of its blocks, and hands them on whenever the
    distinct words pass HELD_BYTES.
    """
    def total(held: list[pa.Table]) -> pa.Table:
        got = pa.concat_tables(held).group_by("w", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"w": got["w"], "n": got["n_sum"]})

    def handed_on(table: pa.Table) -> Iterator[pa.RecordBatch]:
        out = pa.table({"w": table["w"], "more": pc.subtract(table["n"], 1)})
        yield from out.combine_chunks().to_batches(max_chunksize=50_000)

    def run(batches):
        held, loose = [], 0  # the first table has the counts so far; loose: bytes of those behind it
        for batch in batches:
            for column in batch.columns:
                for texts in blocks(column.to_pylist()):
                    words, _ = split(texts, runs, specials, normalise)
                    if not len(words):
                        continue
                    counts = pc.value_counts(words)
                    held.append(pa.table({"w": counts.field("values"), "n": counts.field("counts")}))
                    loose += held[-1].nbytes
                    if loose > HELD_BYTES:
                        held, loose = [total(held)], 0
                        if held[0].nbytes > HELD_BYTES:
                            yield from handed_on(held[0])
                            held = []
        if held:
            yield from handed_on(total(held))
    return run


def picked(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + size]`` one behind the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]
