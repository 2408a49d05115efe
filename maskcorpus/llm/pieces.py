"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of the vocabulary has a whitespace marker after another character,
so no merge can cross from one marked word (the markers and the characters up
to the next marker) into the next. Each distinct marked word is segmented
once into a table of ids; a text's ids are the table's entries joined by
position. Tables live in the Python workers and are bounded, so nothing is
shuffled and no key can be hot.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Bytes of text that are encoded at a time.
CHUNK_BYTES = 2_000_000
#: Distinct marked words that a worker's table holds before it starts afresh.
TABLE_WORDS = 300_000

_MARKED = re.compile(" +[^ ]+| +")


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker and with blanks for further ones.

    The library puts one marker before a text and turns blanks into markers;
    a marker character in the text is the same as a blank.
    """
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " " and MARK not in text:
        return text.split(" ")
    return [w[1:] for w in _MARKED.findall(" " + text.replace(MARK, " "))]


class WordTable:
    """Ids of distinct marked words: word -> row, and per row a slice of one flat array."""

    def __init__(self, model: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        crossing = [p for p in pieces if re.search(f"[^{MARK}]{MARK}", p)]
        if crossing:
            raise ValueError(f"pieces cross a whitespace marker: {crossing[:5]}")
        self.blank = [self.model.piece_to_id(MARK)]
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.start = self.length = self.flat = np.zeros(0, np.int64)

    def add(self, words: set[str]) -> None:
        new = list(words.difference(self.row))
        if not new:
            return
        ids = [i or self.blank for i in self.model.encode(new, num_threads=1)]
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int64, int(length.sum()))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]."""
        words = [marked_words(t) for t in texts]
        if len(self.row) > TABLE_WORDS:
            self.clear()
        self.add(set(chain.from_iterable(words)))
        ends = np.cumsum([0, *map(len, words)])
        rows = np.fromiter(map(self.row.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]))
        length = self.length[rows]
        upto = np.concatenate([[0], np.cumsum(length)])
        ids = self.flat[np.repeat(self.start[rows] - upto[:-1], length) + np.arange(upto[-1])]
        return upto[ends], ids

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        flat, at = ids.tolist(), offsets.tolist()
        return self.model.decode([flat[a:b] for a, b in zip(at, at[1:])], num_threads=1) if len(at) > 1 else []


@lru_cache(maxsize=2)
def word_table(model: str) -> WordTable:
    """The table of this worker process."""
    return WordTable(model)


def _slices(sizes: list[int]):
    """Slices of texts of about CHUNK_BYTES bytes together; one long text is a slice of its own."""
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > CHUNK_BYTES:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (the library's decoding of them) to ``docs`` without ``text``.

    ``model`` is the path of a SentencePiece model on every machine. Ids have
    no begin or end marks and no sampling. Null text: no ids, empty text.
    Columns named ids or decoded are replaced; repeated rows stay repeated;
    an empty table gives an empty one.
    """
    keep = [c for c in docs.columns if c not in (text, "ids", "decoded")]
    part = docs.select(*keep, F.col(text).alias("_piece_text"))
    schema = docs.select(*keep, F.lit(None).cast("array<int>").alias("ids"), F.lit("").alias("decoded")).schema

    def run(batches):
        table = word_table(model)
        for batch in batches:
            texts = batch.column(len(keep))
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            for a, b in _slices(sizes):
                offsets, ids = table.encode([t or "" for t in texts.slice(a, b - a).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[: len(keep)]), lists,
                     pa.array(table.decode(offsets, ids), pa.string())], names=[*keep, "ids", "decoded"])

    return part.mapInArrow(run, schema)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    coded = encode(docs.select("doc_id", "text"), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
