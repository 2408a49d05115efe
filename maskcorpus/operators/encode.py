"""Encoding texts to fixed-length token ids, and decoding.

Native Spark does the text work: split on special tokens, pre-tokenize,
byte-map. ``encode`` needs no shuffle; ``encode_by_dictionary`` segments each
distinct word once for the whole corpus and joins the ids back. The per-word merge loop is a small Python helper in an Arrow-batched
UDF with a per-task cache; it reads the merge table from a broadcast variable
(bounded by ``vocab_size``). The encoding is narrow: no shuffle of the token stream.
Layout follows the plain tokenizer contract: ``</s>`` first (Q21), truncated to
``max_len``, right-padded with ``<pad>`` (id 0), attention mask 1 on real tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskcorpus.config import EOS_TOKEN, PAD_TOKEN, SPECIAL_TOKENS, UNK_TOKEN
from maskcorpus.functions.bytelevel import byte_level, byte_to_char, needs_nfkc, pretokenize
from maskcorpus.functions.pretokens import blocks, kind_runs, picked, split
from maskcorpus.operators.bpe import BpeModel, counted_words
from maskcorpus.session import bounded_batches

# Special tokens as one pattern: <pad> <unk> </s> <extra_id_0> .. <extra_id_99>
SPECIAL_RE = r"<pad>|<unk>|</s>|<extra_id_(?:[1-9]?[0-9])>"
_IS_SPECIAL = r"\A(?:" + SPECIAL_RE + r")\z"
_SPECIAL_SPLIT = re.compile(f"({SPECIAL_RE})")
_SEGMENTS = r"(?:" + SPECIAL_RE + r")|(?s:(?:(?!" + SPECIAL_RE + r").)+)"
#: Tokens of a model that tasks get as a broadcast: some hundred bytes each.
MAX_VOCAB = 1_000_000
#: Special tokens among pieces: pre-tokens never mix letters with "<" and ">", so none of them equals one.
_SPECIALS = frozenset(SPECIAL_TOKENS)
_GAP = "\u0000"  # joins tokens in a literal (the byte map never gives it)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_segments(col):
    import unicodedata

    def one(segs):
        if segs is None:
            return None
        return [x if x in _SPECIALS else unicodedata.normalize("NFKC", x) for x in segs]
    return col.map(one)


def segments(col) -> Column:
    """Raw text split into special tokens and the runs between them (a run never is or begins with a special token)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit(_SEGMENTS), 0)


def normalised_segments(col) -> Column:
    """``segments`` with NFKC on the non-special runs; Python sees non-ASCII rows only."""
    c = F.col(col) if isinstance(col, str) else col
    segs = segments(c)
    return F.coalesce(_nfkc_segments(F.when(needs_nfkc(c), segs)), segs)


def raw_pieces(segs: Column) -> Column:
    """Special tokens and pre-tokens, in order."""
    return F.flatten(F.transform(segs, lambda x: F.when(x.rlike(_IS_SPECIAL), F.array(x)).otherwise(pretokenize(x))))


class Encoder:
    """Driver-side tables of a learned model; shipped to tasks once as a broadcast."""

    def __init__(self, model: BpeModel):
        self.tokens = model.tokens()
        if len(self.tokens) > MAX_VOCAB:
            raise ValueError(f"a vocabulary of {len(self.tokens)} tokens is not broadcast (at most {MAX_VOCAB})")
        self.tok_id = {t: i for i, t in enumerate(self.tokens)}
        self.ranks = {}
        for r, (a, b, _) in enumerate(model.merges):
            key = (self.tok_id[a], self.tok_id[b])
            if key not in self.ranks:
                self.ranks[key] = (r, self.tok_id[a + b])
        self.unk = self.tok_id.get(UNK_TOKEN)
        self.pad = self.tok_id.get(PAD_TOKEN, 0)
        self.eos = self.tok_id.get(EOS_TOKEN)
        self.chars = dict(enumerate(byte_to_char()))

    def raw_ids(self, word: str) -> list[int]:
        """``word_ids`` of a pre-token as it stands in the text."""
        return self.word_ids(word.encode("utf-8").decode("latin-1").translate(self.chars))

    def word_ids(self, word: str) -> list[int]:
        """BPE of one byte-level word: merge the lowest-rank pair, all occurrences left to right."""
        syms = [self.tok_id.get(ch, self.unk) for ch in word]
        syms = [s for s in syms if s is not None]
        ranks, n = self.ranks, len(syms)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # candidate merges as (rank, place): a heap keeps a very long word at n log n
        heap = [(r[0], i) for i in range(n - 1) if (r := ranks.get((syms[i], syms[i + 1])))]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if syms[i] is None or j >= n:
                continue
            r = ranks.get((syms[i], syms[j]))
            if r is None or r[0] != rank:
                continue
            syms[i], syms[j] = r[1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := ranks.get((syms[a], syms[b]))):
                    heappush(heap, (r[0], a))
        return [s for s in syms if s is not None]


#: Words whose ids a task keeps.
CACHED_WORDS = 200_000


def _ids_udf(bc):
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(cols: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc: Encoder = bc.value
        cache: dict[str, list[int]] = {}  # of the whole task, as batches are small

        def one(ps):
            if ps is None:
                return None
            out: list[int] = []
            for p in ps:
                if p in _SPECIALS:
                    out.append(enc.tok_id[p])
                    continue
                got = cache.get(p)
                if got is None:
                    got = enc.raw_ids(p)  # bytes are mapped once a word here, not once a token before
                    if len(cache) < CACHED_WORDS:
                        cache[p] = got
                out.extend(got)
            return out
        for col in cols:
            yield col.map(one)
    return ids


def _all_token_ids(df: DataFrame, outs: dict[str, str], model: BpeModel, first: int | None = None) -> DataFrame:
    """``token_ids`` of several columns (column -> new column) by the same Python workers."""
    spark = df.sparkSession
    bounded_batches(spark)
    encoder = Encoder(model)
    bc = spark.sparkContext.broadcast(encoder)
    d = df.withColumns({"_segs_" + c: normalised_segments(c) for c in outs})
    parts = {c: raw_pieces(F.col("_segs_" + c)) for c in outs}
    if first is not None and encoder.unk is not None:
        parts = {c: F.slice(x, 1, first) for c, x in parts.items()}
    return d.withColumns({out: _ids_udf(bc)(parts[c]) for c, out in outs.items()}).drop(*["_segs_" + c for c in outs])


def token_ids(df: DataFrame, col: str, model: BpeModel, out: str = "ids", first: int | None = None) -> DataFrame:
    """Unpadded ids of a text column (no ``</s>``): all of them, or enough for the ``first`` so many.

    With ``<unk>`` in the vocabulary every pre-token yields an id or more, so
    ``first`` pre-tokens are enough and only they cross into Python.
    """
    return _all_token_ids(df, {col: out}, model, first)


def pad_to(ids: Column, eos_id: int, max_len: int, pad_id: int = 0) -> tuple[Column, Column]:
    """``(input_ids, attention_mask)``: ``</s>`` first, truncated to ``max_len``, right-padded."""
    seq = F.slice(F.concat(F.array(F.lit(eos_id)), ids), 1, max_len)
    n = F.size(seq)
    padded = F.concat(seq, F.array_repeat(F.lit(pad_id), F.lit(max_len) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))
    return padded, mask


def encode(df: DataFrame, col: str, model: BpeModel, max_len: int = 512, prefix: str = "",
           count: bool = False) -> DataFrame:
    """``{prefix}input_ids, {prefix}attention_mask`` (length ``max_len``).

    With ``count`` also ``{prefix}n_tokens``, the full length including
    ``</s>``; only then the whole text is encoded.
    """
    enc = Encoder(model)
    d = token_ids(df, col, model, "_ids", None if count else max_len - 1)
    ids, mask = pad_to(F.col("_ids"), enc.eos, max_len, enc.pad)
    d = d.withColumn(f"{prefix}input_ids", ids).withColumn(f"{prefix}attention_mask", mask)
    return (d.withColumn(f"{prefix}n_tokens", F.size("_ids") + 1) if count else d).drop("_ids")


def add_labels(df: DataFrame, target: str, model: BpeModel, max_len: int = 512) -> DataFrame:
    """``labels`` = padded ids of the target (pad stays 0, Q24)."""
    d = encode(df, target, model, max_len, prefix="_t_")
    return d.withColumnRenamed("_t_input_ids", "labels").drop("_t_attention_mask")


def encode_examples(df: DataFrame, model: BpeModel, max_len: int = 512) -> DataFrame:
    """J8 row shape for a trainer: ``input_ids, attention_mask, labels`` (+ ``kind``, ``split`` and ``id`` when present).

    The same as ``encode`` and ``add_labels``, with both texts encoded by the same Python workers.
    """
    enc = Encoder(model)
    keep = [c for c in ("kind", "split", "id") if c in df.columns]
    d = _all_token_ids(df.select(*keep, "input", "target"), {"input": "_ids", "target": "_t_ids"}, model, max_len - 1)
    ids, mask = pad_to(F.col("_ids"), enc.eos, max_len, enc.pad)
    labels, _ = pad_to(F.col("_t_ids"), enc.eos, max_len, enc.pad)
    return d.select(*keep, ids.alias("input_ids"), mask.alias("attention_mask"), labels.alias("labels"))


def decode(df: DataFrame, ids: str, model: BpeModel, out: str = "text", raw_join: bool = False) -> DataFrame:
    """Ids -> text, special tokens skipped, stripped.

    ``raw_join=True`` reproduces a tokenizer without a decoder (tokens joined by
    spaces, byte map not inverted, Q22); the default inverts the byte map.
    """
    from maskcorpus.functions.text import py_strip
    toks = model.tokens()
    vocab = F.split(F.lit(_GAP.join(toks)), _GAP)
    n_special = len(SPECIAL_TOKENS)
    kept = F.filter(F.col(ids), lambda i: (i >= n_special) & (i < len(toks)))
    pieces_ = F.transform(kept, lambda i: F.element_at(vocab, i + 1))
    if raw_join:
        return df.withColumn(out, py_strip(F.array_join(pieces_, " ")))
    table = byte_to_char()
    moved = [b for b in range(256) if table[b] != chr(b)]
    latin1 = F.translate(F.array_join(pieces_, ""), "".join(table[b] for b in moved), "".join(chr(b) for b in moved))
    # ids may end inside a multi-byte character or be any model output: broken bytes become U+FFFD
    text = F.make_valid_utf8(F.encode(latin1, "ISO-8859-1").cast("string"))
    return df.withColumn(out, py_strip(text))


def encode_words(words: DataFrame, model: BpeModel, word: str = "word", out: str = "ids") -> DataFrame:
    """K2: the word -> ids dictionary for distinct byte-level words."""
    bounded_batches(words.sparkSession)
    bc = words.sparkSession.sparkContext.broadcast(Encoder(model))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(col):
        enc: Encoder = bc.value
        return col.map(lambda w: None if w is None else [enc.tok_id[w]] if w in _SPECIALS else enc.word_ids(w))
    return words.withColumn(out, ids(F.col(word)))


#: Most frequent words that every task gets with their ids, some 98 % of a corpus's tokens; all others come by a join.
INLINE_WORDS = 1 << 18


def word_dictionary(df: DataFrame, cols: list[str], model: BpeModel) -> DataFrame:
    """K2: ``word, n, ids`` for every distinct pre-token of the text columns, each segmented once; special tokens included."""
    counted = counted_words(df, cols, _SPECIAL_SPLIT)
    return encode_words(counted.select(_dictionary_word("w").alias("word"), "n").hint("rebalance"), model)


def _dictionary_word(w: str) -> Column:
    """A raw pre-token as the dictionary has it: byte-level, special tokens as they are."""
    return F.when(F.col(w).rlike(_IS_SPECIAL), F.col(w)).otherwise(byte_level(w))


class InlineWords:
    """Words with their ids, as Arrow and numpy arrays, looked up by the distinct words of a batch."""

    def __init__(self, words: list[str], ids: pa.ListArray):
        back = {ch: b for b, ch in enumerate(byte_to_char())}
        self.words = pa.array([w if w in _SPECIALS else bytes(map(back.__getitem__, w)).decode() for w in words], pa.string())
        self.sizes = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)


def _inline_words(dictionary: DataFrame, most: int) -> InlineWords:
    """The ``most`` most frequent words of a dictionary (any of equally frequent ones), chosen by counts of counts, without a sort of all words."""
    counts = sorted(((r["n"], r["words"]) for r in dictionary.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    taken, least, room = 0, None, 0
    for n, words in counts:
        least, room = n, most - taken
        taken += words
        if taken >= most:
            break
    chosen = dictionary.select("n", "word", "ids").where(F.col("n") > F.lit(least))
    if room > 0:
        chosen = chosen.unionAll(dictionary.select("n", "word", "ids").where(F.col("n") == F.lit(least)).limit(room))
    got = chosen.select("word", "ids").toArrow()
    return InlineWords(got["word"].to_pylist(), got["ids"].combine_chunks())


#: Stands among a row's ids for a word that the inline words lack.
MISSING = -1


def _lists(sizes: np.ndarray, values: pa.Array, null: np.ndarray) -> pa.ListArray:
    """One list per size, null where told (sizes are 0 there)."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(null))


def _coded(texts: list[str | None], known: InlineWords, runs: tuple, first: int | None) -> pa.StructArray:
    """Ids of each text with MISSING for each word not known, and these words, in order."""
    parts = list(blocks(texts)) or [[]]
    cut = [split(part, runs, _SPECIAL_SPLIT) for part in parts]
    if first is not None:
        for k, (words, counts) in enumerate(cut):
            rank = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
            cut[k] = words.filter(pa.array(rank < first)), np.minimum(counts, first)
    coded = [words.dictionary_encode() for words, _ in cut]
    # all blocks' words at once, as each look-up hashes the known words
    places = pc.index_in(pa.concat_arrays([c.dictionary for c in coded]), value_set=known.words).fill_null(-1).to_numpy(zero_copy_only=False)
    done = 0
    out = []
    for part, (words, counts), c in zip(parts, cut, coded):
        place = places[done:done + len(c.dictionary)][c.indices.to_numpy()]
        done += len(c.dictionary)
        out.append(_block_coded(part, words, np.cumsum(counts), place, known))
    return pa.concat_arrays(out)


def _block_coded(texts: list[str | None], words: pa.StringArray, ends: np.ndarray, place: np.ndarray, known: InlineWords) -> pa.StructArray:
    """``_coded`` of a block: its words, where each text's words end, and which of the known ones each word is."""
    lost = place < 0
    sizes = np.append(known.sizes, 1)[place]  # the last is that of a missing word
    values = picked(np.append(known.ids, np.int32(MISSING)), np.append(known.starts, len(known.ids))[place], sizes)
    null = np.fromiter((t is None for t in texts), bool, len(texts))

    def per_text(flat: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flat)])[np.concatenate([[0], ends])])
    return pa.StructArray.from_arrays([_lists(per_text(sizes), pa.array(values, pa.int32()), null),
                                       _lists(per_text(lost), words.filter(pa.array(lost)), null)], ["ids", "missing"])


def _filled(ids: pa.ListArray, found: pa.ListArray) -> pa.ListArray:
    """``ids`` with the k-th MISSING of a row replaced by the k-th list of ``found``."""
    flat = ids.flatten().to_numpy()
    sizes = np.ones(len(flat), np.int64)
    starts = np.arange(len(flat))
    gaps = np.flatnonzero(flat == MISSING)
    lists = found.flatten()
    if len(lists) != len(gaps):
        raise ValueError(f"{len(gaps)} words of a batch were looked up and {len(lists)} found")
    sizes[gaps] = lengths = lists.value_lengths().to_numpy()
    starts[gaps] = len(flat) + np.cumsum(lengths) - lengths
    values = picked(np.concatenate([flat, lists.flatten().to_numpy()]).astype(np.int32), starts, sizes)
    held = ids.value_lengths().fill_null(0).to_numpy()
    at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(held)])]
    return _lists(np.diff(at), pa.array(values, pa.int32()), ids.is_null().to_numpy(zero_copy_only=False))


def encode_by_dictionary(df: DataFrame, col: str, model: BpeModel, dictionary: DataFrame, out: str = "ids",
                         first: int | None = None, inline: int = INLINE_WORDS, keep: list[str] | None = None) -> DataFrame:
    """K2: ids of a text column by a join with the dictionary, the same as ``token_ids`` gives; beside the columns ``keep`` (all).

    ``dictionary`` is a written table that holds every word (``word_dictionary``). The
    ``inline`` most frequent words, which are most of the tokens, go to every
    task as one bounded map; only other words leave their row, as (row, place,
    word), and meet the dictionary in a shuffled join, where no key is frequent
    any more. A row's ids come back as one group, put in order by place.
    """
    from maskcorpus.session import written_once
    spark = df.sparkSession
    bounded_batches(spark)
    bc = spark.sparkContext.broadcast(_inline_words(dictionary, inline))
    runs = kind_runs(spark)
    if first is not None and Encoder(model).unk is None:
        first = None

    @F.arrow_udf("ids array<int>, missing array<string>")
    def coded(texts: pa.Array) -> pa.Array:
        return _coded(texts.to_pylist(), bc.value, runs, first)

    @F.arrow_udf("array<int>")
    def filled(ids: pa.Array, found: pa.Array) -> pa.Array:
        return _filled(ids, found)

    # written once: row numbers and words are then the same on both sides of the join
    kept = list(df.columns if keep is None else keep)
    rows = written_once(df.select(*kept, coded(F.col(col)).alias("_coded"))
                        .select(*kept, F.col("_coded.ids").alias("_ids"), F.col("_coded.missing").alias("_missing"))
                        .withColumn("_row", F.monotonically_increasing_id()), "pieces")
    left = rows.select("_row", F.posexplode("_missing").alias("at", "w")).select("_row", "at", _dictionary_word("w").alias("word"))
    # each group is gathered behind its shuffle only: before, hardly two of its words meet in a task
    found = (left.join(dictionary.select("word", F.col("ids").alias("_word_ids")), "word")
             .select("_row", "at", "_word_ids").repartition("_row").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", "_word_ids")))["_word_ids"].alias("_found")))
    joined = rows.drop("_missing").join(found, "_row", "left")
    # the found ids stand in the order of the gaps: the k-th gap takes the k-th of them
    whole = F.when(F.col("_found").isNull(), F.col("_ids")).otherwise(filled("_ids", "_found"))
    return joined.withColumn(out, whole).drop("_row", "_ids", "_found")
