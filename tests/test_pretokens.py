"""Whole texts at size: array-wise pre-tokens equal the regex, and what is kept, counted and written stays small."""

import pickle
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskcorpus.functions import pretokens
from maskcorpus.functions.bytelevel import pretokenize
from maskcorpus.operators import bpe, encode, pair_state

BITS = ["'s", "'t", "'re", "'ve", "'ll", "'m", "'d", "'", " ", "  ", "\n", "\t", "\xa0", " ", "\x85", "\x1c", "a", "b", "é", "s", "t", "re", "Ω",
        "1", "٣", "½", "ª", "!", "<", ">", "<pad>", "</s>", "<extra_id_7>", "<extra_id_100>", "＜pad＞", "ﬁ", "Å", "é", "中", "😀", "\x00", "_", "-", "​"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + [None, "", "<pad>", "＜pad＞", "'s", " 's", "\n's's"]


@pytest.fixture(scope="module")
def df(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3).cache()


@pytest.mark.parametrize("specials", [encode._SPECIAL_SPLIT, None])
def test_split_equals_the_regex(spark, texts, df, specials):
    native = encode.raw_pieces(encode.normalised_segments("text")) if specials else pretokenize("text")
    want = {r[0]: r[1] for r in df.select("i", native).collect()}
    words, counts = pretokens.split(texts, pretokens.kind_runs(spark), specials, normalise=specials is not None)
    ends = np.cumsum(counts)
    words = words.to_pylist()
    assert ends[-1] == len(words)
    assert {i: words[e - n:e] for i, (e, n) in enumerate(zip(ends, counts))} == {i: w or [] for i, w in want.items()}


def test_kinds_are_those_of_the_regex_classes(spark):
    kinds = pretokens._kinds(pretokens.kind_runs(spark))
    assert [kinds[ord(c)] for c in "a1 !\x00\x85\x1cé中²"] == [1, 2, 0, 3, 3, 0, 3, 1, 1, 2] and len(kinds) == 0x110000


def test_counts_are_joined_before_they_leave_a_task(spark, texts, df, monkeypatch):
    """Every occurrence was a row of its own."""
    want = Counter(w for r in df.select(encode.raw_pieces(encode.normalised_segments("text"))).collect() for w in r[0] or [])
    runs = pretokens.kind_runs(spark)
    batches = [df.select("text").toArrow().combine_chunks().to_batches()[0].slice(k, 500) for k in range(0, len(texts), 500)]
    handed = [r for b in pretokens.counting(runs, encode._SPECIAL_SPLIT)(batches) for r in b.to_pylist()]
    assert len(handed) == len(want) and {r["w"]: r["more"] + 1 for r in handed} == want
    # with less held, more rows of the same sum
    monkeypatch.setattr(pretokens, "HELD_BYTES", 1000)
    monkeypatch.setattr(pretokens, "BLOCK_CHARS", 2000)
    more = [r for b in pretokens.counting(runs, encode._SPECIAL_SPLIT)(batches) for r in b.to_pylist()]
    total = Counter()
    for r in more:
        total[r["w"]] += r["more"] + 1
    assert len(more) > len(want) and total == want
    assert {r.w: r.n for r in bpe.counted_words(df, ["text"], encode._SPECIAL_SPLIT).collect()} == want


def test_texts_and_words_are_not_written(spark, texts, df, monkeypatch):
    """All pre-tokens of all texts were written twice, as words and as ids, beside the texts."""
    from maskcorpus import session
    model = bpe.BpeModel(["<pad>", "<unk>", "</s>", *(f"<extra_id_{i}>" for i in range(100))], [chr(c) for c in range(33, 127)] + ["Ġ"], [])
    words = session.written_once(encode.word_dictionary(df, ["text"], model), "dictionary")
    written = []
    keep = session.written_once
    monkeypatch.setattr(session, "written_once", lambda d, name: written.append(keep(d, name)) or written[-1])
    for inline in (5, 1 << 18):
        got = encode.encode_by_dictionary(df, "text", model, words, inline=inline, keep=["i"])
        assert got.columns == ["i", "ids"] and "text" not in written[-1].columns
        assert {r.i: r.ids for r in got.collect()} == {r.i: r.ids for r in encode.token_ids(df, "text", model).collect()}
    assert written[-1].where(F.size("_missing") > 0).count() == 0  # words that every task knows leave none
    first = {r.i: r.ids for r in encode.encode_by_dictionary(df, "text", model, words, inline=5, first=3).collect()}
    assert first == {r.i: r.ids for r in encode.token_ids(df, "text", model, first=3).collect()}


def test_a_shard_of_words_is_small():
    """It crosses into Python and back in every round; with an index pair -> words it took three times as much."""
    rng = np.random.default_rng(1)
    listed = rng.integers(0, 200, (50_000, 9)).tolist()
    words = pair_state.Words(listed, [1] * len(listed))
    assert len(pickle.dumps(words, 5)) < 70 * len(listed)
    for k in range(40):
        words.apply([(2 * k, b, 1000 + k * 200 + b) for b in range(200)])
    assert len(words.sym) <= 2 * (int(words.size.sum()) + len(listed))


def test_sums_of_a_small_range_equal_the_sorted_ones(monkeypatch):
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 50, 5000) * pair_state.KEY + rng.integers(0, 60, 5000)
    values = rng.integers(-3, 4, 5000)
    dense = pair_state.summed(keys, values)
    large = pair_state.summed(np.append(keys, 7), np.append(values, 1 << 60))
    monkeypatch.setattr(pair_state, "CELLS", 0)
    by_sort = pair_state.summed(keys, values)
    assert all((a == b).all() and a.dtype == b.dtype == np.int64 for a, b in zip(dense, by_sort))
    assert large[1][large[0] == 7].tolist() == [(1 << 60) + int(values[keys == 7].sum())]
