import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from maskcorpus.llm import pieces as P

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "   ", "a", " a", "a ", "  a  b   ", "a\nb c\t d", "▁", "x▁y", "▁ ▁a", "é ß 漢字 🙂 é",
       "\x00 \x01", "<s> </s> <unk> <0x0A>", "　 \xa0 ​", "a" * 70000, "word " * 30000, " \n ", "\n", "▁▁▁", "1234 56.78", "\r\n"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_table_equals_library(library):
    rng = random.Random(2)
    alphabet = "ab cdé  \n\t.,1▁漢🙂́\xa0<>/s" + "etaoin " * 3
    texts = [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    table = P.WordTable(MODEL)
    offsets, ids = table.encode(texts)
    want = library.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
    assert table.decode(offsets, ids) == library.decode(want)


def test_rows_through_spark(spark, library, monkeypatch):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(0, "a b", "y"), (0, "a b", "y"), (None, "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((tuple(r) for r in P.digests(df, MODEL).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for d, t, _ in rows:
        ids = library.encode(t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want, key=str)
    out = P.encode(df.limit(3), MODEL)
    assert out.columns == ["doc_id", "ids", "decoded"]
    assert P.digests(df.limit(0), MODEL).collect() == []


def test_bounded_table_and_slices(library, monkeypatch):
    monkeypatch.setattr(P, "TABLE_WORDS", 5)
    monkeypatch.setattr(P, "CHUNK_BYTES", 10)
    table = P.WordTable(MODEL)
    texts = ["one two three", "four five six seven", "", "one eight", "x" * 50]
    assert list(P._slices([len(t) for t in texts])) == [(0, 1), (1, 2), (2, 4), (4, 5)]
    for t in texts * 2:
        offsets, ids = table.encode([t])
        assert ids.tolist() == library.encode(t)
