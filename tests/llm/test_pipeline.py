import hashlib

import public_tokenizers
import sentencepiece

import corpus_pipeline

from .test_mixing import slow_mix
from .test_quality import slow_kept
from .test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.01"


def test_run_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kept = slow_kept([(r.lang, r.source, r.text) for r in rows])[2]
    rows = [r for r, k in zip(rows, kept) if k]
    group = slow_components([r.doc_id for r in rows], [slow_fingerprint(r.text) for r in rows], 2)
    rows = [r for r, g in zip(rows, group) if r.doc_id == g]
    copies = slow_mix([(r.doc_id, r.source, len(r.text.split())) for r in rows])[2]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r, c in zip(rows, copies):
        ids = model.encode(r.text)
        want += [(r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))] * c
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and 300 < len(got)


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 3 + " ".join(f"t{j * i % 97}" for j in range(60)), "en", "s", 5, None)
                                  for i in range(30)] + [(None, None, None, None, None, "e")],
                                 "doc_id long, text string, lang string, source string, n_chars long, size string")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert docs.columns == columns, name
        docs = stage(spark, docs, SF)
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and docs.count()


def test_stages_take_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []
