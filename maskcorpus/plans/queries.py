"""The registered query set: one Spark job per operator of SURVEY §2.

Every query reads the driver's tables (or views SQL derives from them) from
``sf_dir`` and returns a DataFrame; ``plans.oracle_sql`` holds the DuckDB twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskcorpus.functions.text import example_id, function_id, line_count, py_split
from maskcorpus.operators import mask, ordering
from maskcorpus.plans.fixtures import table, text_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def functions_with_ifs(spark: SparkSession, sf: str) -> DataFrame:
    """``func_no, code, if_statements`` for functions with at least one if (reference schema order)."""
    ifs = (table(spark, sf, "code_ifs")
           .groupBy("func_no")
           .agg(F.sort_array(F.collect_list(F.struct("line", "depth", "condition"))).alias("s")))
    ifs = ifs.select("func_no", F.transform("s", lambda x: F.struct(
        x["condition"].alias("condition"), x["line"].alias("line"), x["depth"].alias("depth"))).alias("if_statements"))
    return table(spark, sf, "code_functions").join(ifs, "func_no")


def functions_with_ids(spark: SparkSession, sf: str) -> DataFrame:
    """E1 over C5: ``id = sha256(i:code[:100])``, ``i`` = position in collection order."""
    from maskcorpus.operators.extract import assign_ids
    return assign_ids(functions_with_ifs(spark, sf), ["func_no"])


@register("function_ids")
def function_ids(spark, sf):
    indexed, _ = ordering.global_index(table(spark, sf, "code_functions"), ["func_no"], "i")
    return indexed.select("func_no", function_id("i", "code").alias("id"))


@register("example_ids")
def example_ids(spark, sf):
    f = functions_with_ids(spark, sf)
    ex = mask.explode_ifs(f, keep=("id", "func_no"))
    return ex.select("func_no", "line", F.col("id").alias("func_id"), example_id("id", "line").alias("id"))


@register("line_stats")
def line_stats(spark, sf):
    n = table(spark, sf, "code_ifs").groupBy("func_no").agg(F.count(F.lit(1)).cast("int").alias("num_ifs"))
    f = table(spark, sf, "code_functions")
    return f.join(n, "func_no", "left").select(
        "func_no", line_count("code").alias("lines"), F.coalesce("num_ifs", F.lit(0)).alias("num_ifs"))


@register("token_split")
def token_split(spark, sf):
    t = document_tokens(spark, sf)
    return t.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.sha2(F.array_join("tokens", " "), 256).alias("tokens_sha"),
                    F.get("tokens", 0).alias("first_token"),
                    F.get("tokens", F.size("tokens") - 1).alias("last_token"))


@register("min_token_filter")
def min_token_filter(spark, sf):
    from maskcorpus.operators.corrupt import min_tokens
    t = document_tokens(spark, sf)
    return min_tokens(t, "tokens", 10).select("doc_id", F.size("tokens").alias("n_tokens"))


@register("explode_ifs")
def explode_ifs(spark, sf):
    f = functions_with_ifs(spark, sf)
    return mask.explode_ifs(f, keep=("func_no",)).select(
        "func_no", F.col("if_ord").cast("int").alias("if_ord"), "condition", "line", "depth")


@register("mask_conditions")
def mask_conditions(spark, sf):
    f = functions_with_ids(spark, sf)
    return mask.mask_conditions(f, carry=("func_no",))


@register("mask_after_keyword")
def mask_after_keyword(spark, sf):
    d = table(spark, sf, "documents")
    return mask.mask_after_keyword(d, "text", ("and", "the"), ",", key=("doc_id",))


@register("shuffle_index")
def shuffle_index(spark, sf):
    out, _ = ordering.seeded_shuffle(table(spark, sf, "code_functions"), "func_no", 42, "shuffle_idx")
    return out.select("func_no", "shuffle_idx")


@register("split_hash")
def split_hash(spark, sf):
    return ordering.split_hash(table(spark, sf, "code_functions"), "func_no").select("func_no", "split")


def document_tokens(spark, sf):
    return text_table(spark, sf, "documents", ("doc_id", "text")).select("doc_id", py_split("text").alias("tokens"))


@register("sample_positions")
def sample_positions(spark, sf):
    from maskcorpus.operators.corrupt import sample_positions as sp
    t = sp(document_tokens(spark, sf), "tokens", "doc_id", 42, min_n=10)
    return t.select("doc_id", F.size("tokens").alias("n_tokens"), F.size("positions").alias("n_masks"),
                    F.array_join("positions", ",").alias("positions"))


@register("corrupt_tokens")
def corrupt_tokens(spark, sf):
    from maskcorpus.operators.corrupt import corrupt_tokens as ct
    return ct(document_tokens(spark, sf), "tokens", "doc_id", 42, min_n=10).select("doc_id", "input", "target")


@register("split_counts")
def split_counts(spark, sf):
    f = table(spark, sf, "code_functions")
    n = f.count()
    return ordering.split_counts(f, "func_no", [n * 35 // 100, n * 15 // 100], ["pretrain", "finetune"], 42).select("func_no", "split")


@register("split_80_10_10")
def split_80_10_10(spark, sf):
    ex = mask_conditions(spark, sf).select("id")  # only labels are asked for, so only ids are written
    return ordering.split_fractions(ex, "id", (0.8, 0.1), ("train", "val", "test"), 42, once=True)


@register("holdout_95_5")
def holdout_95_5(spark, sf):
    ex = corrupt_tokens(spark, sf).select("doc_id")
    return ordering.holdout(ex, "doc_id", 0.05, 42, once=True)


@register("split_sizes")
def split_sizes(spark, sf):
    from maskcorpus.operators.stats import split_sizes as sizes
    return sizes(split_80_10_10(spark, sf), "split")


@register("masking_success_rate")
def masking_success_rate(spark, sf):
    from maskcorpus.operators.stats import masking_success_rate as rate
    f = functions_with_ifs(spark, sf).withColumn("num_ifs", F.size("if_statements"))
    return rate(f, mask_conditions(spark, sf))


# ---- catalog (A1, B1-B3, C1, C2, I7, K3) ----------------------------------

def _catalog():
    from maskcorpus.operators import catalog
    return catalog


@register("catalog_pages")
def catalog_pages(spark, sf):
    from maskcorpus.sources.catalog import flatten_pages, to_pages
    flat = flatten_pages(to_pages(table(spark, sf, "repo_catalog")))
    return flat.select("page", "item_ord", "owner", "repo", "html_url", "language", "stars", "fork", "archived",
                       "license", "default_branch")


@register("catalog_filter")
def catalog_filter(spark, sf):
    return _catalog().filter_catalog(table(spark, sf, "repo_catalog"))


@register("license_filter")
def license_filter(spark, sf):
    return _catalog().filter_license(catalog_filter(spark, sf))


@register("repo_projection")
def repo_projection(spark, sf):
    return _catalog().project_repos(license_filter(spark, sf))


@register("top_repos")
def top_repos(spark, sf):
    return _catalog().top_repos(repo_projection(spark, sf), k=500)


@register("repo_function_counts")
def repo_function_counts(spark, sf):
    from maskcorpus.operators.stats import functions_per_group
    return functions_per_group(table(spark, sf, "repo_functions"), "repo_key")


@register("take_until_target")
def take_until_target(spark, sf):
    """Until a third of the ranked repositories' functions is reached."""
    ranked, counts = top_repos(spark, sf), repo_function_counts(spark, sf)
    target = ranked.join(counts, "repo_key").agg(F.coalesce(F.sum("n_functions"), F.lit(0))).first()[0] // 3
    kept = _catalog().take_until(ranked, counts, target)
    return kept.select("repo_rank", "repo_key", "n_functions", "functions_before")


@register("functions_until_target")
def functions_until_target(spark, sf):
    return _catalog().keep_groups(table(spark, sf, "repo_functions"), take_until_target(spark, sf))


# ---- scoring (K1, L4, I3) ---------------------------------------------------

@register("score_predictions")
def score_predictions(spark, sf):
    from maskcorpus.operators.evaluate import score_predictions as sp
    ex = mask_conditions(spark, sf)
    return sp(ex, table(spark, sf, "if_predictions"), on=("func_no", "line")).select(
        "id", "target", "prediction", "correct")


@register("exact_match_metrics")
def exact_match_metrics(spark, sf):
    from maskcorpus.operators.evaluate import exact_match
    return exact_match(score_predictions(spark, sf))


# ---- extraction (D1, D2, G2) and evaluation (L5, L6, I4, A9) --------------

@register("extract_functions")
def extract_functions(spark, sf):
    from maskcorpus.operators.extract import extract_functions as ef
    out = ef(table(spark, sf, "code_files"), ("file_no",))
    return out.select("file_no", "fn_ord", "code", "num_ifs", "lines")


@register("extract_ifs")
def extract_ifs(spark, sf):
    from maskcorpus.operators.extract import extract_functions as ef
    out = ef(table(spark, sf, "code_files"), ("file_no",))
    return out.select("file_no", "fn_ord", F.inline("if_statements")).select(
        "file_no", "fn_ord", "line", "depth", "condition")


def benchmark_examples(spark, sf):
    from maskcorpus.operators.extract import extract_ifs as ei
    return mask.mask_first_if(ei(table(spark, sf, "benchmark_code"), ("item_id",)), ("item_id",))


@register("mask_benchmark_first_if")
def mask_benchmark_first_if(spark, sf):
    return benchmark_examples(spark, sf)


def _two_testsets(spark, sf):
    from maskcorpus.operators.evaluate import score_predictions as sp
    gen = score_predictions(spark, sf).select(F.lit("generated_testset").alias("testset"), "correct")
    prov = sp(benchmark_examples(spark, sf), table(spark, sf, "benchmark_predictions"), on=("item_id",))
    return gen.unionByName(prov.select(F.lit("provided_testset").alias("testset"), "correct"))


@register("evaluate_two_testsets")
def evaluate_two_testsets(spark, sf):
    from maskcorpus.operators.evaluate import per_testset
    return per_testset(_two_testsets(spark, sf))


@register("metrics_json")
def metrics_json(spark, sf):
    from maskcorpus.operators.evaluate import assemble_metrics, exact_match, score_predictions as sp
    from maskcorpus.sources.files import metrics_to_json
    gen = exact_match(score_predictions(spark, sf))
    prov = exact_match(sp(benchmark_examples(spark, sf), table(spark, sf, "benchmark_predictions"), on=("item_id",)))
    return metrics_to_json(assemble_metrics(gen, prov))


# ---- vocabulary and encoding (J1-J8) ---------------------------------------

BPE_MERGES = 8


def _words(spark, sf):
    from maskcorpus.operators.bpe import word_frequencies as wf
    return wf(text_table(spark, sf, "documents", ("text",)), "text")


def _model(spark, sf):
    """The model of BPE_MERGES merges (driver-side lists bounded by the merge count)."""
    from maskcorpus.operators.bpe import learn_bpe
    return learn_bpe(_words(spark, sf), vocab_size=2**31 - 1, max_merges=BPE_MERGES)


#: Special tokens, at most 256 byte letters, and 301 merges or more.
VOCAB_SIZE = 660


@register("bpe_vocab_660")
def bpe_vocab_660(spark, sf):
    """J3 up to a vocabulary size: the merges, in order (no SQL twin; a test compares with the tokenizers trainer)."""
    from maskcorpus.operators.bpe import learn_bpe
    return learn_bpe(_words(spark, sf), vocab_size=VOCAB_SIZE).merges_df(spark)


@register("word_frequencies")
def word_frequencies(spark, sf):
    return _words(spark, sf)


@register("pair_counts")
def pair_counts(spark, sf):
    from maskcorpus.operators.bpe import pair_counts as pc
    return pc(_words(spark, sf))


@register("bpe_merges_8")
def bpe_merges_8(spark, sf):
    return _model(spark, sf).merges_df(spark)


@register("vocab_ids")
def vocab_ids(spark, sf):
    return _model(spark, sf).vocab(spark)


@register("encode_words")
def encode_words(spark, sf):
    from maskcorpus.operators.encode import encode_words as ew
    out = ew(_words(spark, sf), _model(spark, sf))
    return out.select("word", F.array_join("ids", ",").alias("ids"))


@register("encode_padded")
def encode_padded(spark, sf):
    from maskcorpus.operators.encode import encode_examples
    model = _model(spark, sf)
    enc = encode_examples(mask_conditions(spark, sf).select("id", "input", "target"), model, 512)
    return enc.select("id", F.array_join("input_ids", ",").alias("input_ids"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attended"),
                      F.array_join("labels", ",").alias("labels"))


#: Size of the vocabulary that whole texts are encoded with (the command line's default is 32,000).
VOCAB_WHOLE = 2000


def _whole_model(spark, sf):
    """The model of VOCAB_WHOLE tokens: learned once per application and table, then read back (M1)."""
    from maskcorpus.operators.bpe import learn_bpe
    from maskcorpus.plans.manifest import listing, stage_key
    from maskcorpus.plans.stages import learned_vocabulary
    from maskcorpus.session import _written_root
    made_from = {"documents": listing(spark, [f"{sf}/documents.parquet"]), "vocab_size": VOCAB_WHOLE}
    root = f"{_written_root(spark)}/vocabulary-{stage_key('vocabulary', made_from)[:16]}"
    return learned_vocabulary(spark, root, lambda: learn_bpe(_words(spark, sf), VOCAB_WHOLE), made_from)


@register("bpe_vocab_2000")
def bpe_vocab_2000(spark, sf):
    """J3 at 2,000 tokens: the merges, in order (no SQL twin; tests compare with the tokenizers trainer and plain merging)."""
    return _whole_model(spark, sf).merges_df(spark)


@register("encode_whole_texts")
def encode_whole_texts(spark, sf):
    """J5 through the word dictionary (K2): all ids of every document, ``</s>`` first (a test compares with the tokenizers library)."""
    from maskcorpus.operators.encode import EOS_TOKEN, encode_by_dictionary, word_dictionary
    from maskcorpus.session import written_once
    model = _whole_model(spark, sf)
    d = text_table(spark, sf, "documents", ("doc_id", "text"))
    words = written_once(word_dictionary(d, ["text"], model), "dictionary")
    out = encode_by_dictionary(d, "text", model, words, keep=["doc_id"])
    ids = F.concat(F.array(F.lit(model.tokens().index(EOS_TOKEN))), "ids")
    return out.select("doc_id", F.size(ids).alias("n_tokens"), F.sha2(F.array_join(ids, ","), 256).alias("ids_sha"))


@register("decode_whole_texts")
def decode_whole_texts(spark, sf):
    """Every document encoded whole and decoded again; decoding strips the text."""
    from maskcorpus.operators.encode import decode, token_ids
    model = _whole_model(spark, sf)
    coded = token_ids(text_table(spark, sf, "documents", ("doc_id", "text")), "text", model, "ids")
    return decode(coded, "ids", model, "back").select("doc_id", F.length("back").alias("n_chars"), F.sha2("back", 256).alias("text_sha"))


# ---- count-based fill model (L2, L3) ---------------------------------------

def _finetune_splits(spark, sf):
    ex = mask_conditions(spark, sf)
    return ordering.split_fractions(ex, "id", (0.8, 0.1), ("train", "val", "test"), 42, once=True)


@register("fill_counts")
def fill_counts(spark, sf):
    from maskcorpus.operators.predict import fit_fill_counts
    model = fit_fill_counts(_finetune_splits(spark, sf).where(F.col("split") == "train"))
    return model["pair"]


@register("predict_fill_counts")
def predict_fill_counts(spark, sf):
    from maskcorpus.operators.evaluate import score
    from maskcorpus.operators.predict import fit_fill_counts, predict_fill_counts as pf
    sp = _finetune_splits(spark, sf)
    model = fit_fill_counts(sp.where(F.col("split") == "train"))
    out = score(pf(sp.where(F.col("split") == "test"), model))
    return out.select("id", "target", "prediction", "level", "correct")


@register("build_datasets")
def build_datasets(spark, sf):
    from maskcorpus.config import Params
    from maskcorpus.plans.stages import build_datasets as bd
    return bd(functions_with_ids(spark, sf), Params())


# ---- files, archives and stages (A1-A8, A11, B4, B9, B10, D4, E13, E14, I1, I6, J7, J8, L1, M1-M3) -------------------
# Each writes what it derives from the given tables to a scratch folder of this application and reads it back.

def _scratch(spark, name: str) -> str:
    import uuid

    from maskcorpus.session import _written_root
    return f"{_written_root(spark)}/{name}-{uuid.uuid4().hex}"


@register("catalog_files")
def catalog_files(spark, sf):
    from maskcorpus.sources.catalog import read_repo_catalog, to_pages
    path = _scratch(spark, "pages")
    to_pages(table(spark, sf, "repo_catalog")).select("items").repartition(3).write.json(path)  # several pages per file
    return read_repo_catalog(spark, path).select("item_ord", "owner", "repo", "html_url", "language", "stars", "fork",
                                                 "archived", "license", "default_branch")


#: Files per archive of the derived archives.
ARCHIVE_FILES = 50


def _archives(spark, sf) -> str:
    """Zip archives of code_files: a text member first, then the sources, each with bytes that are no UTF-8 at its end."""
    path = _scratch(spark, "archives")
    files = table(spark, sf, "code_files").withColumn("archive", F.expr(f"file_no div {ARCHIVE_FILES}"))

    def write(pdf):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs
        system, root = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
        system.create_dir(root, recursive=True)
        no = int(pdf["archive"].iloc[0])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.txt", "no source")
            for file_no, code in sorted(zip(pdf["file_no"], pdf["code"])):
                z.writestr(f"src/f{file_no}.py", code.encode() + b"\xff\xc3")
        with system.open_output_stream(f"{root}/a{no}.zip") as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"archive": [no]})

    files.groupBy("archive").applyInPandas(write, "archive long").count()
    return path


@register("archive_members")
def archive_members(spark, sf):
    from maskcorpus.sources.archives import filter_members, read_archives
    members = filter_members(read_archives(spark, _archives(spark, sf), suffix=""), ".py")
    return members.select("member", "member_ord", "status", F.sha2("code", 256).alias("code_sha"))


@register("archive_source")
def archive_source(spark, sf):
    """The same members through the data source, with the suffix as a pushed filter."""
    from maskcorpus.sources.archive_source import register_archives
    register_archives(spark)
    members = spark.read.format("repo_archives").option("suffix", "").load(_archives(spark, sf)).where(F.col("member").endswith(".py"))
    return members.select("member", "member_ord", "status", F.sha2("code", 256).alias("code_sha"))


def _functions_of_archives(spark, sf, rank) -> DataFrame:
    from maskcorpus.operators.extract import functions_from_archives as ffa
    path = _archives(spark, sf)
    found = spark.read.format("binaryFile").load(path).select("path", F.regexp_extract("path", "a(\\d+)[.]zip$", 1).cast("long").alias("no"))
    return ffa(spark, path, found.select("path", rank.alias("repo_rank"))).select("member", "fn_ord", "num_ifs", "lines", "id")


@register("functions_from_archives")
def functions_from_archives(spark, sf):
    """Of every archive, those with an even number first, and among them the later ones."""
    return _functions_of_archives(spark, sf, F.when(F.col("no") % 2 == 0, -F.col("no")).otherwise(F.col("no") + 1))


@register("functions_from_all_archives")
def functions_from_all_archives(spark, sf):
    """Of every archive, the later ones first."""
    return _functions_of_archives(spark, sf, -F.col("no"))


BROKEN_FILES = "select file_no, case when file_no % 10 = 7 then concat(code, chr(10), 'def (') else code end as code from code_files"


@register("extraction_report")
def extraction_report(spark, sf):
    from maskcorpus.operators.extract import extract_all, extraction_report as report
    table(spark, sf, "code_files").createOrReplaceTempView("code_files")
    return report(extract_all(spark.sql(BROKEN_FILES), ("file_no",)))


@register("length_filter")
def length_filter(spark, sf):
    from maskcorpus.operators.extract import filter_length
    return filter_length(extract_functions(spark, sf), 5, 12).select("file_no", "fn_ord", "lines")


def _functions_table(spark, sf) -> DataFrame:
    return functions_with_ids(spark, sf).select("id", "code", "if_statements", F.size("if_statements").alias("num_ifs"),
                                                line_count("code").alias("lines"))


@register("functions_jsonl")
def functions_jsonl(spark, sf):
    from maskcorpus.sources.files import read_functions, write_functions
    path = _scratch(spark, "functions")
    write_functions(_functions_table(spark, sf), path, fmt="json")
    back = read_functions(spark, path)
    return back.select("id", "num_ifs", "lines", F.sha2("code", 256).alias("code_sha"),
                       F.array_join(F.transform("if_statements", lambda s: F.concat(s["line"].cast("string"), F.lit(":"), s["condition"])), "|").alias("ifs"))


@register("examples_by_split")
def examples_by_split(spark, sf):
    from maskcorpus.sources.files import read_examples, write_examples
    path = _scratch(spark, "examples")
    write_examples(_finetune_splits(spark, sf).select("id", "input", "target", "split"), path, fmt="json")
    out = None
    for name in ("train", "val", "test"):
        part = read_examples(spark, f"{path}/split={name}").select(
            F.lit(name).alias("split"), "id", F.sha2("input", 256).alias("input_sha"), "target")
        out = part if out is None else out.unionAll(part)
    return out


@register("benchmark_csv")
def benchmark_csv(spark, sf):
    from maskcorpus.sources.files import read_benchmark
    path = _scratch(spark, "benchmark")
    rows = table(spark, sf, "benchmark_code").selectExpr("item_id", "case when item_id % 7 <> 3 then code end as code", "'a, \"b\"' as other")
    rows.write.option("header", "true").option("escape", '"').option("quoteAll", "true").csv(path)
    return read_benchmark(spark, path).select(F.sha2("code", 256).alias("code_sha"))


@register("results_csv")
def results_csv(spark, sf):
    from maskcorpus.operators.evaluate import score_predictions as sp
    from maskcorpus.sources.files import read_results, write_results
    path = _scratch(spark, "results")
    write_results(sp(mask_conditions(spark, sf), table(spark, sf, "if_predictions"), on=("func_no", "line")), path)
    return read_results(spark, path).select(F.sha2("input", 256).alias("input_sha"), "target", "prediction", "correct")


@register("vocab_tables")
def vocab_tables(spark, sf):
    from maskcorpus.sources.files import read_vocab, write_vocab
    path = _scratch(spark, "vocab")
    model = _model(spark, sf)
    write_vocab(model.vocab(spark), model.merges_df(spark), path)
    return read_vocab(spark, path).vocab(spark)


@register("nfkc_text")
def nfkc_text(spark, sf):
    """Every "in" of the texts as two full-width letters, which NFKC turns back."""
    from maskcorpus.functions.bytelevel import nfkc
    d = text_table(spark, sf, "documents", ("doc_id", "text"))
    wide = d.select("doc_id", F.replace("text", F.lit("in"), F.lit("\uff49\uff4e")).alias("wide"))
    return wide.select("doc_id", F.length("wide").alias("n_chars"), F.sha2(nfkc("wide"), 256).alias("text_sha"))


@register("count_at_least")
def count_at_least(spark, sf):
    from maskcorpus.operators.stats import count_at_least as at_least
    d = table(spark, sf, "documents")
    return spark.createDataFrame([(n, at_least(d, n)) for n in (1, 150, 900, 10**9)], "n long, enough boolean")


def _two_stages(spark, sf) -> dict[str, str]:
    from maskcorpus.plans.stages import materialize
    paths = {name: _scratch(spark, name) for name in ("functions", "words", "missing")}
    for _ in range(2):  # the second round reads back
        materialize(spark, "functions", lambda: table(spark, sf, "code_functions"), paths["functions"], min_rows=10)
        materialize(spark, "words", lambda: table(spark, sf, "documents").select("doc_id", F.size(py_split("text")).alias("n_tokens")), paths["words"])
    return paths


@register("materialized_stage")
def materialized_stage(spark, sf):
    return spark.read.parquet(_two_stages(spark, sf)["words"])


@register("rebuilt_stage")
def rebuilt_stage(spark, sf):
    """M1: a stage that was written from another table, then with another seed, is rebuilt; an unchanged one is read back."""
    from maskcorpus.plans.manifest import listing
    from maskcorpus.plans.stages import materialize
    path, out = _scratch(spark, "splits"), None

    def unused():
        raise RuntimeError("an unchanged stage is not built again")

    for name, seed, build in (("benchmark", 42, None), ("documents", 7, None), ("documents", 42, None), ("documents", 42, unused)):
        key = "doc_id" if name == "documents" else "item_id"
        rows = table(spark, sf, name).select(F.col(key).alias("doc_id"))
        out = materialize(spark, "splits", build or (lambda r=rows, s=seed: ordering.split_hash(r, "doc_id", seed=s)), path,
                          depends={"input": listing(spark, [f"{sf}/{name}.parquet"]), "seed": seed})
    return out


@register("progress_report")
def progress_report(spark, sf):
    from maskcorpus.plans.stages import progress_report as report
    return report(spark, _two_stages(spark, sf)).drop("path")


@register("score_repeated_predictions")
def score_repeated_predictions(spark, sf):
    from maskcorpus.operators.evaluate import score_predictions as sp
    out = sp(mask_conditions(spark, sf), table(spark, sf, "repeated_predictions"), on=("func_no", "line"))
    return out.select("id", "target", "prediction", "correct")


@register("predict_batch")
def predict_batch(spark, sf):
    """A model that answers with the number of lines of its input."""
    from maskcorpus.operators.predict import predict_batch as pb
    test = _finetune_splits(spark, sf).where(F.col("split") == "test")
    return pb(test, lambda: lambda texts: [f" {len(t.splitlines())} " for t in texts])


@register("decode_truncated")
def decode_truncated(spark, sf):
    """Documents cut after 39 ids, also inside a character, are a prefix of the text once broken bytes are gone."""
    from maskcorpus.functions.text import py_strip
    from maskcorpus.operators.encode import decode, encode
    model = _model(spark, sf)
    d = decode(encode(text_table(spark, sf, "documents", ("doc_id", "text")), "text", model, 40), "input_ids", model, "back")
    whole = py_strip(F.regexp_replace("back", "\ufffd+$", ""))
    return d.select("doc_id", F.startswith(py_strip("text"), whole).alias("is_prefix"), (F.length(whole) > 0).alias("has_text"))


@register("encode_datasets")
def encode_datasets(spark, sf):
    from maskcorpus.config import Params
    from maskcorpus.plans.stages import encode_datasets as ed
    from maskcorpus.session import written_once
    # written: corruption then runs once, and not beside the encoder's Python workers
    out = ed(written_once(build_datasets(spark, sf), "datasets"), _model(spark, sf), Params())
    return out.select("kind", "split", "id", F.sha2(F.array_join("input_ids", ","), 256).alias("input_sha"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attended"),
                      F.sha2(F.array_join("labels", ","), 256).alias("labels_sha"))


@register("encode_datasets_2000")
def encode_datasets_2000(spark, sf):
    """J8 with a vocabulary of VOCAB_WHOLE tokens (a test compares with the tokenizers library)."""
    from maskcorpus.config import Params
    from maskcorpus.plans.stages import encode_datasets as ed
    from maskcorpus.session import written_once
    out = ed(written_once(build_datasets(spark, sf), "datasets"), _whole_model(spark, sf), Params())
    return out.select("kind", "split", "id", F.sha2(F.array_join("input_ids", ","), 256).alias("input_sha"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attended"),
                      F.sha2(F.array_join("labels", ","), 256).alias("labels_sha"))


def _even_lengths(examples: DataFrame) -> DataFrame:
    """Predictions that are right where the target's length is even."""
    return examples.selectExpr("id", "case when length(target) % 2 = 0 then upper(target) else 'None' end as prediction")


@register("pipeline_metrics")
def pipeline_metrics(spark, sf):
    from maskcorpus.config import Params
    from maskcorpus.plans.stages import run_pipeline
    from maskcorpus.sources.files import metrics_to_json
    out = run_pipeline(spark, lambda: _functions_table(spark, sf), _scratch(spark, "run"), Params(vocab_size=VOCAB_SIZE),
                       predictions=_even_lengths, benchmark=lambda: table(spark, sf, "benchmark_code").select("code"))
    return metrics_to_json(out["all_metrics"])


@register("incremental_examples")
def incremental_examples(spark, sf):
    """Two landings of functions, then a third that repeats the first under another name, each followed by a run of the stream."""
    from maskcorpus.streaming.incremental import incremental_examples as stream
    src, out, state = (_scratch(spark, x) for x in ("landing", "examples", "state"))
    f = _functions_table(spark, sf).withColumn("half", F.substring("id", 1, 1) < "8")
    for k, half in enumerate((F.col("half"), ~F.col("half"), F.col("half"))):
        f.where(half).drop("half").write.parquet(f"{src}/b{k}")
        stream(spark, f"{src}/*", out, state).awaitTermination()
    return spark.read.parquet(out).select("kind", "split", "func_id", "id", F.sha2("input", 256).alias("input_sha"), "target")
