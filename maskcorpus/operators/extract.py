"""Function and ``if`` extraction as a Spark job.

Files are spread over tasks first (round-robin, so one huge repository does not
land in one task), then each task parses its files with the stdlib parser in an
Arrow-batched ``mapInPandas``. Nothing is collected; a file that does not parse
gives one ``syntax_error`` row that callers count and drop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskcorpus.session import bounded_batches

IF_STRUCT = T.StructType([T.StructField("condition", T.StringType()), T.StructField("line", T.IntegerType()),
                          T.StructField("depth", T.IntegerType())])


def _key_fields(df: DataFrame, key: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in key]


def _to_structs(conds: str, lines: str, depths: str):
    z = F.arrays_zip(F.col(conds).alias("c"), F.col(lines).alias("l"), F.col(depths).alias("d"))
    return F.transform(z, lambda x: F.struct(x["c"].alias("condition"), x["l"].alias("line"),
                                             x["d"].alias("depth")))


def spread(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Deal files evenly over tasks, so a hot repository is split: by bytes, or over ``num_partitions``."""
    from maskcorpus.session import spread_rows
    return df.repartition(num_partitions) if num_partitions else spread_rows(df)


def extract_all(files: DataFrame, key: Sequence[str] = ("file_no",), code: str = "code",
                num_partitions: int | None = None, spread_files: bool = True) -> DataFrame:
    """D1 + D2: every function of every file, with status rows for files that fail to parse.

    Output: ``key..., fn_ord, code, if_statements, num_ifs, lines, status``.
    ``spread_files=False`` when the input is already spread (e.g. the split archive reader).
    """
    key = list(key)
    schema = T.StructType(_key_fields(files, key) + [
        T.StructField("fn_ord", T.IntegerType()), T.StructField("code", T.StringType()),
        T.StructField("conds", T.ArrayType(T.StringType())), T.StructField("if_lines", T.ArrayType(T.IntegerType())),
        T.StructField("depths", T.ArrayType(T.IntegerType())), T.StructField("status", T.StringType())])

    def kernel(batches):
        import pandas as pd

        from maskcorpus.functions.pysyntax import extract_functions
        cols = [f.name for f in schema.fields]
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                d = rec._asdict()
                text = d[code]
                ks = [d[k] for k in key]
                if text is None:
                    rows.append(ks + [-1, None, [], [], [], "null_code"])
                    continue
                status, funcs = extract_functions(text)
                if status != "ok":
                    rows.append(ks + [-1, None, [], [], [], status])
                for i, f in enumerate(funcs):
                    rows.append(ks + [i, f["code"], f["conditions"], f["if_lines"], f["depths"], "ok"])
            yield pd.DataFrame(rows, columns=cols)

    bounded_batches(files.sparkSession)
    src = files.select(*key, code)
    src = spread(src, num_partitions) if spread_files else src
    out = src.mapInPandas(kernel, schema)
    return out.select(*key, "fn_ord", "code", _to_structs("conds", "if_lines", "depths").alias("if_statements"),
                      F.size("conds").alias("num_ifs"),
                      F.size(F.split(F.coalesce("code", F.lit("")), "\n", -1)).alias("lines"), "status")


def extract_functions(files: DataFrame, key: Sequence[str] = ("file_no",), code: str = "code",
                      num_partitions: int | None = None, spread_files: bool = True) -> DataFrame:
    """Functions that parsed and hold at least one ``if`` (the reference keeps only those)."""
    out = extract_all(files, key, code, num_partitions, spread_files)
    return out.where((F.col("status") == "ok") & (F.col("num_ifs") > 0)).drop("status")


#: What a row of an extraction can be.
STATUSES = ("ok", "syntax_error", "null_code", "bad_member", "bad_archive")


def extraction_report(extracted: DataFrame) -> DataFrame:
    """Visible counts of what was kept and what was dropped, per status."""
    return extracted.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def extract_ifs(texts: DataFrame, key: Sequence[str] = ("item_id",), code: str = "code",
                num_partitions: int | None = None) -> DataFrame:
    """D2 on whole texts: ``key..., code, if_statements, status`` (pre-order, module root depth 0)."""
    key = list(key)
    schema = T.StructType(_key_fields(texts, key) + [
        T.StructField("code", T.StringType()),
        T.StructField("conds", T.ArrayType(T.StringType())), T.StructField("if_lines", T.ArrayType(T.IntegerType())),
        T.StructField("depths", T.ArrayType(T.IntegerType())), T.StructField("status", T.StringType())])

    def kernel(batches):
        import pandas as pd

        from maskcorpus.functions.pysyntax import extract_ifs as ex
        cols = [f.name for f in schema.fields]
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                d = rec._asdict()
                text = d[code]
                status, ifs = ex(text) if text is not None else ("null_code", [])
                rows.append([d[k] for k in key] + [text, [c for c, _, _ in ifs], [ln for _, ln, _ in ifs],
                                                   [dp for _, _, dp in ifs], status])
            yield pd.DataFrame(rows, columns=cols)

    bounded_batches(texts.sparkSession)
    src = spread(texts.select(*key, code), num_partitions)
    out = src.mapInPandas(kernel, schema)
    return out.select(*key, "code", _to_structs("conds", "if_lines", "depths").alias("if_statements"), "status")


def filter_length(functions: DataFrame, lo: int = 5, hi: int = 500, lines: str = "lines") -> DataFrame:
    """Keep functions of ``lo``..``hi`` lines (a documented quality filter; off by default in the pipeline)."""
    return functions.where(F.col(lines).between(lo, hi))


def assign_ids(functions: DataFrame, order: Sequence[str], code: str = "code") -> DataFrame:
    """E1 over C5: ``id = sha256(f"{i}:{code[:100]}")`` with ``i`` the 0-based position in ``order``
    (the collection order; equal code at two positions gets two ids, Q9)."""
    from maskcorpus.functions.text import function_id
    from maskcorpus.operators.ordering import global_index
    idx, _ = global_index(functions, list(order), "_i")
    return idx.withColumn("id", function_id("_i", code)).drop("_i")


def extracted_from_archives(spark, path: str, repos: DataFrame | None = None, glob: str = "*.zip") -> DataFrame:
    """D4, first half: every function of the archives, and a status row for each archive, member or file that gave none.

    ``repos`` (optional) maps archive ``path`` to ``repo_rank``; archives that it does not name are not opened.
    """
    from maskcorpus.sources.archives import read_archives
    ranks = ["repo_rank"] if repos is not None else []
    members = read_archives(spark, path, glob, only=repos, carry=ranks)  # already spread by member
    texts = members.where(F.col("status") == "ok").select("path", "member", "member_ord", "code", *[F.col(c).cast("string").alias(c) for c in ranks])
    found = extract_all(texts, ("path", "member", "member_ord", *ranks), spread_files=False)
    none = members.where(F.col("status") != "ok").select(
        "path", "member", "member_ord", F.lit(-1).alias("fn_ord"), "code",
        F.lit(None).cast(found.schema["if_statements"].dataType).alias("if_statements"), F.lit(0).alias("num_ifs"),
        F.lit(1).alias("lines"), "status", *ranks)
    own = [c for c in none.columns if c not in ranks]
    return found.select(*own, *[F.col(c).cast(members.schema[c].dataType).alias(c) for c in ranks]).unionByName(none)


def functions_of(extracted: DataFrame) -> DataFrame:
    """D4, second half: the functions with an ``if``, with ids in collection order (repository rank or path, member, function)."""
    funcs = extracted.where((F.col("status") == "ok") & (F.col("num_ifs") > 0)).drop("status")
    first = "repo_rank" if "repo_rank" in funcs.columns else "path"
    return assign_ids(funcs, [first, "member_ord", "fn_ord"])


def functions_from_archives(spark, path: str, repos: DataFrame | None = None, glob: str = "*.zip") -> DataFrame:
    """Archives -> members -> functions with ids, in collection order.

    Output follows the functions table: ``id, code, if_statements, num_ifs, lines`` (+ order keys).
    The members are read and parsed once: the extraction is written before ids are given.
    """
    from maskcorpus.session import written_once
    return functions_of(written_once(extracted_from_archives(spark, path, repos, glob), "extracted"))
