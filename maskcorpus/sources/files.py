"""Stage files: functions, examples, benchmark CSV, result CSV, metrics JSON
(SURVEY A3-A9). Parquet is the default storage; JSONL/CSV match the
reference's file formats where a user needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskcorpus.operators.extract import IF_STRUCT

FUNCTION = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("code", T.StringType()),
    T.StructField("if_statements", T.ArrayType(IF_STRUCT)), T.StructField("num_ifs", T.IntegerType()),
    T.StructField("lines", T.IntegerType()),
])
EXAMPLE = T.StructType([T.StructField("id", T.StringType()), T.StructField("input", T.StringType()),
                        T.StructField("target", T.StringType())])
BENCHMARK = T.StructType([T.StructField("code", T.StringType())])
RESULT = T.StructType([T.StructField("input", T.StringType()), T.StructField("target", T.StringType()),
                       T.StructField("prediction", T.StringType()), T.StructField("correct", T.BooleanType())])


def read_functions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A3: functions table (JSONL as the reference writes it, or Parquet)."""
    r = spark.read.schema(FUNCTION)
    return r.json(path) if fmt == "json" else r.parquet(path)


def write_functions(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A4: write functions; JSONL keeps the reference's field names."""
    w = df.select(*[f.name for f in FUNCTION.fields]).write.mode(mode)
    w.json(path) if fmt == "json" else w.parquet(path)


def read_examples(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A5: examples (``id`` is null for pre-train rows, as in the reference)."""
    r = spark.read.schema(EXAMPLE)
    return r.json(path) if fmt == "json" else r.parquet(path)


def write_examples(df: DataFrame, path: str, split: str | tuple[str, ...] = "split", fmt: str = "parquet",
                   mode: str = "overwrite") -> None:
    """All example sets in one write, one folder per split label."""
    w = df.write.mode(mode).partitionBy(*([split] if isinstance(split, str) else split))
    w.json(path) if fmt == "json" else w.parquet(path)


def read_benchmark(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark CSV with multi-line quoted ``code``; rows without code are dropped.

    Other columns are ignored; the header names the columns.
    """
    df = (spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
          .option("mode", "PERMISSIVE").csv(path))
    return df.select("code").where(F.col("code").isNotNull())


def write_results(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``input,target,prediction,correct`` CSV with header; quotes and newlines round-trip.

    ``correct`` is written ``True``/``False`` as the reference's pandas writer prints it.
    """
    out = df.select("input", "target", "prediction",
                    F.when(F.col("correct"), "True").when(~F.col("correct"), "False").alias("correct"))
    (out.write.mode(mode).option("header", "true").option("escape", '"').option("quoteAll", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The result CSV read back with its texts unchanged."""
    df = (spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
          .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return df.withColumn("correct", F.col("correct") == "True")


def metrics_to_json(metrics: DataFrame) -> DataFrame:
    """One ``metrics_json`` string with an explicit ``null`` for a missing testset."""
    body = F.to_json(F.struct("generated_testset", "provided_testset"), {"ignoreNullFields": "false"})
    return metrics.select(body.alias("metrics_json"))


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metrics as a single JSON text file."""
    metrics_to_json(metrics).coalesce(1).write.mode(mode).text(path)



def write_vocab(vocab: DataFrame, merges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The learned vocabulary as two Parquet tables (``vocab``, ``merges``)."""
    vocab.write.mode(mode).parquet(f"{path.rstrip('/')}/vocab")
    merges.write.mode(mode).parquet(f"{path.rstrip('/')}/merges")


def read_vocab(spark: SparkSession, path: str):
    """Read back ``(vocab, merges)`` and rebuild a model (sizes bounded by ``vocab_size``)."""
    from maskcorpus.config import SPECIAL_TOKENS
    from maskcorpus.operators.bpe import BpeModel
    vocab = spark.read.parquet(f"{path.rstrip('/')}/vocab")
    merges = spark.read.parquet(f"{path.rstrip('/')}/merges")
    toks = [r["token"] for r in vocab.orderBy("id").collect()]
    ms = [(r["left"], r["right"], r["pair_count"]) for r in merges.orderBy("rank").collect()]
    n_sp = len(SPECIAL_TOKENS)
    alpha = [t for t in toks[n_sp:] if len(t) == 1]  # merged tokens always have two or more characters
    return BpeModel(toks[:n_sp], alpha, ms)
