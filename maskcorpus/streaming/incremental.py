"""M3: new function files -> new examples only (the re-aim of resumability).

A file-source stream over a folder of function tables; each trigger masks the
new functions (G1), corrupts them (F2), both stateless per row, and gives them a sort-free split (H4),
so earlier output is never recomputed. The checkpoint location keeps which
files were processed, so a restarted run resumes where it stopped, and keyed
state: the ids of all functions seen, so that a function that is landed again,
in another file or an overlapping one, gives no second example. Exact-count
splits (H1/H2) need totals and stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from maskcorpus.config import Params
from maskcorpus.operators.corrupt import pretrain_examples
from maskcorpus.operators.mask import mask_conditions
from maskcorpus.operators.ordering import split_hash
from maskcorpus.sources.files import FUNCTION

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def incremental_examples(spark: SparkSession, in_path: str, out_path: str, checkpoint: str,
                         p: Params = Params(), fmt: str = "parquet", available_now: bool = True, once_each: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops.

    ``once_each``: only the first landing of a function id counts (null ids are
    one id). The state is one id per function, kept in the checkpoint location
    by ``STATE_STORE`` on the executors' disks, not in their heaps. A
    checkpoint begun with one value must go on with it.
    """
    src = spark.readStream.schema(FUNCTION).format(fmt).option("maxFilesPerTrigger", 1000).load(in_path)
    if once_each:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        src = src.dropDuplicates(["id"])
    ex = examples_of(src, p)
    w = (ex.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
         .partitionBy("kind", "split").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def examples_of(functions: DataFrame, p: Params = Params()) -> DataFrame:
    """Stateless per-row part of the stage: ``kind, split, func_id, id, input, target``.

    Every function gives a corrupted pre-train example (F2) and an example per maskable condition (G1); the hash
    split by function id keeps all examples of a function in one split.
    """
    fine = mask_conditions(functions.where(F.size("if_statements") > 0), p.keywords, p.terminator, p.mask_token)
    fine = fine.select(F.lit("finetune").alias("kind"), "func_id", "id", "input", "target")
    pre = pretrain_examples(functions, "code", "id", p.seed, p.mask_rate_percent, p.min_tokens)
    pre = pre.select(F.lit("pretrain").alias("kind"), F.col("id").alias("func_id"), "id", "input", "target")
    return split_hash(pre.unionByName(fine), "func_id", (p.train_fraction, p.val_fraction), seed=p.seed)
