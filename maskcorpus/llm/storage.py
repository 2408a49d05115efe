"""Written intermediate tables: cut lineage and read an expensive result more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from maskcorpus.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for this application below ``spark.checkpoint.dir``.

    The folder is shared by the driver and all executors; a session that has
    the setting keeps it, a local test session gets a private one.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` the plan runs once, later readers prune columns,
    and a lost executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every table this application has staged (call once its results are written)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/llm-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
