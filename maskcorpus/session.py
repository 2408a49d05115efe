"""SparkSession helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "maskcorpus", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with AQE on and the UI off.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (AQE coalesces).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # checkpoint files go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Arrow batches of long texts: keep each batch a bounded size.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("MASKCORPUS_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only a local-mode session with the
    setting unset (tests, benchmarks) gets a private folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="maskcorpus-ckpt-", dir=os.environ.get("MASKCORPUS_SCRATCH"))
    sc.setCheckpointDir(path)
    return path


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession, zip_dir: str | None = None) -> None:
    """Make ``maskcorpus`` importable in executor Python workers (once per context).

    Zips the package's sources and registers the zip with ``addPyFile``, which
    distributes it to every executor. The zip goes to ``zip_dir`` (or the
    ``MASKCORPUS_PKG_DIR`` setting) when given; a private temporary folder is
    used only in local mode. On a cluster with neither, the package is expected
    on the executors already (``spark-submit --py-files maskcorpus.zip``).
    """
    import zipfile

    import maskcorpus
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    zip_dir = zip_dir or os.environ.get("MASKCORPUS_PKG_DIR")
    if zip_dir is None:
        if not sc.master.startswith("local"):
            _SHIPPED.add(key)
            return
        zip_dir = tempfile.mkdtemp(prefix="maskcorpus-pkg-")
    pkg = os.path.dirname(os.path.abspath(maskcorpus.__file__))
    root = os.path.dirname(pkg)
    os.makedirs(zip_dir, exist_ok=True)
    out = os.path.join(zip_dir, "maskcorpus.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def spread_rows(df):
    """Deal rows evenly over tasks for CPU-heavy per-row work (tokenising, sampling, parsing).

    A Parquet row group is never split, so a few large row groups would leave
    most cores idle. The hint gives one plan at every size: a rebalancing
    exchange whose partition sizes adaptive execution sets from the bytes.
    """
    return df.hint("rebalance")


#: Bytes of one Arrow batch of texts or tokens: a Python worker holds several times as much, as objects.
ARROW_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let this session's Arrow batches hold ARROW_BYTES at most, so that a worker's memory depends neither on the rows of a task nor on their length."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key).rstrip("b")
    if not held.isdigit() or int(held) > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def written_once(df, name: str):
    """Write ``df`` below the shared checkpoint folder and read it back: two passes then see the same rows.

    For narrow tables (keys, counts). The folder is the application's scratch;
    ``clear_written`` deletes it.
    """
    import uuid
    spark = df.sparkSession
    path = f"{_written_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _written_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/written-{spark.sparkContext.applicationId}"


def clear_written(spark: SparkSession) -> None:
    """Delete every table that ``written_once`` wrote in this application (call when results are stored)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_written_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
