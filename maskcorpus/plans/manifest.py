"""Stage manifests: what a written stage was made from.

A manifest is a small JSON file beside ``_SUCCESS``, written last. Its key is a
digest of the stage's name, its parameters and its inputs; an input is a
listing of files (path, length, modification time) or the key of an earlier
stage. So a change of a parameter or of a landed file changes the keys of this
and of all later stages, and none of them is read back.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest.json"
#: Raise when the meaning of stage tables changes: older ones are then rebuilt.
LAYOUT = 1


def stage_key(name: str, depends: dict) -> str:
    """Digest of a stage's name, parameters and input keys; ``depends`` holds plain values."""
    return hashlib.sha256(json.dumps([LAYOUT, name, depends], sort_keys=True, default=str).encode()).hexdigest()


def listing(spark: SparkSession, paths: Sequence[str]) -> dict:
    """``{files, bytes, digest}`` of all files below ``paths``; no content is read.

    Each file's hash (path, length, modification time) goes into a sum, so the
    listing is one distributed aggregate and independent of order.
    """
    if not paths:
        return {"files": 0, "bytes": 0, "digest": "0"}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    r = files.select("path", "length", "modificationTime").agg(
        F.count("*").alias("n"), F.sum("length").alias("bytes"),
        F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("digest")).first()
    return {"files": r["n"], "bytes": r["bytes"] or 0, "digest": str(r["digest"] or 0)}


def source_of(df: DataFrame, without: str | None = None) -> dict:
    """What a DataFrame is: its columns, the operators of its plan with their filters, and the listing of the files it reads.

    Files below the scratch folder ``without`` do not count, nor do computed
    columns (they may hold numbers that a job of this session found) and rows
    that were handed over from Python.
    """
    files = [f for f in df.inputFiles() if without is None or without not in f]
    plan = []
    for line in df._jdf.queryExecution().analyzed().toString().splitlines():
        text = re.sub(r"#\d+L?", "", line.lstrip(" :+-"))
        plan.append(text if text.startswith("Filter ") else text.split(" ")[0].split("[")[0])
    return {"columns": df.dtypes, "plan": plan, "listing": listing(df.sparkSession, sorted(files))}


def code_of(fn) -> str:
    """Name and compiled code of a user's function; None has none."""
    if fn is None:
        return ""
    code = getattr(fn, "__code__", None)
    body = repr((code.co_code, code.co_names, [c for c in code.co_consts if not hasattr(c, "co_code")])) if code else ""
    return f"{getattr(fn, '__module__', '')}.{getattr(fn, '__qualname__', type(fn).__name__)}:{hashlib.sha256(body.encode()).hexdigest()}"


def _file(spark: SparkSession, path: str, name: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, name))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the stage written at ``path``; None without one (also when it is cut or no JSON)."""
    fs, p = _file(spark, path, MANIFEST)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:
        return None
    except Py4JJavaError as e:
        if "ChecksumException" in e.java_exception.getClass().getName():
            return None
        raise
    finally:
        stream.close()
    return found if isinstance(found, dict) else None


def write_manifest(spark: SparkSession, path: str, key: str, **more) -> None:
    """Write the manifest beside ``_SUCCESS``; it appears whole, by a rename."""
    fs, p = _file(spark, path, MANIFEST)
    part = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, MANIFEST + ".part"))
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(json.dumps({"key": key, **more}, sort_keys=True, default=str).encode()))
    finally:
        stream.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"manifest of {path} could not be put in place")


def is_fresh(spark: SparkSession, path: str, key: str) -> bool:
    """The folder was written completely, from what ``key`` stands for."""
    fs, done = _file(spark, path, "_SUCCESS")
    return fs.exists(done) and (read_manifest(spark, path) or {}).get("key") == key
