"""A1: landed repository-search pages -> one row per repo item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("html_url", T.StringType()),
    T.StructField("default_branch", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("stargazers_count", T.LongType()),
    T.StructField("fork", T.BooleanType()),
    T.StructField("archived", T.BooleanType()),
    T.StructField("owner", T.StructType([T.StructField("login", T.StringType())])),
    T.StructField("license", T.StructType([T.StructField("spdx_id", T.StringType())])),
])
PAGE = T.StructType([T.StructField("page", T.LongType()), T.StructField("items", T.ArrayType(ITEM))])


#: A line that is a whole JSON record.
_RECORD_LINE = r"\A\s*\{.*\}\s*\z"


def read_pages(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    """Landed search pages, one row per page: ``file, record, items``.

    ``auto`` takes each file as a text: a file whose every line is a JSON
    object holds a page per line, a file that starts with ``[`` a list of
    pages, any other one page. ``lines`` reads a page per line and splits large
    files. A page that does not parse fails the job; nothing is skipped.
    """
    read = {"mode": "FAILFAST"}
    if layout == "lines":
        raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("record"), "value")
        return raw.where(F.trim("value") != "").select("file", "record", F.from_json("value", PAGE, read)["items"].alias("items"))
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = F.filter(F.split("value", "\n", -1), lambda x: F.trim(x) != "")
    by_line = F.forall(lines, lambda x: x.rlike(_RECORD_LINE))
    texts = raw.select("file", F.when(by_line, lines).otherwise(F.array("value")).alias("texts"),
                       F.ltrim("value").startswith("[").alias("listed"))
    single = (texts.where(~F.col("listed")).select("file", F.posexplode("texts").alias("record", "value"))
              .select("file", F.col("record").cast("long"), F.from_json("value", PAGE, read)["items"].alias("items")))
    several = (texts.where("listed").select("file", F.posexplode(F.from_json(F.get("texts", F.lit(0)), T.ArrayType(PAGE), read)).alias("record", "page"))
               .select("file", F.col("record").cast("long"), F.col("page.items").alias("items")))
    return single.unionAll(several)


def read_repo_catalog(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    """A1: one row per repository of every page of every file.

    ``repo_key`` is file, page and position as one text that sorts in that
    order: the order in which the pages were landed.
    """
    e = read_pages(spark, path, layout).select("file", "record", F.posexplode("items").alias("item_ord", "it"))
    key = F.concat("file", F.lit("#"), F.lpad(F.col("record").cast("string"), 19, "0"), F.lit("#"), F.lpad(F.col("item_ord").cast("string"), 9, "0"))
    return e.select("file", "record", "item_ord", key.alias("repo_key"), *_fields())


def _fields() -> list:
    return [F.col("it.owner.login").alias("owner"), F.col("it.name").alias("repo"), F.col("it.html_url").alias("html_url"),
            F.col("it.language").alias("language"), F.col("it.stargazers_count").alias("stars"), F.col("it.fork").alias("fork"),
            F.col("it.archived").alias("archived"), F.col("it.license.spdx_id").alias("license"),
            F.col("it.default_branch").alias("default_branch")]


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Explode ``items`` and lift the nested fields; ``item_ord``/``repo_key`` keep the API order."""
    e = pages.select("page", F.posexplode("items").alias("item_ord", "it"))
    # repo_key: the API's own order (page, position), the tie-break the reference implicitly uses
    return e.select("page", "item_ord", (F.col("page") * 1_000_000 + F.col("item_ord")).alias("repo_key"),
                    *_fields())


def to_pages(repos: DataFrame, page_size: int = 100, key: str = "repo_key") -> DataFrame:
    """Build search pages from flat repo rows (for landing or tests): ``page, items``.

    Pages hold ``page_size`` items each, so the per-page list is bounded.
    """
    item = F.struct(F.col("repo").alias("name"), F.col("html_url"), F.col("default_branch"), F.col("language"),
                    F.col("stars").alias("stargazers_count"), F.col("fork"), F.col("archived"),
                    F.struct(F.col("owner").alias("login")).alias("owner"),
                    F.when(F.col("license").isNotNull(), F.struct(F.col("license").alias("spdx_id"))).alias("license"))
    p = repos.withColumn("page", F.floor(F.col(key) / page_size).cast("long"))
    return p.groupBy("page").agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), item.alias("it")))),
                                             lambda x: x["it"]).alias("items"))
