"""URL filters: host and path rules, and a tree of path templates per host.

Rules decide first. For the other urls, paths of a host are generalised level
by level: runs of digits become wildcards, and sibling branches whose share
of bad labels cannot be told apart merge into one wildcard branch, so that
what is left are templates such as ``example.org/en/*``. A template is
rejected if its share of bad labels, smoothed towards the share in all
labelled pages, reaches a threshold.

Paths are grouped before anything else and every step is an aggregation or a
join on (host, prefix), so a host with a third of all pages is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels that the SQL twin spells out; ``judge`` itself takes all levels.
MAX_DEPTH = 6
#: Standard errors by which a branch must differ from its siblings to stay on its own.
Z = 3.0
#: Labelled pages that such a branch needs.
MIN_LABELS = 5
#: Labelled pages that the corpus's share of bad labels counts for in a template's purity.
SMOOTHING = 5.0
REJECT = 0.5


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls.

    ``rules`` is a short list of (verdict, host and path). A rule fits its
    host and all subdomains where the path starts with the rule's; of rules of
    one length the first by text wins.
    """
    rule = verdict = None
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def templates(paths: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(host, path, template) for ``paths(host, path, pages, labelled, bad)``, one row per path.

    At each level the branches of a node are the path segments with digits
    as ``*``. A branch keeps its name if it is the only one, or if it has
    MIN_LABELS labels and its bad share differs from that of its siblings by Z
    standard errors; all others merge into ``*``, and the next level looks at
    the merged branch as one. With ``max_depth`` what lies deeper is ``**``.

    A round names the branches of one level and goes on through the levels
    where all paths of the new node agree, so a chain of any length costs one
    round; only paths that still branch are read again.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    now = paths.withColumn("segments", F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", "*")))
    if max_depth is not None:
        cut = F.concat(F.slice("segments", 1, max_depth), F.array(F.lit("**")))
        now = now.withColumn("segments", F.when(F.size("segments") > max_depth, cut).otherwise(F.col("segments")))
    now = now.withColumns({"depth": F.size("segments"), "prefix": F.lit("")})
    now = staged(now, "paths")
    node = ["host", "depth", "prefix"]
    found = None
    while True:  # segments are those that have no name yet
        closed = now.where(F.size("segments") == 0)
        found = closed if found is None else found.unionAll(closed)
        open_ = now.where(F.size("segments") > 0)
        if open_.isEmpty():
            break
        rest = F.slice("segments", F.lit(2), F.size("segments"))
        open_ = open_.withColumn("branch", F.get("segments", F.lit(0))).withColumn("segments", rest)
        branches = open_.groupBy(*node, "branch").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"),
                                                      F.min("segments").alias("low"), F.max("segments").alias("high"))
        total = branches.groupBy(*node).agg(F.count("*").alias("k"), F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        told = branches.join(total, node).withColumns({
            "p": F.expr("(b + 0.5D) / (n + 1)"), "q": F.expr("(all_b - b + 0.5D) / (all_n - n + 1)"),
            "r": F.expr("(all_b + 0.5D) / (all_n + 1)")})
        own = f"k = 1 or (n >= {MIN_LABELS} and abs(p - q) > {Z}D * sqrt(r * (1 - r) * (1D / (n + 1) + 1D / (all_n - n + 1))))"
        named = staged(told.select(*node, "branch", F.expr(f"if({own}, branch, '*')").alias("name"), "low", "high"), "branches")
        # what the first and the last path of a node share, all share
        ends = named.groupBy(*node, "name").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        differs = F.array_position(F.zip_with("low", "high", lambda x, y: x == y), False)
        shared = F.when(differs == 0, F.size("low")).otherwise(differs - 1).cast("int")
        ends = ends.select(*node, "name", shared.alias("shared"))
        onward = named.select(*node, "branch", "name").join(ends, [*node, "name"])
        moved = open_.join(onward, [*node, "branch"])
        path = F.concat_ws("/", F.concat("prefix", F.lit("/"), "name"), F.slice("segments", F.lit(1), F.col("shared")))
        moved = moved.withColumn("prefix", path).withColumn("segments", F.slice("segments", F.col("shared") + 1, F.size("segments")))
        now = staged(moved.select(*now.columns), "paths")
    return found.select("host", "path", F.concat("host", F.when(F.col("prefix") == "", "/").otherwise(F.col("prefix"))).alias("template"),
                        "pages", "labelled", "bad")


def purities(found: DataFrame) -> DataFrame:
    """(template, pages, labelled, purity): the smoothed share of bad labels of each template."""
    total = found.agg(F.expr("coalesce(sum(bad) / nullif(sum(labelled), 0), 0D)").alias("prior"))
    by = found.groupBy("template").agg(F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    return by.join(F.broadcast(total)).select(  # one row
        "template", "pages", "labelled", F.expr(f"(bad + {SMOOTHING}D * prior) / (labelled + {SMOOTHING}D)").alias("purity"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], max_depth: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page.

    ``labels(page_id, bad)`` with bad 0 or 1 is the labelled sample (an id that
    repeats counts once, bad if any of its rows is; null ids and labels count
    for nothing). A url that is null or has no ``://`` has an empty host and
    path. Without a fitting rule the verdict is block if the template's
    purity reaches REJECT. Repeated rows are pages of their own; extra
    columns are not read; an empty table gives an empty one. Templates have
    all levels of the paths, or with ``max_depth`` that many and one wildcard for what lies deeper.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = staged(rows.withColumns({"rule": rule, "says": verdict}), "urls")
    known = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    with_labels = rows.select("page_id", "host", "path").join(known, "page_id", "left")
    paths = with_labels.groupBy("host", "path").agg(F.count("*").alias("pages"), F.count("bad").alias("labelled"),
                                                    F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    found = staged(templates(paths, max_depth), "templates")
    rated = staged(found.select("host", "path", "template").join(purities(found).select("template", "purity"), "template"), "rated")
    return rows.join(rated, ["host", "path"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("says", F.when(F.col("purity") >= REJECT, "block").otherwise("allow")).alias("verdict"), "template", "purity")
