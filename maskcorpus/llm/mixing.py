"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words. A document's expected number of copies is
its whole copies, which it gets for certain, and an inclusion probability p
for one more. The extra copies are drawn by Pareto order sampling: a document
with the uniform number u gets the rank (u / (1 - u)) / (p / (1 - p)), and
those with the smallest ranks are taken until the source's sample has its
fixed size in words. Ranks never need a sort: the cut between taken and left
is found from words per rank class, first for the upper and then for the
lower half of the rank's bits.

Everything here is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import staged

WORD_GAP = r"[\x20\x09-\x0D]+"
#: Sources, by code point and null last, have these weights in turn.
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Relative weight of a document of size class c (bits of its size): shorter ones repeat a little more.
CLASS_WEIGHT = "1000 + 1000 div (1 + size_class)"
RANK_BITS = 30
LOW_BITS = 15


def n_words(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")).cast("long")


def _filled(rows: DataFrame, total: str, group: list[str]) -> DataFrame:
    """Add ``share``: ``total`` dealt out by ``weight``, none above ``cap``, the excess dealt again to the rest.

    In order of cap by weight, a row is full if an even deal of what the rows
    before it leave would give it its cap or more. One row per source (or
    size class) is small whatever the corpus.
    """
    before = Window.partitionBy(*group).orderBy(F.expr("cap / weight"), "cap", "tie").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*group)
    left = rows.withColumn("left_total", F.expr(total) - F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn(
        "left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    full = left.withColumn("full", F.expr("double(left_total) * weight >= double(cap) * left_weight"))
    free = full.withColumns({
        "free_total": F.expr(total) - F.coalesce(F.sum(F.expr("case when full then cap end")).over(every), F.lit(0)),
        "free_weight": F.sum(F.expr("case when not full then weight end")).over(every)})
    return (free.withColumn("share", F.expr("case when full then double(cap) else double(free_total) * weight / free_weight end"))
            .drop("left_total", "left_weight", "full", "free_total", "free_weight"))


def targets(sizes: DataFrame, total_share: float = 1.0) -> DataFrame:
    """(source, source_size, target) for rows (source, size).

    Sources weigh WEIGHTS in turn and share ``total_share`` of all words; a
    target stops at MAX_COPIES times its source's words. The only window
    without a key is over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    rows = (per.withColumn("tie", F.row_number().over(order))
            .withColumn("weight", F.get(weights, (F.col("tie") - 1) % len(WEIGHTS)))
            .withColumn("cap", F.expr(f"{MAX_COPIES} * source_size"))
            .withColumn("all_words", F.sum("source_size").over(Window.partitionBy()))
            .withColumn("wanted", F.expr(f"all_words * {total_share}D") if total_share != 1.0 else F.col("all_words")))
    return _filled(rows, "wanted", []).select("source", "source_size", F.col("share").alias("target"))


def rates(classes: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, size_class, whole, p): certain copies and the probability of one more, for every class of sizes.

    ``classes(source, size_class, words)``. A source's target is dealt to its
    size classes by words times CLASS_WEIGHT, at most MAX_COPIES times a
    class's words, so the expected words of a source equal its target.
    """
    rows = (classes.where("words > 0").join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .selectExpr("source", "size_class", "words", "target", f"words * ({CLASS_WEIGHT}) as weight",
                        f"{MAX_COPIES} * words as cap", "size_class as tie"))
    share = _filled(rows, "target", ["source"]).withColumn("copies", F.expr(f"least(share / words, {MAX_COPIES}D)"))
    return share.selectExpr("source", "size_class", "cast(floor(copies) as long) as whole",
                            "copies - floor(copies) as p", "words", "target")


def uniform(seed: int, key: Column) -> Column:
    """A number in (0, 1) with 52 random bits, from the MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(2 ** 52))


def rank(u: str = "u", p: str = "p") -> Column:
    """Pareto rank r = odds(u) / odds(p), mapped by r / (1 + r) to a whole number below 2^RANK_BITS."""
    return F.expr(f"cast(floor({float(2 ** RANK_BITS)}D * ({u} * (1 - {p})) / ({u} * (1 - {p}) + {p} * (1 - {u}))) as long)")


def _cut(sums: DataFrame, key: str, need: str) -> DataFrame:
    """(source, key, before, here): the class in which the running words of a source reach ``need``."""
    upto = Window.partitionBy("source").orderBy(key)
    run = sums.withColumn("upto", F.sum("here").over(upto))
    return run.where(f"upto >= {need} and upto - here < {need}").withColumn("before", F.expr("upto - here"))


def cuts(ranked: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, cut): ranks up to ``cut`` are taken, so that a source's extra copies have the words it still needs.

    ``ranked(source, size, rank)`` holds the documents with a chance, ``goal(source, need)``
    the words wanted. Words are summed by the upper half of the rank's bits
    (at most 2^15 rows a source), then by the whole rank inside the one class
    that holds the cut. The document at the cut is taken if that brings the
    sum nearer to the need; documents of one rank go together.
    """
    upper = (ranked.groupBy("source", F.shiftright("rank", LOW_BITS).alias("upper")).agg(F.sum("size").alias("here")))
    goal = goal.withColumnRenamed("source", "of")
    at = _cut(upper.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "upper", "need")
    at = at.select(F.col("source").alias("of"), F.col("upper").alias("at"), "before", "need")
    inside = (ranked.join(at, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("rank", LOW_BITS) == F.col("at")))
              .groupBy("source", "rank", "before", "need").agg(F.sum("size").alias("here")))
    run = inside.withColumn("upto", F.col("before") + F.sum("here").over(Window.partitionBy("source").orderBy("rank")))
    return run.groupBy("source").agg(
        F.coalesce(F.max(F.expr("case when upto - here / 2.0D <= need then rank end")), F.min("rank") - 1).alias("cut"))


def copies(docs: DataFrame, seed: int = 42, total_share: float = 1.0) -> DataFrame:
    """Add size, source_size, target and copies to ``docs(doc_id, source, size)``.

    Documents of no words are never taken (copies 0): they add nothing to any
    target. Null sources are a source of their own, null ids draw like any
    id, and rows that repeat an id are taken or left together.
    """
    by_class = F.expr("length(bin(size))").cast("int")
    classes = staged(docs.groupBy("source", by_class.alias("size_class")).agg(F.sum("size").alias("words")), "classes")
    goal = staged(targets(classes.withColumnRenamed("words", "size"), total_share), "targets")
    rate = staged(rates(classes, goal), "rates")
    plan = rate.selectExpr("source as _source", "size_class as _class", "whole", "p")
    drawn = (docs.withColumn("_at", by_class)
             .join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_at") == F.col("_class")), "left")
             .drop("_at", "_source", "_class"))
    drawn = drawn.withColumn("u", uniform(seed, F.col("doc_id"))).withColumn("rank", F.expr("case when p > 0 and size > 0 then 1 end") * rank())
    need = (rate.groupBy("source").agg(F.expr("max(target) - sum(whole * words)").alias("need"))
            .where("need > 0"))
    cut = staged(cuts(drawn.where("rank is not null").select("source", "size", "rank"), need), "cuts")
    out = drawn.join(cut.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")), "left")
    out = out.withColumn("copies", F.expr("case when size > 0 then whole + if(rank <= cut, 1L, 0L) else 0L end"))
    out = out.select(*docs.columns, "copies")
    names = goal.withColumnRenamed("source", "_of")
    return out.join(names, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def mix(docs: DataFrame, seed: int = 42, total_share: float = 1.0) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; taken is copies times size.

    An empty table gives an empty one; extra columns are not read. The same
    rows and seed give the same mix.
    """
    sizes = staged(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    return (copies(sizes, seed, total_share)
            .select("doc_id", "size", "source_size", "target", F.expr("copies * size").alias("taken")))


def mixed(docs: DataFrame, seed: int = 42, total_share: float = 1.0) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns (as one struct, so names cannot clash)."""
    rows = staged(docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "source", n_words(F.col("text")).alias("size")),
                  "sizes")
    return (copies(rows, seed, total_share).where("copies > 0")
            .select("doc", F.explode(F.expr("sequence(1L, copies)"))).select("doc.*"))
