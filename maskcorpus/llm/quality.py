"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets counts (words, characters, symbols, repeated lines and
passages). Fixed base rules reject the hopeless ones; the rest feed one
quantile sketch per language, source and measure. A sketch is a histogram of
value classes with five significant bits, so a quantile is within 1/16 of its
value and sketches merge by adding counts. A group's thresholds come from its
own sketch merged with those of its language and of the whole corpus, each of
these scaled to PRIOR documents: so a group of few documents is near its
language and one of many near itself, by one formula at every size. Thresholds
are fences around the quartiles, joined back to the documents.

The fence of ``repeat_rate`` never rejects what the base rule lets pass: its
least reach is the base rule's limit, as documents that are good by their
labels repeat up to that much.

Everything here is DataFrame and SQL expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import staged

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW_WORDS = 8
#: Significant bits of a sketch's value classes.
SKETCH_BITS = 5


@dataclass(frozen=True)
class Measure:
    """A measure in thousandths, the least spread its fences assume, and which fences it has."""

    name: str
    sql: str
    spread: int
    low: bool = False


MEASURES = (
    Measure("word_length", "word_chars * 1000 div greatest(n_words, 1L)", 500, low=True),
    Measure("symbol_rate", "n_symbols * 1000 div greatest(n_words, 1L)", 50),
    Measure("dup_line_rate", "n_dup_lines * 1000 div greatest(n_words, 1L)", 20),
    Measure("repeat_rate", "n_repeat_words * 1000 div greatest(n_words, 1L)", 75),
)
#: Fences stand this many spreads (interquartile range, or the least spread) outside the quartiles.
FENCE = 4
#: Documents that the sketches of a group's language and of the corpus count as beside its own.
PRIOR = 50
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use`` has it inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _next(values: Column, by: int) -> Column:
    return F.slice(values, 1 + by, F.greatest(F.size(values) - by, F.lit(0)))


def _window_hashes(words: Column) -> Column:
    """A hash of each run of WINDOW_WORDS words, by doubling: runs of 2, 4 and 8 words from two halves."""
    def doubled(half: int):
        return lambda h: F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - half, F.lit(0))), _next(h, half),
                                    lambda a, b: F.xxhash64(a, b))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for half in (1, 2, 4):
        hashes = _once(hashes, doubled(half))
    return hashes


def _covered(hashes: Column) -> Column:
    """Number of words inside windows whose hash occurs twice or more."""
    def gaps(at: Column) -> Column:
        nexts = F.zip_with(at, _next(at, 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS)))
        return F.aggregate(nexts, F.lit(0), lambda total, x: total + x)

    def repeated(ordered: Column) -> Column:
        again = F.filter(ordered, lambda x, i: (
            (F.when(i > 0, F.get(ordered, i - 1)["h"]) == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"])))
        return _once(F.sort_array(F.transform(again, lambda x: x["i"])), gaps)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_once(ordered, repeated))


def text_stats(text: Column) -> Column:
    """Struct of the STATS of a text; null text has no words."""
    whole = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            _once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.when(F.size(words) > WINDOW_WORDS, _once(_window_hashes(words), _covered))
            .otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))

    return _once(F.filter(F.split(whole, SPACE), lambda w: w != ""), of)


def with_stats(docs: DataFrame) -> DataFrame:
    """Add the STATS and ``base_failed`` to documents with a ``text``."""
    out = docs.withColumn("stats", text_stats(F.col("text")))
    out = out.select(*docs.columns, *[F.col(f"stats.{s}").alias(s) for s in STATS])
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def value_class(value: Column) -> Column:
    """The smallest value that shares the SKETCH_BITS leading bits of a non-negative long."""
    drop = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, measure, at, n): a quantile sketch per language, source and measure of the base-passing rows."""
    pairs = ", ".join(f"'{m.name}', {m.sql}" for m in MEASURES)
    values = (stats.where("not base_failed")
              .selectExpr("lang", "source", f"stack({len(MEASURES)}, {pairs}) as (measure, value)"))
    return (values.groupBy("lang", "source", "measure", value_class(F.col("value")).alias("at"))
            .agg(F.count("*").alias("n")))


def merge_sketches(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of the coarser groups ``by``: counts of equal classes add up."""
    return sketch.groupBy(*by, "measure", "at").agg(F.sum("n").alias("n"))


def blended(base: DataFrame) -> DataFrame:
    """(lang, source, measure, at, weight): each group's sketch merged with its parents', scaled to PRIOR documents each.

    Weights are whole numbers, a group's common factor (the parents' sizes)
    times documents. A group has at most a few hundred classes whatever the
    corpus; the corpus's own classes are that few too.
    """
    none = F.lit(0).cast("long")
    groups = base.select("lang", "source", "measure").distinct()
    key = ["lang", "source", "measure", "at"]
    lang = merge_sketches(base, ["lang"]).select(F.col("lang").alias("_lang"), F.col("measure").alias("_measure"), "at", "n")
    every = merge_sketches(base, []).select(F.col("measure").alias("_measure"), "at", "n")
    own = base.select(*key, F.col("n").alias("own"), none.alias("lang_n"), none.alias("all_n"))
    of_lang = (groups.join(lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_measure")))
               .select(*key, none.alias("own"), F.col("n").alias("lang_n"), none.alias("all_n")))
    of_all = (groups.join(every, F.col("measure") == F.col("_measure"))
              .select(*key, none.alias("own"), none.alias("lang_n"), F.col("n").alias("all_n")))
    sums = own.unionAll(of_lang).unionAll(of_all).groupBy(*key).agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("own", "lang_n", "all_n")])
    group = Window.partitionBy("lang", "source", "measure")
    sized = sums.withColumns({"lang_size": F.sum("lang_n").over(group).cast("decimal(38,0)"), "all_size": F.sum("all_n").over(group).cast("decimal(38,0)")})
    prior = F.lit(PRIOR).cast("decimal(38,0)")
    weight = (F.col("own") * F.col("lang_size") * F.col("all_size") + prior * F.col("lang_n") * F.col("all_size")
              + prior * F.col("all_n") * F.col("lang_size"))
    return sized.select(*key, weight.cast("decimal(38,0)").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, q1, q3): the value classes that hold the ranks ceil(n/4) and ceil(3n/4).

    The window runs over a group's classes, at most a few hundred rows whatever the corpus.
    """
    group = [*by, "measure"]
    total = F.sum("n").over(Window.partitionBy(*group))
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("at"))
    ranked = sketch.withColumns({"total": total, "upto": upto})
    return ranked.groupBy(*group).agg(
        F.expr("min(case when 4 * upto >= total then at end)").alias("q1"),
        F.expr("min(case when 4 * upto >= 3 * total then at end)").alias("q3"))


def _fences(levels: DataFrame, by: list[str]) -> DataFrame:
    """One row per group: a lower and upper fence for each measure."""
    wide = []
    for m in MEASURES:
        q = {x: f"max(case when measure = '{m.name}' then {x} end)" for x in ("q1", "q3")}
        reach = f"{FENCE} * greatest({q['q3']} - {q['q1']}, {m.spread})"
        wide.append(F.expr(f"{q['q3']} + {reach}").alias(f"{m.name}_max"))
        if m.low:
            wide.append(F.expr(f"{q['q1']} - {reach}").alias(f"{m.name}_min"))
    return levels.groupBy(*by).agg(*wide)


def thresholds(stats: DataFrame) -> DataFrame:
    """(lang, source, <measure>_max, <measure>_min) for every language and source that passed the base rules.

    Null languages and sources are groups of their own.
    """
    group = ["lang", "source"]
    return _fences(quartiles(blended(staged(sketches(stats), "sketches")), group), group)


def judged(stats: DataFrame) -> DataFrame:
    """Add ``kept`` to rows of ``with_stats``: false for base failures and for rows outside a fence of their group."""
    fence = staged(thresholds(stats), "thresholds")  # its size is then known before the documents are joined, so they need not move
    limits = fence.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                          *[F.col(c).alias(f"_{c}") for c in fence.columns[2:]])
    inside = " and ".join([f"{m.sql} <= _{m.name}_max" for m in MEASURES]
                          + [f"{m.sql} >= _{m.name}_min" for m in MEASURES if m.low])
    joined = stats.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.select(*stats.columns, F.expr(f"not base_failed and coalesce({inside}, true)").alias("kept"))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, the STATS, base_failed, kept) of every document.

    Null text: no words, so it fails the base rules. A document whose group
    has no threshold is kept if it passes the base rules. Repeated rows are
    judged alike; extra columns are not read; an empty table gives an empty one.
    """
    stats = staged(with_stats(docs.select("doc_id", "lang", "source", "text")).drop("text"), "stats")
    return judged(stats).select("doc_id", *STATS, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns (they travel as one struct, so names cannot clash).

    Null and empty texts fail the base rules and go; repeated rows stay or go
    together; an empty table gives an empty one.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "lang", "source", "text")
    stats = staged(with_stats(rows).drop("text"), "judged")
    return judged(stats).where("kept").select("doc.*")
