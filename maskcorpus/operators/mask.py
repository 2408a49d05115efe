"""Condition masking.

Masking is line-substring based, exactly as the reference does it: on the
``if`` line try each keyword in order, split at its *first* occurrence and mask
up to the *first* terminator after it. All of it is one native projection: no
Python, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskcorpus.config import IF_KEYWORDS, IF_TERMINATOR, MASK_TOKEN
from maskcorpus.functions.text import example_id, py_strip, split_lines


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def mask_line(line, keywords: Sequence[str] = IF_KEYWORDS, terminator: str = IF_TERMINATOR,
              mask: str = MASK_TOKEN) -> Column:
    """Masked line, or null when no keyword is followed by the terminator.

    ``before + kw + ' ' + mask + after[after.find(term):]`` for the first keyword
    (in the given order) that occurs and has a terminator after it (Q1-Q4).
    """
    line = _c(line)
    out = None
    for kw in keywords:
        p = F.instr(line, kw)
        after = F.substr(line, p + len(kw))
        c = F.instr(after, terminator)
        masked = F.concat(F.substr(line, F.lit(1), p - 1), F.lit(f"{kw} {mask}"), F.substr(after, c))
        hit = (p > 0) & (c > 0)
        out = F.when(hit, masked) if out is None else out.when(hit, masked)
    return out


def replace_line(lines: Column, index: Column, new_line: Column) -> Column:
    """Join ``lines`` with newlines, element ``index`` (0-based) replaced.

    Built from two slices around the line: no per-element lambda, and the new
    line is evaluated once per row.
    """
    return F.array_join(F.concat(F.slice(lines, F.lit(1), index), F.array(new_line),
                                 F.slice(lines, index + 2, F.size(lines))), "\n")


def having_ifs(functions: DataFrame, col: str = "if_statements") -> DataFrame:
    """Keep functions with at least one ``if``."""
    return functions.where(F.size(col) > 0)


def explode_ifs(functions: DataFrame, keep: Sequence[str] = ("id", "code")) -> DataFrame:
    """D3: one row per (function, if) with ``condition, line, depth``; order kept in ``if_ord``."""
    cols = [F.col(k) for k in keep]
    return functions.select(*cols, F.posexplode("if_statements").alias("if_ord", "s")).select(
        *keep, "if_ord", "s.condition", "s.line", "s.depth")


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def mask_at_line(df: DataFrame, code: str = "code", line: str = "line",
                 keywords: Sequence[str] = IF_KEYWORDS, terminator: str = IF_TERMINATOR,
                 mask: str = MASK_TOKEN) -> DataFrame:
    """B7 + B8 + E11: add ``input`` = code with the 1-based ``line`` masked; drop misses.

    Rows whose line is past the text (B7) or has no keyword+terminator (B8) are
    dropped: the generator below yields one row or none, so no filter repeats
    the split.
    """
    k = F.col(line) - 1

    def of(lines: Column) -> Column:
        return F.struct(lines.alias("lines"), _once(F.get(lines, k), lambda x: mask_line(x, keywords, terminator, mask)).alias("masked"))

    hit = F.filter(F.transform(F.array(split_lines(code)), of), lambda s: s["masked"].isNotNull())
    out = df.select("*", F.inline(hit).alias("_lines", "_masked"))
    return out.withColumn("input", replace_line(F.col("_lines"), k, F.col("_masked"))).drop("_lines", "_masked")


def mask_conditions(functions: DataFrame, keywords: Sequence[str] = IF_KEYWORDS,
                    terminator: str = IF_TERMINATOR, mask: str = MASK_TOKEN,
                    carry: Sequence[str] = ()) -> DataFrame:
    """G1: one fine-tune example per maskable ``if``: ``id, input, target`` (+ ``func_id, line``).

    ``functions`` needs ``id, code, if_statements``. The example id is
    sha256(func_id:line); the target is the stripped condition. The code is
    split once per function, below the generator, and the masked line is part
    of the exploded struct.
    """
    split = functions.select("id", *carry, "if_statements", split_lines("code").alias("_lines"))
    hits = F.filter(F.transform("if_statements", lambda s: F.struct(
        s["condition"].alias("condition"), s["line"].alias("line"),
        _once(F.get(F.col("_lines"), s["line"] - 1), lambda x: mask_line(x, keywords, terminator, mask)).alias("masked"))),
        lambda s: s["masked"].isNotNull())
    ex = split.select("id", *carry, "_lines", F.inline(hits))
    return ex.select(example_id("id", "line").alias("id"), F.col("id").alias("func_id"), *carry, F.col("line"),
                     replace_line(F.col("_lines"), F.col("line") - 1, F.col("masked")).alias("input"),
                     py_strip("condition").alias("target"))


def mask_after_keyword(df: DataFrame, text: str, keywords: Sequence[str], terminator: str,
                       mask: str = MASK_TOKEN, key: Sequence[str] = ()) -> DataFrame:
    """The masking rule by parameters, on every line of every text.

    One row per line that masks: ``key..., line (1-based), masked_line, span``
    where ``span`` is the stripped text that the mask replaced.
    """
    exploded = df.select(*key, F.posexplode(split_lines(text)).alias("pos", "text_line"))
    m = mask_line("text_line", keywords, terminator, mask)
    span = None
    for kw in keywords:
        p = F.instr("text_line", kw)
        after = F.substr("text_line", p + len(kw))
        c = F.instr(after, terminator)
        piece = F.substr(after, F.lit(1), c - 1)
        hit = (p > 0) & (c > 0)
        span = F.when(hit, piece) if span is None else span.when(hit, piece)
    return (exploded.withColumn("masked_line", m).where(F.col("masked_line").isNotNull())
            .select(*key, (F.col("pos") + 1).alias("line"), "masked_line", py_strip(span).alias("span")))


def mask_first_if(code_ifs: DataFrame, key: Sequence[str] = ("item_id",),
                  keywords: Sequence[str] = IF_KEYWORDS, terminator: str = IF_TERMINATOR,
                  mask: str = MASK_TOKEN) -> DataFrame:
    """G2 + C3: benchmark rows -> ``input, target`` from the first ``if`` in pre-order.

    ``code_ifs`` needs ``key..., code, if_statements``. Rows with no ``if`` or
    whose first ``if`` does not mask disappear (Q20). The target is the
    extracted condition as is.
    """
    first = code_ifs.where(F.size("if_statements") > 0).select(
        *key, "code", F.get("if_statements", 0).alias("s")).select(
        *key, "code", "s.condition", "s.line")
    ex = mask_at_line(first, "code", "line", keywords, terminator, mask)
    return ex.select(*key, "input", F.col("condition").alias("target"))
