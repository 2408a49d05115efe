"""Python string semantics as native Spark expressions.

Python's ``str.split()``/``str.strip()`` use its own whitespace set, which is
neither Java's ``\\s`` nor Spark's ``trim``; every helper here spells the set
out so results equal the Python reference character for character.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskcorpus.config import PY_WHITESPACE_CLASS

WS_RUN = PY_WHITESPACE_CLASS + "+"
_STRIP = r"\A" + WS_RUN + "|" + WS_RUN + r"\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_split(col) -> Column:
    """``str.split()``: split on runs of Python whitespace, drop empty pieces."""
    return F.array_remove(F.split(_c(col), WS_RUN), "")


def py_strip(col) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(_c(col), _STRIP, "")


def split_lines(col) -> Column:
    """``str.split('\\n')``: trailing empty line kept."""
    return F.split(_c(col), "\n", -1)


def line_count(col) -> Column:
    """``code.count('\\n') + 1``."""
    return F.size(split_lines(col))


def mask_budget(n, rate_percent: int = 15) -> Column:
    """``max(1, int(n * rate))`` in exact integer form."""
    return F.greatest(F.lit(1), F.floor(_c(n) * rate_percent / 100).cast("int"))


def sentinel(i) -> Column:
    """``<extra_id_i>`` for a 0-based ordinal column."""
    return F.concat(F.lit("<extra_id_"), _c(i).cast("string"), F.lit(">"))


def function_id(i, code) -> Column:
    """sha256 hex of ``f"{i}:{code[:100]}"`` (first 100 code points)."""
    return F.sha2(F.concat(_c(i).cast("string"), F.lit(":"), F.substring(_c(code), 1, 100)), 256)


def example_id(func_id, line) -> Column:
    """sha256 hex of ``f"{func_id}:{line}"``."""
    return F.sha2(F.concat(_c(func_id), F.lit(":"), _c(line).cast("string")), 256)


def seeded_key(seed: int, *parts) -> Column:
    """sha256 hex of ``"seed:part1:part2..."``: the reproducible random key of every sampler."""
    pieces = [F.lit(str(seed))]
    for p in parts:
        pieces += [F.lit(":"), _c(p).cast("string")]
    return F.sha2(F.concat(*pieces), 256)
