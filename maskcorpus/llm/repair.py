"""Conversation structure repair by weighted CYK interval parsing.

A repaired conversation has role initials of the language ``(s?(ua)+)?``. The
repair grammar's nonterminals are A_pq, "this span leads from state p to state
q of that language"; its rules are A_pq -> A_pr A_rq and, for a single row,
A_pq -> one edit of the row. So the grammar is in Chomsky normal form. A cell
is the cheapest (cost, audit) of a nonterminal over a span, where audit spells
the edits in order; every row's cells are closed under insertions on both
sides, which holds for longer spans then too.

As r runs over all states in the binary rule, a span's cells come out the same
at whichever place it is split. So spans of 1, 2, 4, ... rows, bottom-up by
length, are enough: n rows cost O(n) combinations, and a conversation can be
cut between tasks. (Taking the least audit inside a cell is exact: two audits
of one span with equal cost are never prefixes of one another, since further
letters of the same rows would be insertions and cost more.)

1. Marks: identical rows become one with a count, and the first of equal
   (role, text) rows is found, by sums and minima that combine in map tasks.
2. Spans: rows without their texts are sorted by ranges of (conversation,
   turn), so that a long conversation is cut into segments of several tasks.
3. Repair: segments meet, then the texts stream by in order. Here one
   conversation is one task, as its digest runs over its rows in order; in
   memory are its audit and one batch of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: State 0: nothing yet; 1: after s; 2: after u; 3: after a. Final states: 0 and 3.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
START, FINAL = 0, (0, 3)
BLANK, DUPLICATE, CUT, FINE = "blank", "duplicate", "truncated", ""


def _pairs() -> list[tuple[int, int]]:
    """(p, q) with q in reach of p."""
    reach = {p: {p} for p in range(4)}
    for _ in range(4):
        for (p, _c), q in STEPS.items():
            for r in reach.values():
                if p in r:
                    r.add(q)
    return [(p, q) for p in range(4) for q in sorted(reach[p])]


PAIRS = _pairs()
_AT = {pq: i for i, pq in enumerate(PAIRS)}
#: A_pq -> A_pr A_rq as places in a list of cells: (pq, pr, rq).
RULES = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, q in PAIRS for r in range(4) if (p, r) in _AT and (r, q) in _AT]

Cells = list  # of (cost, audit) or None, in the order of PAIRS


def combine(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two halves."""
    out: Cells = [None] * len(PAIRS)
    for pq, pr, rq in RULES:
        a, b = left[pr], right[rq]
        if a is None or b is None:
            continue
        cost, best = a[0] + b[0], out[pq]
        if best is None or cost < best[0] or cost == best[0] and a[1] + b[1] < best[1]:
            out[pq] = (cost, a[1] + b[1])
    return out


def _closure() -> Cells:
    """Cells of the empty span: insertions of user and assistant rows only."""
    once: Cells = [(0, "") if p == q else None for p, q in PAIRS]
    for (p, c), q in STEPS.items():
        if c in ROLES and p != q:
            once[_AT[p, q]] = (INSERT, "I")
    return combine(combine(once, once), once)


INSERTIONS = _closure()


def row_cells(initial: str, fault: str, times: int = 1) -> Cells:
    """Cells of a row, closed under insertions; ``times`` identical rows if they must all be deleted."""
    cells: Cells = [(DELETE * times, "D" * times) if p == q else None for p, q in PAIRS]
    if fault not in (BLANK, DUPLICATE):
        for (p, c), q in STEPS.items():
            more = TRUNCATED if fault == CUT else 0
            edit = (KEEP + more, "K") if c == initial else (REROLE + more, "R") if c in ROLES else None
            if edit is not None:
                cells[_AT[p, q]] = edit if cells[_AT[p, q]] is None else min(edit, cells[_AT[p, q]])
    return combine(combine(INSERTIONS, cells), INSERTIONS)


class Spans:
    """Bottom-up parse of rows as they come: waiting spans get longer to the left, equal lengths are combined."""

    def __init__(self):
        self.waiting: list[tuple[int, Cells]] = []
        self._rows: dict[tuple, Cells] = {}

    def row(self, initial: str, fault: str, times: int = 1) -> None:
        if times > 1:
            cells = row_cells(initial, fault, times)
        else:
            key = (initial if initial in ("s", "u", "a") else "", fault)
            if key not in self._rows:
                self._rows[key] = row_cells(*key)
            cells = self._rows[key]
        self.span(cells)

    def span(self, cells: Cells) -> None:
        size = 1
        while self.waiting and self.waiting[-1][0] <= size:
            n, left = self.waiting.pop()
            cells, size = combine(left, cells), size + n
        self.waiting.append((size, cells))

    def cells(self) -> Cells:
        """Cells of all rows so far."""
        out = INSERTIONS
        for _, left in reversed(self.waiting):
            out = combine(left, out)
        return out

    def clear(self) -> None:
        self.waiting = []


def best(cells: Cells) -> tuple[int, str]:
    """Cheapest (cost, audit) that leads from the start to a final state."""
    return min(cells[_AT[START, q]] for q in FINAL)


def targets(audit: str) -> Iterator[str]:
    """Role initials of the repaired rows: their number says whether there is an s, the rest is fixed."""
    left = len(audit) - audit.count("D")
    if left % 2:
        yield "s"
    for _ in range(left // 2):
        yield from "ua"


# --- rows --------------------------------------------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's test material: rows (conv_id, turn, role, text), damaged by crc32(conv_id:turn) % 20.

    Nulls in conv_id, turn, role and text count as one blank here; ids and turns stay null in the result.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.expr("sequence(1, if(kind = 3, 2, 1))")).alias("copy")).drop("copy")


def _plain(turns: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                        F.unhex(F.sha2(text, 256)).alias("digest"))


def marks(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, blank, cut, n, first): distinct rows with their number, without texts.

    ``first``: one of them is the conversation's first row of this role and
    text. A text that occurs in most rows is a few rows here after the map
    side's sums.
    """
    last = F.regexp_extract("text", r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = _plain(turns).withColumn("last", last).select(
        "conv_id", "turn", "role", "digest", (F.col("last") == "").alias("blank"), (~F.col("last").isin(".", "!", "?")).alias("cut"))
    same = rows.groupBy("conv_id", "turn", "role", "digest").agg(
        F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.count("*").alias("n"))
    first = same.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("at"))
    both = same.withColumn("first", F.lit(False)).unionByName(first.select(
        "conv_id", "role", "digest", F.col("at.turn").alias("turn"), F.lit(False).alias("blank"), F.lit(False).alias("cut"),
        F.lit(0).cast("long").alias("n"), F.lit(True).alias("first")))
    return both.groupBy("conv_id", "turn", "role", "digest").agg(
        F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.sum("n").alias("n"), F.max("first").alias("first"))


ORDER = ("conv_id", "turn", "role", "digest")
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
SEGMENT = ("struct<first: string, last: string, low: long, high: long, " + ", ".join(f"{c}: long" for c in _COUNTS)
           + ", cells: array<struct<cost: long, audit: string>>>")
_SEGMENT = pa.struct([("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()),
                      *((c, pa.int64()) for c in _COUNTS), ("cells", pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())])))])


def _joined(a: dict, b: dict) -> dict:
    """Counts of a segment and the one behind it."""
    out = {c: a[c] + b[c] for c in _COUNTS}
    out["illegal"] += a["last"] + b["first"] not in LEGAL
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    return out | {"first": a["first"], "last": b["last"], "low": b["low"] if a["low"] is None else a["low"],
                  "high": a["high"] if b["high"] is None else b["high"]}


def _one(turn, role: str, blank: bool, cut: bool, n: int, first: bool, spans: Spans) -> dict:
    """Counts of ``n`` identical rows, which also go to ``spans``."""
    initial = role[:1]
    faults = [(BLANK, n)] if blank else [(CUT if cut else FINE, 1), (DUPLICATE, n - 1)] if first else [(DUPLICATE, n)]
    out = dict.fromkeys(_COUNTS, 0) | {"first": initial, "last": initial, "low": turn, "high": turn, "illegal": n - 1, "turns": int(turn is not None)}
    for fault, times in faults:
        if times:
            spans.row(initial, fault, times)
            if fault:
                out[fault] += times
    return out


def _rows(batches, step: int = 512) -> Iterator[tuple]:
    """Rows of Arrow batches, a few at a time as Python values."""
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, step).columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight=lambda r: 1, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) + 100
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def segments(marked: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, segment): parsed stretches; order columns are those of a stretch's first row."""
    kinds = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()),
                       ("segment", _SEGMENT)])

    def run(batches):
        def parsed():
            spans = Spans()
            for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
                spans.clear()
                head = total = None
                for _, turn, role, digest, blank, cut, n, first in rows:
                    one = _one(turn, role, blank, cut, n, first, spans)
                    head, total = head or (conv, turn, role, digest), one if total is None else _joined(total, one)
                cells = [c and {"cost": c[0], "audit": c[1]} for c in spans.cells()]
                yield *head, total | {"cells": cells}
        yield from _batches(parsed(), kinds, lambda r: sum(len(c["audit"]) for c in r[4]["cells"] if c))

    columns = [*ORDER, "blank", "cut", "n", "first"]
    return (marked.select(*columns).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
            .mapInArrow(run, f"conv_id long, turn long, role string, digest binary, segment {SEGMENT}"))


# --- repair ------------------------------------------------------------------------------------------------------------


def _edits(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired rows, from the rows (role, text) in order."""
    goal = targets(audit)
    for edit in audit:
        if edit == "I":
            yield edit, ROLES[next(goal)], ""
            continue
        role, text = next(rows)
        if edit == "K":
            next(goal)
            yield edit, role, text
        elif edit == "R":
            yield edit, ROLES[next(goal)], text


def _report(parts: list[dict]) -> dict:
    """gaps, counts, cost and audit of a conversation from its segments."""
    if not parts:
        return dict.fromkeys(_COUNTS, 0) | {"gaps": 0, "cost": 0, "audit": ""}
    spans, total = Spans(), None
    for p in parts:
        spans.span([c and (c["cost"], c["audit"]) for c in p["cells"]])
        total = p if total is None else _joined(total, p)
    cost, audit = best(spans.cells())
    gaps = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
    return total | {"gaps": gaps, "cost": cost, "audit": audit}


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _streams(turns: DataFrame, every: DataFrame | None) -> DataFrame:
    """Per conversation, in order: its id (kind 0), its segments (1) and its rows with texts (2)."""
    found = staged(segments(staged(marks(turns), "repair-marks")), "repair-segments")
    none = lambda kind: F.lit(None).cast(kind)
    shape = found.schema["segment"].dataType
    rows = _plain(turns).select("conv_id", F.lit(2).alias("kind"), "turn", "role", "digest", none(shape).alias("segment"), "text")
    parts = found.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "segment", none("string").alias("text"))
    ids = (every if every is not None else turns).select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("binary").alias("digest"),
        none(shape).alias("segment"), none("string").alias("text"))
    return (ids.unionAll(parts).unionAll(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
            .select("conv_id", "kind", "segment", "role", "text"))


def _conversations(batches) -> Iterator[tuple]:
    """(conv_id, report, edits) of each conversation of a sorted stream; edits must be read before the next one."""
    for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
        parts, ahead = [], None
        for row in rows:
            if row[1] == 2:
                ahead = row
                break
            if row[1] == 1:
                parts.append(row[2])
        report = _report(parts)

        def texts(ahead=ahead, rows=rows):
            if ahead is not None:
                yield ahead[3], ahead[4]
                for row in rows:
                    yield row[3], row[4]
        yield conv, report, _edits(report["audit"], texts())


def repair(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired rows of all conversations of ``turns(conv_id, turn, role, text)``.

    Rows are taken by turn, nulls first, ties by role and the SHA-256 of the
    text; null roles and texts are one blank. ``edit`` is K, R or I.
    Conversations that lose all rows, or are only in ``every(conv_id)``, have
    no row here but one in ``reports``. Null ids are one conversation; other
    columns are not read; an empty table gives an empty one.
    """
    streams = _streams(turns, every)
    kinds = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                       ("text", pa.string())])

    def run(batches):
        rows = ((conv, i, *e) for conv, _, edits in _conversations(batches) for i, e in enumerate(edits))
        yield from _batches(rows, kinds, lambda r: len(r[4]))

    return streams.mapInArrow(run, "conv_id long, position long, edit string, role string, text string")


def reports(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    Counts are over the rows of ``turns``, the digest is over the repaired
    rows of ``repair`` as ``role:text`` joined by newlines. Conversations that
    are only in ``every(conv_id)`` have zeros, an empty audit and the digest
    of the empty text.
    """
    streams = _streams(turns, every)
    kinds = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in REPORT), ("audit", pa.string()),
                       ("repaired_sha256", pa.string())])

    def run(batches):
        def digested():
            for conv, report, edits in _conversations(batches):
                digest = hashlib.sha256()
                for i, (_, role, text) in enumerate(edits):
                    digest.update((("\n" if i else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                yield conv, *(report[c] for c in REPORT), report["audit"], digest.hexdigest()
        yield from _batches(digested(), kinds, lambda r: len(r[-2]))

    return streams.mapInArrow(run, "conv_id long, " + ", ".join(f"{c} long" for c in REPORT) + ", audit string, repaired_sha256 string")
