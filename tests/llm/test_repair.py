import hashlib
import random
import re
from itertools import product
from zlib import crc32

from maskcorpus.llm import repair as R

GOAL = re.compile(r"(s?(ua)+)?\Z")


def slow_best(rows):
    """Cheapest (cost, audit) of rows (initial, fault) over all edit sequences: row by row, all results of up to len + 4 roles."""
    most = len(rows) + 4
    goals = [""] + ["ua" * i for i in range(1, most // 2 + 1)] + ["s" + "ua" * i for i in range(1, most // 2 + 1)]
    out = []
    for goal in goals:
        # edit distance by (rows read, goal letters written)
        table = {(0, 0): (0, "")}
        for i, j in product(range(len(rows) + 1), range(len(goal) + 1)):
            options = []
            if i:
                initial, fault = rows[i - 1]
                if (i - 1, j) in table:
                    options.append((table[i - 1, j], 4, "D"))
                if j and (i - 1, j - 1) in table and fault not in ("blank", "duplicate"):
                    more = 3 if fault == "truncated" else 0
                    if initial == goal[j - 1]:
                        options.append((table[i - 1, j - 1], more, "K"))
                    if goal[j - 1] in "ua":
                        options.append((table[i - 1, j - 1], 3 + more, "R"))
            if j and goal[j - 1] in "ua" and (i, j - 1) in table:
                options.append((table[i, j - 1], 3, "I"))
            if options:
                table[i, j] = min((c + d, a + x) for (c, a), d, x in options)
        if (len(rows), len(goal)) in table:
            out.append(table[len(rows), len(goal)])
    return min(out)


def slow_damaged(rows):
    out, text = [], lambda v: " " if v is None else str(v)
    for conv, turn, role, said in rows:
        kind = crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, said = text(role), text(said)
        if kind:
            said = "" if kind == 1 else re.sub("[.!?]", "", said) if kind == 2 else said
            out += [(conv, turn, "user" if kind == 4 else role, said)] * (2 if kind == 3 else 1)
    return out


def slow_report(rows):
    """All columns but the id of one conversation's rows (turn, role, text)."""
    sha = lambda t: hashlib.sha256(t.encode())
    rows = sorted(((t, r or (" " if r is None else ""), x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2]).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit = slow_best([(r[1][:1], f) for r, f in zip(rows, faults)]) if rows else (0, "")
    n = len(audit) - audit.count("D")
    goal = ("s" if n % 2 else "") + "ua" * (n // 2)
    left, lines = iter(rows), []
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit != "D":
            c = goal[len(lines)]
            name = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[c]
            assert name[:1] == c
            lines.append(f"{name}:{row[2] if row else ''}")
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines)).hexdigest())


def test_parse_against_edit_distance():
    rng = random.Random(9)
    for _ in range(1500):
        rows = [(rng.choice("suat"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(0, 9))]
        spans = R.Spans()
        for initial, fault in rows:
            spans.row(initial, fault)
        assert R.best(spans.cells()) == slow_best(rows), rows
        # any split gives the same cells
        at = rng.randint(0, len(rows))
        left, right = R.Spans(), R.Spans()
        for part, some in ((left, rows[:at]), (right, rows[at:])):
            for row in some:
                part.row(*row)
        assert R.combine(left.cells(), right.cells()) == spans.cells()


def test_identical_rows_at_once():
    for fault in ("blank", "duplicate"):
        one, many = R.Spans(), R.Spans()
        one.row("u", "")
        many.row("u", "")
        for _ in range(37):
            one.row("a", fault)
        many.row("a", fault, 37)
        assert one.cells() == many.cells()


def test_language_and_rules():
    assert all(GOAL.match("".join(R.targets(a))) for a in ("", "D", "KK", "KKK", "IKDRI", "KKKKD"))
    assert len(R.PAIRS) == 11 and len(R.RULES) == 26
    cells = R.row_cells("u", "truncated")
    assert R.best(cells) == (4, "D") and R.best(R.row_cells("u", "")) == (3, "KI") and R.best(R.row_cells("s", "")) == (4, "D")


def conversations(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", "Why?", "Go on!  ", "Fine. And", None, "é漢.", "Wait.\x0b", "a "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in [*range(n), None]:
        for i in range(rng.randint(1, 9)):
            turn = rng.choice([i, i, i, i, i + rng.randint(0, 3), None])
            rows.append((conv, turn, rng.choice(roles if rng.random() < 0.4 else roles[i % 2:i % 2 + 1]), rng.choice(texts) if rng.random() < 0.5 else f"Text {i}."))
    return rows


def compare(spark, rows, damage):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, kind string, n int")
    turns = R.damaged(df) if damage else df
    by = {c: [] for c, *_ in rows}
    for c, *rest in (slow_damaged(rows) if damage else rows):
        by[c].append(rest)
    got = {r[0]: tuple(r)[1:] for r in R.reports(turns, df).collect()}
    assert got == {c: slow_report(v) for c, v in by.items()}
    return df, turns, got


def test_rows_through_spark(spark):
    rows = conversations(1, 120)
    rows += [(5000 + i, None, "user", "the same.") for i in range(3)] + [(6000, t, "user", "Hello.") for t in (1, 1, 1, 5, None, None)]
    df, turns, got = compare(spark, rows, False)
    assert max(r[5] for r in got.values()) > 20
    text = {}
    for r in sorted(R.repair(turns).collect(), key=lambda r: (str(r[0]), r[1])):
        text.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    digest = {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in text.items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(v[-1] == digest.get(c, empty) for c, v in got.items())


def test_damage(spark):
    rows = conversations(2, 300)
    _, _, got = compare(spark, rows, True)
    assert any(v[-2] == "" for v in got.values())


def test_long_conversation_is_cut_between_tasks(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", "No", f"Turn {t}.", f"{t}"])) for t in range(90)]
    rows += [(0, 0, "user", "Hi."), (2, 0, "user", "Bye.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = R.segments(R.marks(df)).groupBy("conv_id").count().collect()
        got = {r[0]: tuple(r)[1:] for r in R.reports(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert dict(map(tuple, parts))[1] > 2
    assert got == {c: slow_report([r[1:] for r in rows if r[0] == c]) for c in (0, 1, 2)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.reports(R.damaged(df), df).collect() == [] and R.repair(df).collect() == []


def test_query_against_brute_force(spark):
    from maskcorpus.llm.queries import op13_conversation_repair
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by = {c: [] for c, *_ in rows}
    for c, *rest in slow_damaged(rows):
        by[c].append(rest)
    got = {r[0]: tuple(r)[1:] for r in op13_conversation_repair(spark, "/root/testdata/sf0.01").collect()}
    assert got == {c: slow_report(v) for c, v in by.items()}
