"""Per-file Python kernel for the extraction job.

Runs inside ``mapInPandas`` tasks; Spark partitions and shuffles the files.
Uses the stdlib ``ast`` parser: a file that does not parse yields a
``syntax_error`` status instead of failing the job.

Reported values follow a concrete-syntax-tree view of the code:
* every ``def``/``async def`` (nested and methods included), in source order,
  text from the ``def`` keyword to the end of its body, decorators excluded;
* each function's ``if`` statements in pre-order, ``elif`` arms excluded;
* ``line`` is 1-based and relative to the function text;
* ``depth`` counts tree levels from the root of the re-parsed text: each
  enclosing body adds 2 (statement + block), an ``elif``/``else``/``except``/
  ``finally`` arm adds 3, a decorated definition adds 1, a ``case`` arm 4;
* the condition is the source between ``if`` and the header colon, outer
  parentheses kept, stripped.
"""

from __future__ import annotations

import ast
import re

_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)?")


#: What may stand between the keyword and its condition.
_LEAD = re.compile(r"\A(?:\\\r?\n|\s)+")


class _Source:
    """(lineno, UTF-8 byte column) -> character offset in the text."""

    def __init__(self, text: str):
        self.text = text
        self.starts = []
        self.lines = []
        pos = 0
        for m in _LINE.finditer(text):
            if m.start() == len(text) and self.starts:
                break
            self.starts.append(pos)
            self.lines.append(m.group(0))
            pos = m.end()

    def offset(self, lineno: int, col: int) -> int:
        line = self.lines[lineno - 1]
        return self.starts[lineno - 1] + len(line.encode("utf-8")[:col].decode("utf-8", "replace"))


def _is_elif(src: _Source, node: ast.If) -> bool:
    i = src.offset(node.lineno, node.col_offset)
    return src.text.startswith("elif", i)


def _condition(src: _Source, node: ast.If) -> str:
    text = src.text
    start = src.offset(node.lineno, node.col_offset) + 2
    j = end = src.offset(node.test.end_lineno, node.test.end_col_offset)
    while j < len(text):
        ch = text[j]
        if ch == ")":
            j += 1
            end = j
        elif ch in " \t\f\r\n\\":
            j += 1
        elif ch == "#":
            nl = text.find("\n", j)
            j = len(text) if nl < 0 else nl
        else:
            break
    # a line may be continued between the keyword and the condition
    return _LEAD.sub("", text[start:end]).strip()


def _collect(src: _Source, body, depth: int, out: list) -> None:
    """Pre-order walk of a statement list whose statements sit at ``depth``."""
    for st in body:
        if isinstance(st, ast.If):
            out.append((st, depth))
            _collect(src, st.body, depth + 2, out)
            cur = st
            while len(cur.orelse) == 1 and isinstance(cur.orelse[0], ast.If) and _is_elif(src, cur.orelse[0]):
                cur = cur.orelse[0]
                _collect(src, cur.body, depth + 3, out)
            _collect(src, cur.orelse, depth + 3, out)
        elif isinstance(st, (ast.For, ast.AsyncFor, ast.While)):
            _collect(src, st.body, depth + 2, out)
            _collect(src, st.orelse, depth + 3, out)
        elif isinstance(st, (ast.Try, getattr(ast, "TryStar", ast.Try))):
            _collect(src, st.body, depth + 2, out)
            for h in st.handlers:
                _collect(src, h.body, depth + 3, out)
            _collect(src, st.orelse, depth + 3, out)
            _collect(src, st.finalbody, depth + 3, out)
        elif isinstance(st, (ast.With, ast.AsyncWith)):
            _collect(src, st.body, depth + 2, out)
        elif isinstance(st, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            _collect(src, st.body, depth + (3 if st.decorator_list else 2), out)
        elif isinstance(st, ast.Match):
            for case in st.cases:
                _collect(src, case.body, depth + 4, out)


def _ifs(src: _Source, body, depth: int, first_line: int) -> list[tuple[str, int, int]]:
    found: list = []
    _collect(src, body, depth, found)
    return [(_condition(src, n), n.lineno - first_line + 1, d) for n, d in found]


def parse(code: str):
    try:
        return ast.parse(code), "ok"
    except (SyntaxError, ValueError):
        return None, "syntax_error"
    except (RecursionError, MemoryError):
        return None, "too_deep"


def extract_functions(code: str) -> tuple[str, list[dict]]:
    """``(status, functions)``; each function: ``code, conditions, lines_of_ifs, depths``."""
    tree, status = parse(code)
    if tree is None:
        return status, []
    src = _Source(code)
    defs = [n for n in ast.walk(tree) if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef))]
    defs.sort(key=lambda n: (n.lineno, n.col_offset))
    out = []
    for fn in defs:
        a = src.offset(fn.lineno, fn.col_offset)
        b = src.offset(fn.end_lineno, fn.end_col_offset)
        ifs = _ifs(src, fn.body, 3, fn.lineno)
        out.append({"code": code[a:b], "conditions": [c for c, _, _ in ifs],
                    "if_lines": [ln for _, ln, _ in ifs], "depths": [d for _, _, d in ifs]})
    return status, out


def extract_ifs(code: str) -> tuple[str, list[tuple[str, int, int]]]:
    """``(status, [(condition, line, depth)])`` for a whole text (module root = depth 0)."""
    tree, status = parse(code)
    if tree is None:
        return status, []
    return status, _ifs(_Source(code), tree.body, 1, 1)
