"""Chat formatting: a compiler for a small sandboxed template language, and its use on conversations.

A template is parsed into a syntax tree, constants are folded, and the tree is
turned into Python closures that yield pieces of text, each marked as
generated by the model or not. Templates reach nothing but the values given
to them: names, fields of mappings, a few filters, no calls and no attributes
of Python objects. Rendering streams, so a conversation of any length needs
the memory of one turn.

Syntax: ``{{ expression }}``, ``{% for x in list %}``, ``{% if %}``, ``{% elif %}``,
``{% else %}``, ``{% set x = expression %}``, ``{% generation %}``, ``{# comment #}``;
a ``-`` inside a tag strips white space next to it. Expressions: strings,
whole numbers, true, false, none, names, ``a.b``, ``a['b']``, ``not and or in``,
``== != < <= > >=``, ``+ ~``, filters after ``|``. Inside a loop, ``loop.index``,
``loop.index0``, ``loop.first`` and ``loop.last``.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TemplateError(ValueError):
    """The template has a syntax error, or uses a value that it may not use."""


# --- syntax tree ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Apply:
    """An operator or filter from the fixed tables below, applied to expressions."""

    table: str
    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    expr: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    expr: object


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


#: Eager operators; ``and`` and ``or`` are compiled with short cuts.
OPERATORS: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": lambda a, b: a in b, "not": operator.not_, "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: a + b if type(a) is type(b) and isinstance(a, (str, int)) else _refuse("+ takes two texts or two numbers"),
}
FILTERS: dict[str, Callable] = {
    "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(),
    "length": lambda v: len(v), "string": _text, "capitalize": lambda v: _text(v).capitalize(),
}
LITERALS = {"true": True, "false": False, "none": None}


def _refuse(why: str):
    raise TemplateError(why)


# --- parser --------------------------------------------------------------------------------------------------------

_TAG = re.compile(r"\{#.*?#\}|\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"can't read {source[at:at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one tag."""

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "~"))

    def __init__(self, source: str, filters: dict[str, Callable]):
        self.rest, self.filters = _tokens(source), filters

    def peek(self) -> str | None:
        return self.rest[0][1] if self.rest and self.rest[0][0] != "string" else None

    def take(self, want: str | None = None) -> tuple[str, str]:
        if not self.rest or want and self.peek() != want:
            raise TemplateError(f"expected {want or 'a value'}, found {self.rest[0][1] if self.rest else 'the end'!r}")
        return self.rest.pop(0)

    def whole(self):
        out = self.level(0)
        if self.rest:
            raise TemplateError(f"unexpected {self.rest[0][1]!r}")
        return out

    def level(self, k: int):
        if k == len(self.LEVELS):
            return self.filtered()
        if self.LEVELS[k] == ("not",):
            if self.peek() == "not":
                self.take()
                return Apply("op", "not", (self.level(k),))
            return self.level(k + 1)
        left = self.level(k + 1)
        while self.peek() in self.LEVELS[k]:
            left = Apply("op", self.take()[1], (left, self.level(k + 1)))
        return left

    def filtered(self):
        value = self.value()
        while self.peek() == "|":
            self.take()
            name = self.take()[1]
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            value = Apply("filter", name, (value,))
        return value

    def value(self):
        kind, word = self.take()
        if kind == "string":
            value = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        elif kind == "number":
            value = Const(int(word))
        elif kind == "name":
            value = Const(LITERALS[word]) if word in LITERALS else Name(word)
        elif word == "(":
            value = self.level(0)
            self.take(")")
        else:
            raise TemplateError(f"unexpected {word!r}")
        while self.peek() in (".", "["):
            if self.take()[1] == ".":
                kind, key = self.take()
                if kind != "name":
                    raise TemplateError("a field name must follow the dot")
                value = Item(value, Const(key))
            else:
                value = Item(value, self.level(0))
                self.take("]")
        return value


def parse(source: str, filters: dict[str, Callable] | None = None) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    filters = FILTERS if filters is None else filters
    parts, at, strip = [], 0, False
    for m in _TAG.finditer(source):
        text = source[at:m.start()]
        text = text.lstrip() if strip else text
        parts.append(("text", text.rstrip() if m[0][2] == "-" else text))
        strip, at = m[0][-3] == "-", m.end()
        if m[1] is not None or m[2] is not None:
            parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
    text = source[at:].lstrip() if strip else source[at:]
    if "{%" in text or "{{" in text:
        raise TemplateError("a tag isn't closed")
    parts.append(("text", text))
    parts.reverse()

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        out = []
        while parts:
            kind, body = parts.pop()
            if kind == "text":
                out.append(Text(body))
            elif kind == "out":
                out.append(Output(_Expression(body, filters).whole()))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return tuple(out), body
                out.append(statement(word, rest.strip()))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(out), ""

    def branch(test: str) -> If:
        then, end = block(("elif", "else", "endif"))
        if end.startswith("elif"):
            return If(_Expression(test, filters).whole(), then, (branch(end[4:]),))
        other = block(("endif",))[0] if end == "else" else ()
        return If(_Expression(test, filters).whole(), then, other)

    def statement(word: str, rest: str):
        if word == "if":
            return branch(rest)
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S) or _refuse(f"can't read for {rest!r}")
            return For(m[1], _Expression(m[2], filters).whole(), block(("endfor",))[0])
        if word == "set":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s*=(?!=)(.+)", rest, re.S) or _refuse(f"can't read set {rest!r}")
            return Assign(m[1], _Expression(m[2], filters).whole())
        if word == "generation" and not rest:
            return Generation(block(("endgeneration",))[0])
        raise TemplateError(f"no tag {word!r}")

    return block(())[0]


# --- constant folding ----------------------------------------------------------------------------------------------


def fold(node, filters: dict[str, Callable] | None = None):
    """The tree with constant expressions evaluated, decided branches cut and neighbouring texts joined."""
    filters = FILTERS if filters is None else filters
    go = lambda n: fold(n, filters)
    if isinstance(node, tuple):
        out = []
        for n in map(go, node):
            for x in n if isinstance(n, tuple) else (n,):
                if isinstance(x, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].text + x.text)
                elif not isinstance(x, Text) or x.text:
                    out.append(x)
        return tuple(out)
    if isinstance(node, Apply):
        args = tuple(map(go, node.args))
        if node.table == "op" and node.name in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
        if all(isinstance(a, Const) for a in args) and node.name not in ("and", "or"):
            run = (OPERATORS if node.table == "op" else filters)[node.name]
            try:
                return Const(run(*(a.value for a in args)))
            except (TypeError, TemplateError):
                pass  # the error belongs to rendering, where the expression may never be reached
        return Apply(node.table, node.name, args)
    if isinstance(node, Item):
        return Item(go(node.of), go(node.key))
    if isinstance(node, Output):
        expr = go(node.expr)
        return Text(_text(expr.value)) if isinstance(expr, Const) else Output(expr)
    if isinstance(node, If):
        test = go(node.test)
        if isinstance(test, Const):
            return go(node.then if test.value else node.other)
        return If(test, go(node.then), go(node.other))
    if isinstance(node, For):
        return For(node.name, go(node.items), go(node.body))
    if isinstance(node, Assign):
        return Assign(node.name, go(node.expr))
    if isinstance(node, Generation):
        return Generation(go(node.body))
    return node


# --- closures ------------------------------------------------------------------------------------------------------


def _value(node, filters) -> Callable[[dict], object]:
    """A closure from the variables to the expression's value."""
    if isinstance(node, Const):
        return lambda scope: node.value
    if isinstance(node, Name):
        return lambda scope: scope[node.name] if node.name in scope else _refuse(f"no value {node.name!r}")
    if isinstance(node, Item):
        of, key = _value(node.of, filters), _value(node.key, filters)

        def item(scope):
            box, k = of(scope), key(scope)
            if not isinstance(box, dict):
                raise TemplateError(f"{k!r} of something that is no mapping")
            return box.get(k)
        return item
    args = [_value(a, filters) for a in node.args]
    if node.table == "op" and node.name in ("and", "or"):
        a, b = args
        return (lambda scope: a(scope) and b(scope)) if node.name == "and" else (lambda scope: a(scope) or b(scope))
    run = (OPERATORS if node.table == "op" else filters)[node.name]
    if len(args) == 1:
        one = args[0]
        return lambda scope: run(one(scope))
    a, b = args
    return lambda scope: run(a(scope), b(scope))


def _last_known(items: Iterable) -> Iterator[tuple[object, bool]]:
    """Items with whether they are the last, one item ahead."""
    it = iter(items)
    for now in it:
        for ahead in it:
            yield now, False
            now = ahead
        yield now, True


def _statements(nodes: tuple, filters, generated: bool) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    """A closure from the variables to pieces (text, generated)."""
    steps = []
    for node in nodes:
        if isinstance(node, Text):
            steps.append(lambda scope, text=node.text: iter(((text, generated),)))
        elif isinstance(node, Output):
            steps.append(lambda scope, run=_value(node.expr, filters): iter(((_text(run(scope)), generated),)))
        elif isinstance(node, Generation):
            steps.append(_statements(node.body, filters, True))
        elif isinstance(node, If):
            test, then, other = _value(node.test, filters), _statements(node.then, filters, generated), _statements(node.other, filters, generated)
            steps.append(lambda scope, test=test, then=then, other=other: (then if test(scope) else other)(scope))
        elif isinstance(node, Assign):
            def assign(scope, name=node.name, run=_value(node.expr, filters)):
                scope[name] = run(scope)
                return iter(())
            steps.append(assign)
        else:
            def loop(scope, name=node.name, items=_value(node.items, filters), body=_statements(node.body, filters, generated)):
                for i, (item, last) in enumerate(_last_known(items(scope))):
                    state = {"index": i + 1, "index0": i, "first": i == 0, "last": last}
                    yield from body({**scope, name: item, "loop": state})
            steps.append(loop)

    def run(scope):
        for step in steps:
            yield from step(scope)
    return run


@dataclass
class Template:
    """A compiled template. ``controls`` are strings with a meaning in its output; the filter ``escape`` defuses them."""

    source: str
    controls: tuple[str, ...] = ()
    tree: tuple = field(init=False)

    def __post_init__(self):
        self.escape, self.unescape = escaping(self.controls)
        filters = {**FILTERS, "escape": lambda v: self.escape(_text(v))}
        self.tree = fold(parse(self.source, filters), filters)
        self._run = _statements(self.tree, filters, False)

    def pieces(self, **values) -> Iterator[tuple[str, bool]]:
        """The text in pieces, each with whether it lies under the generation mark."""
        return self._run(dict(values))

    def render(self, **values) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and the spans (start, end) under the generation mark."""
        text, spans = _joined(list(self.pieces(**values)))
        return text, spans


def escaping(controls: tuple[str, ...]) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """A backslash goes before every backslash and behind the first character of every control string.

    So no control string stands whole in an escaped text, where a tokenizer
    might take it for its special token. The second function takes the
    backslashes away again.
    """
    special = re.compile("|".join(map(re.escape, ("\\", *sorted(controls, key=len, reverse=True)))))
    marked = re.compile(r"\\(.)", re.S)

    def broken(m: re.Match) -> str:
        return f"{m[0][0]}\\{m[0][1:]}" if len(m[0]) > 1 else "\\" + m[0]
    return (lambda text: special.sub(broken, text)), (lambda text: marked.sub(r"\1", text))


def _joined(pieces: list[tuple[str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    spans, at = [], 0
    for text, generated in pieces:
        if generated and text:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        at += len(text)
    return "".join(t for t, _ in pieces), spans


@lru_cache(maxsize=16)
def compiled(source: str, controls: tuple[str, ...]) -> Template:
    """The template of this process, compiled once."""
    return Template(source, controls)


# --- conversations -------------------------------------------------------------------------------------------------

#: The production template: control strings around role and text; an assistant's text is generated.
TURN, BODY, END = "<turn>", "<text>", "</turn>"
CONTROLS = (TURN, BODY, END)
TURNS = (
    "{% for m in messages %}" + TURN + "{{ m.role | escape }}" + BODY
    + "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    + "{% else %}{{ m.text | escape }}{% endif %}" + END + "\n{% endfor %}"
)
#: Characters of a formatted conversation that go into one row; a longer one continues in further rows.
PART_CHARS = 1_000_000
FORMATTED = "conv_id long, part int, text string, loss array<struct<start: int, end: int>>"
_ROWS = 500


def _rows(batches, columns: list[str]) -> Iterator[dict]:
    for batch in batches:
        # one row at a time: a batch of long texts is not held twice
        for values in zip(*((v.as_py() for v in c) for c in batch.columns)):
            yield dict(zip(columns, values))


def _batched(rows: Iterator[tuple], schema: pa.Schema, weight: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Record batches of at most _ROWS rows, or fewer when they are heavy."""
    held, load = [], 0
    for row in rows:
        held.append(row)
        load += weight(row)
        if len(held) >= _ROWS or load >= 4 * PART_CHARS:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)
            held, load = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)


def _parts(pieces: Iterator[tuple[str, bool]], limit: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    held, size = [], 0
    for text, generated in pieces:
        for at in range(0, len(text), limit):
            held.append((text[at:at + limit], generated))
            size += len(held[-1][0])
            if size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def format_conversations(turns: DataFrame, template: str = TURNS, controls: tuple[str, ...] = CONTROLS,
                         part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, text, loss): every conversation of ``turns(conv_id, turn, role, text)`` under a template.

    A conversation's rows are sorted by turn (nulls first), then role and text,
    so ties have one order; repeated rows are repeated turns. Null roles and
    texts are empty; rows without a conv_id form one conversation. ``loss``
    has the spans of code points under the generation mark. Turns stream
    from a sort, and a conversation longer than ``part_chars`` continues in
    the next part, so memory is bounded by the longest turn. Extra columns
    are not read; an empty table gives an empty one.
    """
    Template(template, controls)  # syntax errors show here, not in a task
    rows = (turns.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", pa.list_(span))])

    def run(batches):
        made = compiled(template, controls)

        def parts():
            for conv, messages in groupby(_rows(batches, ["conv_id", "turn", "role", "text"]), key=lambda r: r["conv_id"]):
                for k, (text, spans) in enumerate(_parts(made.pieces(messages=messages), part_chars)):
                    yield conv, k, text, [{"start": a, "end": b} for a, b in spans]
        yield from _batched(parts(), schema, lambda r: len(r[2]))

    return rows.mapInArrow(run, FORMATTED)


_MARK = re.compile(r"\\(.)|" + "|".join(map(re.escape, CONTROLS)), re.S)
#: What may be the start of an escape or a control string at the end of a part; no control string has a longer name.
_CUT = re.compile(rf"(?:\\|</?[a-z]{{0,{max(map(len, CONTROLS)) - 2}}})\Z")


class Reader:
    """Reads the production template's output back, part by part: digests of the turns and of the text under the mask."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.rest = self.loss_rest = ""
        self.inside = False

    def part(self, text: str, loss: list[dict]) -> None:
        self.chars += len(text)
        under = self.loss_rest + "".join(text[s["start"]:s["end"]] for s in loss)
        odd = (len(under) - len(under.rstrip("\\"))) % 2
        self.loss_rest = under[len(under) - odd:]
        plain = re.sub(r"\\(.)", r"\1", under[: len(under) - odd], flags=re.S)
        self.loss_chars += len(plain)
        self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self._turns(self.rest + text)

    def _turns(self, text: str) -> None:
        at, out = 0, []
        for m in _MARK.finditer(text):
            if self.inside:
                out.append(text[at:m.start()])
            if m[1] is not None:
                out.append(m[1])
            elif m[0] == TURN:  # what stands before it is the template's line end
                self.n_turns += 1
                self.inside = True
            else:
                out.append("\n")
                self.inside = m[0] == BODY
            at = m.end()
        cut = _CUT.search(text, at)
        stop = cut.start() if cut else len(text)
        if self.inside:
            out.append(text[at:stop])
        self.rest = text[stop:]
        self.turns.update("".join(out).encode("utf-8", "surrogatepass"))

    def done(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """n_turns, digests of the turns and of the masked text, and sizes, read from the output of the production template."""
    rows = (formatted.select("conv_id", "part", "text", "loss")
            .repartition("conv_id").sortWithinPartitions("conv_id", "part"))
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
             "loss_sha256": pa.string(), "formatted_chars": pa.int64()}

    def run(batches):
        def read():
            for conv, parts in groupby(_rows(batches, ["conv_id", "part", "text", "loss"]), key=lambda r: r["conv_id"]):
                reader = Reader()
                for p in parts:
                    reader.part(p["text"], p["loss"])
                yield conv, *reader.done()
        yield from _batched(read(), pa.schema(kinds), lambda r: 1)

    return rows.mapInArrow(run, READ)
