"""Chat formatting: templates are parsed into a syntax tree, folded, and compiled into Python closures.

The language has ``{{ expression }}``, ``{% for m in messages %}``, ``{% if %}``/``{% elif %}``/``{% else %}``,
``{% generation %}`` (text that training counts) and ``{# remark #}``. Expressions are strings, ``true``/``false``, the
loop's ``m.role``, ``m.text``, ``loop.first``, ``loop.index0``, ``==``, ``!=``, ``not``, ``and``, ``or``, ``~`` (join) and
``|`` with a named filter. There are no calls, no other names and no other attributes, so that a template cannot reach
anything. ``messages`` may be looped over once: messages stream through, and a conversation of any length needs the memory
of one message.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 20
BATCH_CHARS = 8 << 20

_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: each one, and each that looks like an escaped one, gets a backslash."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_line(text: str) -> str:
    """As ``escape``, and line ends become ``\\n`` so that the result is one line."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text), flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}

CHATML = (
    "{% for m in messages %}<|im_start|>{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


class TemplateError(ValueError):
    pass


# Syntax tree: expressions are Const, Name, Op and Filter; statements are Text, Output, If, For and Generation.
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    base: str
    attribute: str


@dataclass(frozen=True)
class Op:
    kind: str
    parts: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    of: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    variable: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'[^']*'|\"[^\"]*\")|(?P<op>==|!=|[~|().])|(?P<word>[A-Za-z_]\w*)|(?P<bad>\S))")
_WORDS = {"and", "or", "not", "true", "false", "in", "for", "if"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str, scope: frozenset[str]):
        self.tokens = [(m.lastgroup, m[m.lastgroup]) for m in _TOKEN.finditer(source.rstrip())]
        self.at, self.scope = 0, scope

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *wanted: str) -> bool:
        kind, value = self.peek()
        if kind != "str" and value in wanted:
            self.at += 1
            return True
        return False

    def whole(self):
        out = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return out

    def either(self):
        out = self.both()
        while self.take("or"):
            out = Op("or", (out, self.both()))
        return out

    def both(self):
        out = self.negated()
        while self.take("and"):
            out = Op("and", (out, self.negated()))
        return out

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        out = self.joined()
        for kind in ("==", "!="):
            if self.take(kind):
                return Op(kind, (out, self.joined()))
        return out

    def joined(self):
        out = self.filtered()
        while self.take("~"):
            out = Op("~", (out, self.filtered()))
        return out

    def filtered(self):
        out = self.atom()
        while self.take("|"):
            name = self.peek()[1]
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            self.at += 1
            out = Filter(name, out)
        return out

    def atom(self):
        kind, value = self.peek()
        self.at += 1
        if kind == "str":
            return Const(value[1:-1])
        if value == "(":
            out = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return out
        if kind == "word" and value in ("true", "false"):
            return Const(value == "true")
        if kind == "word" and value in self.scope:
            allowed = ("first", "index0") if value == "loop" else ("role", "text")
            if self.take(".") and self.peek()[1] in allowed:
                self.at += 1
                return Name(value, self.tokens[self.at - 1][1])
        raise TemplateError(f"not allowed here: {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _PIECE.finditer(source):
        pieces.append(("text", source[at : m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()) if m[2] is not None else ("text", ""))
        at = m.end()
    pieces.append(("text", source[at:]))
    stream, loops = iter(pieces), [0]

    def block(ends: tuple[str, ...], scope: frozenset[str]) -> tuple[tuple, str]:
        body: list = []
        for kind, value in stream:
            word = value.split(None, 1)[0] if kind == "tag" and value else ""
            if kind == "text":
                body.append(Text(value))
            elif kind == "out":
                body.append(Output(_Expression(value, scope).whole()))
            elif word in ends:
                return tuple(body), value
            elif word == "for":
                m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", value)
                if not m or m[1] in _WORDS | {"loop", "messages"} or loops[0]:
                    raise TemplateError(f"not allowed: {value!r}; messages are looped over once")
                loops[0] += 1
                body.append(For(m[1], block(("endfor",), scope | {m[1], "loop"})[0]))
            elif word == "if":
                body.append(branch(value[2:], scope))
            elif word == "generation":
                body.append(Generation(block(("endgeneration",), scope)[0]))
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(body), ""

    def branch(test: str, scope: frozenset[str]) -> If:
        then, end = block(("elif", "else", "endif"), scope)
        if end.startswith("elif"):
            other: tuple = (branch(end[4:], scope),)
        else:
            other = block(("endif",), scope)[0] if end == "else" else ()
        return If(_Expression(test, scope).whole(), then, other)

    return block((), frozenset())[0]


def _value(node, get: Callable[[Name], object]):
    match node:
        case Const(value):
            return value
        case Name():
            return get(node)
        case Filter(name, of):
            return FILTERS[name](_string(_value(of, get)))
        case Op("not", (a,)):
            return not _value(a, get)
        case Op("and", (a, b)):
            return _value(a, get) and _value(b, get)
        case Op("or", (a, b)):
            return _value(a, get) or _value(b, get)
        case Op("~", (a, b)):
            return _string(_value(a, get)) + _string(_value(b, get))
        case Op(kind, (a, b)):
            return (_value(a, get) == _value(b, get)) == (kind == "==")


def _string(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


class _NotConstant(Exception):
    pass


def fold(node):
    """The same tree with constant expressions worked out, decided branches taken and neighbouring texts joined."""

    def variable(_: Name):
        raise _NotConstant

    def expression(e):
        try:
            return Const(_value(e, variable))
        except _NotConstant:
            pass
        if isinstance(e, Op):
            return Op(e.kind, tuple(expression(p) for p in e.parts))
        return Filter(e.name, expression(e.of)) if isinstance(e, Filter) else e

    out: list = []
    for s in node:
        if isinstance(s, Output):
            s = Output(expression(s.of))
            s = Text(_string(s.of.value)) if isinstance(s.of, Const) else s
        if isinstance(s, If):
            test = expression(s.test)
            if isinstance(test, Const):
                parts = fold(s.then if test.value else s.other)
            else:
                parts = (If(test, fold(s.then), fold(s.other)),)
        elif isinstance(s, For):
            parts = (For(s.variable, fold(s.body)),)
        elif isinstance(s, Generation):
            parts = (Generation(fold(s.body)),)
        else:
            parts = (s,)
        for p in parts:
            if isinstance(p, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].value + p.value)
            elif not (isinstance(p, Text) and not p.value):
                out.append(p)
    return tuple(out)


#: What a closure yields: text and whether it is under a generation mark. CUT: here one message ends.
CUT = ("", None)


def generate(tree: tuple) -> Callable[[dict, bool], Iterator[tuple[str, bool | None]]]:
    """A closure per node; calling the outermost one renders, message by message."""

    def expression(e) -> Callable[[dict], object]:
        match e:
            case Const(value):
                return lambda env: value
            case Name(base, attribute):
                return lambda env: env[base][attribute]
            case Filter(name, of):
                inner, f = expression(of), FILTERS[name]
                return lambda env: f(_string(inner(env)))
            case Op("not", (a,)):
                one = expression(a)
                return lambda env: not one(env)
            case Op(kind, (a, b)):
                left, right = expression(a), expression(b)
                return {
                    "and": lambda env: left(env) and right(env),
                    "or": lambda env: left(env) or right(env),
                    "~": lambda env: _string(left(env)) + _string(right(env)),
                    "==": lambda env: left(env) == right(env),
                    "!=": lambda env: left(env) != right(env),
                }[kind]

    def statement(s):
        match s:
            case Text(value):
                return lambda env, mark: iter(((value, mark),))
            case Output(of):
                value_of = expression(of)
                return lambda env, mark: iter(((_string(value_of(env)), mark),))
            case Generation(body):
                inner = generate(body)
                return lambda env, mark: inner(env, True)
            case If(test, then, other):
                holds, yes, no = expression(test), generate(then), generate(other)
                return lambda env, mark: yes(env, mark) if holds(env) else no(env, mark)
            case For(variable, body):
                inner = generate(body)

                def loop(env: dict, mark: bool):
                    for i, message in enumerate(env["messages"]):
                        yield from inner(env | {variable: message, "loop": {"first": i == 0, "index0": i}}, mark)
                        yield CUT

                return loop

    parts = [statement(s) for s in tree]
    return lambda env, mark=False: itertools.chain.from_iterable(p(env, mark) for p in parts)


def compile_template(source: str) -> Callable[[dict, bool], Iterator[tuple[str, bool | None]]]:
    return generate(fold(parse(source)))


def render(template, messages, piece_chars: int = PIECE_CHARS) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Formatted text in pieces that end where a message ends, each with the spans that training counts."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    size, n = 0, 0
    for text, mark in template({"messages": messages}, False):
        if mark is None:
            if size >= piece_chars:
                yield "".join(parts), spans
                parts, spans, size, n = [], [], 0, n + 1
            continue
        if mark:
            spans.append((size, size + len(text)))
        parts.append(text)
        size += len(text)
    if parts or not n:
        yield "".join(parts), spans


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def format_conversations(turns: DataFrame, template: str = CHATML, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``(conv_id, piece, text, spans)``: every conversation in the order of its turns, formatted.

    A conversation of up to about ``piece_chars`` is one piece; a longer one goes on in further pieces, cut between messages,
    so that neither a task nor a row has to hold it. Null roles and texts are empty. Equal turns stand in the order of role
    and text; null turns first. Rows without ``conv_id`` form one conversation; repeated rows stay. The rows of one
    conversation stream through one task, since the order of a conversation is the point of it.
    """
    compile_template(template)  # a bad template fails here, not in the tasks
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        out: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            spans = [[{"start": a, "end": b} for a, b in x[3]] for x in out]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string()), pa.array(spans, kind)],
                names=["conv_id", "piece", "text", "spans"],
            )

        for conv, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            messages = ({"role": r[2], "text": r[3]} for r in group)
            for piece, (text, spans) in enumerate(render(compiled, messages, piece_chars)):
                out.append((conv, piece, text, spans))
                size += len(text)
                if size >= BATCH_CHARS:
                    yield batch()
                    out, size = [], 0
        if out:
            yield batch()

    return ordered.mapInArrow(run, "conv_id bigint, piece bigint, text string, spans array<struct<start: bigint, end: bigint>>")


def read_back(text: str, spans: list) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns and counted texts of one piece of CHATML, unescaped."""
    turns = [(unescape_line(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]
    return turns, [unescape(text[s["start"] : s["end"]]) for s in spans]


def digests(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``, read back from formatted pieces.

    Takes the pieces in the order in which ``format_conversations`` gives them, without another shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, pieces in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            whole, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, _, text, spans in pieces:
                turns, counted = read_back(text, spans)
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                for said in counted:
                    loss.update(said.encode())
                n, chars, size = n + len(turns), chars + sum(map(len, counted)), size + len(text)
            out.append((conv, n, whole.hexdigest(), chars, loss.hexdigest(), size))
            if len(out) >= 10_000:
                yield _digest_batch(out)
                out = []
        if out:
            yield _digest_batch(out)

    return formatted.mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))
