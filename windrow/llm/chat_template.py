"""A small sandboxed template language for conversations.

``{{ expression }}``, ``{% for x in list %}``, ``{% if %} {% elif %} {% else %}``,
``{% set x = expression %}``, ``{% generation %}`` (what a model is to learn) and ``{# comment #}``;
a ``-`` inside a mark strips the white space beside it. Expressions have texts, whole numbers,
``true false none``, names, ``x.key`` and ``x["key"]``, filters, ``~`` and ``+`` (both join texts),
comparisons, ``in``, ``not``, ``and`` and ``or``.

Source is parsed to a tree, what is known beforehand is folded, and the tree becomes Python
closures; no code is generated as text. Templates reach only the names they are compiled with, keys
of mappings and the given filters: there are no calls, no Python attributes and no unbounded loops.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

MAX_SOURCE, MAX_DEPTH = 100_000, 50
Filters = Mapping[str, Callable[[Any], Any]]
Scope = dict[str, Any]
#: A rendered stretch and whether it is to be learnt; None stands at the end of each round of an
#: outermost loop, where output may be cut.
Piece = tuple[str, bool] | None


class TemplateError(ValueError):
    pass


# --- Tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """A filter on one value."""

    name: str
    to: Any


@dataclass(frozen=True)
class Operation:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Not:
    of: Any


@dataclass(frozen=True)
class Output:
    of: Any


@dataclass(frozen=True)
class Set:
    name: str
    to: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class If:
    cases: tuple
    otherwise: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


# --- Parsing

_MARK = re.compile(r"(\{\{-?|\{%-?|\{#-?)(.*?)(-?\}\}|-?%\}|-?#\})", re.S)
_CLOSING = {"{{": "}}", "{%": "%}", "{#": "#}"}
_TOKEN = re.compile(
    r"""\s*(?:(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<word>[A-Za-z_]\w*)"""
    r"""|(?P<sign>==|!=|<=|>=|[<>~+|.()\[\]=]))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
_WORDS = {"true": True, "false": False, "none": None}
_COMPARE = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le,
    ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b,
}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        found = _TOKEN.match(source, at)
        if not found or found.end() == at:
            raise TemplateError(f"cannot read {source[at : at + 20]!r}")
        out.append((found.lastgroup, found[found.lastgroup]))
        at = found.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one mark."""

    def __init__(self, source: str):
        self.tokens, self.at, self.depth = _tokens(source), 0, 0

    def peek(self, *values: str) -> bool:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        return kind in ("word", "sign") and value in values

    def take(self, *values: str) -> bool:
        found = self.peek(*values)
        self.at += found
        return found

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def word(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind != "word":
            raise TemplateError(f"a name is missing before {value!r}")
        self.at += 1
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} was not expected")

    def whole(self):
        found = self.either()
        self.end()
        return found

    def either(self):
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("expressions are nested too deeply")
        left = self.both()
        while self.take("or"):
            left = Operation("or", left, self.both())
        self.depth -= 1
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Operation("and", left, self.negated())
        return left

    def negated(self):
        negations = 0
        while self.take("not"):
            negations += 1
        found = self.compared()
        return Not(found) if negations % 2 else Not(Not(found)) if negations else found

    def compared(self):
        left = self.joined()
        for op in _COMPARE:
            if self.take(op):
                return Operation(op, left, self.joined())
        return left

    def joined(self):
        left = self.filtered()
        while self.peek("~", "+"):
            self.at += 1
            left = Operation("~", left, self.filtered())
        return left

    def filtered(self):
        found = self.place()
        while self.take("|"):
            found = Apply(self.word(), found)
        return found

    def place(self):
        found = self.atom()
        while self.peek(".", "["):
            if self.take("."):
                found = Get(found, Const(self.word()))
            else:
                self.need("[")
                found = Get(found, self.either())
                self.need("]")
        return found

    def atom(self):
        if self.take("("):
            found = self.either()
            self.need(")")
            return found
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind not in ("text", "number", "word"):
            raise TemplateError(f"a value is missing before {value!r}")
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        return Const(_WORDS[value]) if value in _WORDS else Name(value)


def _pieces(source: str) -> list[tuple[str, str]]:
    """("text" | "{{" | "{%", content) in order, white space stripped where marks say so."""
    out, at, strip = [], 0, False
    for mark in _MARK.finditer(source):
        opening, content, closing = mark.groups()
        if closing.lstrip("-") != _CLOSING[opening.rstrip("-")]:
            raise TemplateError(f"{opening} is closed by {closing}")
        text = source[at : mark.start()]
        text = text.lstrip() if strip else text
        out.append(("text", text.rstrip() if opening.endswith("-") else text))
        if opening[:2] != "{#":
            out.append((opening[:2], content))
        at, strip = mark.end(), closing.startswith("-")
    rest = source[at:]
    out.append(("text", rest.lstrip() if strip else rest))
    return [p for p in out if p[0] != "text" or p[1]]


class _Parser:
    def __init__(self, source: str):
        if len(source) > MAX_SOURCE:
            raise TemplateError("the template is too long")
        self.pieces, self.at = _pieces(source), 0

    def whole(self) -> tuple:
        body, closing = self.body(0)
        if closing:
            raise TemplateError(f"{closing!r} closes nothing")
        return body

    def body(self, depth: int) -> tuple[tuple, str]:
        """Statements up to a word that closes or goes on, which is returned with its rest."""
        if depth > MAX_DEPTH:
            raise TemplateError("blocks are nested too deeply")
        out = []
        while self.at < len(self.pieces):
            kind, content = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                out.append(Output(Const(content)))
            elif kind == "{{":
                out.append(Output(_Expression(content).whole()))
            else:
                word, rest = (content.strip().split(None, 1) + ["", ""])[:2]
                if word in ("elif", "else", "endif", "endfor", "endgeneration"):
                    return tuple(out), content.strip()
                out.append(self.statement(word, rest, depth))
        return tuple(out), ""

    def statement(self, word: str, rest: str, depth: int):
        if word == "set":
            inside = _Expression(rest)
            name = inside.word()
            inside.need("=")
            return Set(name, inside.whole())
        if word == "generation" and not rest:
            return Generation(self.closed(depth, "endgeneration"))
        if word == "for":
            inside = _Expression(rest)
            name = inside.word()
            inside.need("in")
            return For(name, inside.whole(), self.closed(depth, "endfor"))
        if word == "if":
            cases, test = [], rest
            while True:
                body, closing = self.body(depth + 1)
                cases.append((_Expression(test).whole(), body))
                if closing.startswith("elif"):
                    test = closing[4:]
                elif closing == "else":
                    return If(tuple(cases), self.closed(depth, "endif"))
                elif closing == "endif":
                    return If(tuple(cases), ())
                else:
                    raise TemplateError("endif is missing")
        raise TemplateError(f"unknown statement {word!r}")

    def closed(self, depth: int, by: str) -> tuple:
        body, closing = self.body(depth + 1)
        if closing != by:
            raise TemplateError(f"{by} is missing")
        return body


# --- Folding


def _text(value: Any) -> str:
    if isinstance(value, str):
        return value
    if value is None or isinstance(value, (bool, int)):
        return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)
    raise TemplateError("only texts, numbers, truth values and none can be written")


def _operate(op: str, left: Any, right: Any) -> Any:
    if op == "~":
        return _text(left) + _text(right)
    try:
        return _COMPARE[op](left, right)
    except TypeError as error:
        raise TemplateError(f"{op!r} does not fit its values") from error


def _item(of: Any, key: Any) -> Any:
    """Missing keys are none; nothing but mappings has keys."""
    if not isinstance(of, Mapping):
        raise TemplateError("only mappings have keys")
    return of.get(key)


class _Folder:
    def __init__(self, known: Mapping[str, Any], free: frozenset[str], filters: Filters):
        self.known, self.filters = dict(known), filters
        self.names = set(free)

    def expression(self, e):
        match e:
            case Const():
                return e
            case Name(name):
                if name in self.names:
                    return e
                if name in self.known:
                    return Const(self.known[name])
                raise TemplateError(f"unknown name {name!r}")
            case Get(of, key):
                of, key = self.expression(of), self.expression(key)
                fixed = isinstance(of, Const) and isinstance(key, Const)
                return Const(_item(of.value, key.value)) if fixed else Get(of, key)
            case Apply(name, to):
                if name not in self.filters:
                    raise TemplateError(f"unknown filter {name!r}")
                to = self.expression(to)
                return Const(self.filters[name](to.value)) if isinstance(to, Const) else Apply(name, to)
            case Not(of):
                of = self.expression(of)
                return Const(not of.value) if isinstance(of, Const) else Not(of)
            case Operation(op, left, right):
                left, right = self.expression(left), self.expression(right)
                if op in ("and", "or"):
                    if not isinstance(left, Const):
                        return Operation(op, left, right)
                    return right if bool(left.value) == (op == "and") else left
                if isinstance(left, Const) and isinstance(right, Const):
                    return Const(_operate(op, left.value, right.value))
                return Operation(op, left, right)
        raise TemplateError(f"unknown expression {e!r}")

    def body(self, statements: Iterable) -> tuple:
        out: list = []
        for statement in statements:
            for folded in self.statement(statement):
                last = out[-1] if out else None
                if _fixed(folded) and _fixed(last):
                    out[-1] = Output(Const(last.of.value + folded.of.value))
                elif not (_fixed(folded) and not folded.of.value):
                    out.append(folded)
        return tuple(out)

    def inner(self, statements: Iterable, *names: str) -> tuple:
        """A loop's body: names set in it end with it."""
        before = set(self.names)
        self.names.update(names)
        folded = self.body(statements)
        self.names = before
        return folded

    def statement(self, s) -> tuple:
        match s:
            case Output(of):
                of = self.expression(of)
                return (Output(Const(_text(of.value))) if isinstance(of, Const) else Output(of),)
            case Set(name, to):
                to = self.expression(to)
                self.names.add(name)
                return (Set(name, to),)
            case Generation(body):
                return (Generation(self.body(body)),)
            case For(name, over, body):
                return (For(name, self.expression(over), self.inner(body, name, "loop")),)
            case If(cases, otherwise):
                left = []
                for test, body in cases:
                    test = self.expression(test)
                    if isinstance(test, Const):
                        if test.value:
                            otherwise = body
                            break
                        continue
                    left.append((test, self.body(body)))
                rest = self.body(otherwise)
                return (If(tuple(left), rest),) if left else rest
        raise TemplateError(f"unknown statement {s!r}")


def _fixed(s) -> bool:
    return isinstance(s, Output) and isinstance(s.of, Const)


# --- Closures


def _value(e, filters: Filters) -> Callable[[Scope], Any]:
    match e:
        case Const(value):
            return lambda scope: value
        case Name(name):
            return lambda scope: scope.get(name)
        case Get(of, key):
            of, key = _value(of, filters), _value(key, filters)
            return lambda scope: _item(of(scope), key(scope))
        case Apply(name, to):
            apply, to = filters[name], _value(to, filters)
            return lambda scope: apply(to(scope))
        case Not(of):
            of = _value(of, filters)
            return lambda scope: not of(scope)
        case Operation("and", left, right):
            left, right = _value(left, filters), _value(right, filters)
            return lambda scope: left(scope) and right(scope)
        case Operation("or", left, right):
            left, right = _value(left, filters), _value(right, filters)
            return lambda scope: left(scope) or right(scope)
        case Operation(op, left, right):
            left, right = _value(left, filters), _value(right, filters)
            return lambda scope: _operate(op, left(scope), right(scope))


Render = Callable[[Scope, bool], Iterator[Piece]]


def _sequence(statements: tuple, filters: Filters, depth: int) -> Render:
    steps = [_step(s, filters, depth) for s in statements]

    def render(scope: Scope, learnt: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope, learnt)

    return render


def _step(s, filters: Filters, depth: int) -> Render:
    match s:
        case Output(Const(value)):
            def fixed(scope: Scope, learnt: bool) -> Iterator[Piece]:
                yield value, learnt
            return fixed
        case Output(of):
            value = _value(of, filters)

            def output(scope: Scope, learnt: bool) -> Iterator[Piece]:
                yield _text(value(scope)), learnt
            return output
        case Set(name, to):
            value = _value(to, filters)

            def assign(scope: Scope, learnt: bool) -> Iterator[Piece]:
                scope[name] = value(scope)
                return iter(())
            return assign
        case Generation(body):
            inside = _sequence(body, filters, depth + 1)
            return lambda scope, learnt: inside(scope, True)
        case If(cases, otherwise):
            tests = [(_value(t, filters), _sequence(b, filters, depth + 1)) for t, b in cases]
            last = _sequence(otherwise, filters, depth + 1)

            def choose(scope: Scope, learnt: bool) -> Iterator[Piece]:
                return next((b for t, b in tests if t(scope)), last)(scope, learnt)
            return choose
        case For(name, over, body):
            return _loop(name, _value(over, filters), _sequence(body, filters, depth + 1), depth == 0)


def _loop(name: str, over: Callable[[Scope], Any], body: Render, outermost: bool) -> Render:
    """Holds one element ahead, so that a loop can run over a stream."""

    def loop(scope: Scope, learnt: bool) -> Iterator[Piece]:
        values = over(scope)
        if isinstance(values, (str, Mapping)) or not isinstance(values, Iterable):
            raise TemplateError("loops run over lists")
        rest, done = iter(values), object()
        index, here, before = 0, next(rest, done), None
        while here is not done:
            after = next(rest, done)
            about = {
                "index": index + 1, "first": index == 0, "last": after is done,
                "previous": before, "next": None if after is done else after,
            }
            yield from body({**scope, name: here, "loop": about}, learnt)
            if outermost:
                yield None
            index, before, here = index + 1, here, after

    return loop


def _uses(tree: Any, name: str) -> int:
    if isinstance(tree, Name):
        return int(tree.name == name)
    if isinstance(tree, tuple):
        return sum(_uses(t, name) for t in tree)
    return sum(_uses(v, name) for v in vars(tree).values()) if hasattr(tree, "__dict__") else 0


class Template:
    """A compiled template: ``render`` yields stretches with whether they are to be learnt.

    ``variables`` are the names given at rendering, ``constants`` those known now.
    """

    def __init__(
        self, source: str, variables: Iterable[str] = ("messages",),
        constants: Mapping[str, Any] | None = None, filters: Filters | None = None,
    ):
        filters = dict(filters or {})
        parsed = _Parser(source).whole()
        self.tree = _Folder(constants or {}, frozenset(variables), filters).body(parsed)
        self._render = _sequence(self.tree, filters, 0)

    def render(self, **given: Any) -> Iterator[Piece]:
        return self._render(dict(given), False)

    def in_one_pass(self, name: str) -> bool:
        """Whether ``name`` is used by one outermost loop alone, so that it may be a stream."""
        loops = sum(isinstance(s, For) and s.over == Name(name) for s in self.tree)
        return loops == _uses(self.tree, name) == 1
