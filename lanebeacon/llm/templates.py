"""A small template language, compiled to Python closures.

    text {{ expression }} {% if e %} {% elif e %} {% else %} {% endif %}
    {% for name in e %} {% else %} {% endfor %} {% set name = e %}
    {% generation %} {% endgeneration %} {# comment #}

A ``-`` inside a tag's border strips blanks on that side. Expressions have strings, whole numbers, ``true false
none``, lists, names, ``a.b``, ``a['b']``, ``a[0]``, ``or and not``, ``in``, comparisons, ``~`` (joins texts), ``+ - * // %``,
``a if b else c`` and filters ``a | name(b)``.

Templates are sandboxed. A dot or bracket looks up a key of a mapping or a place of a list and nothing else, so no
attribute of a Python object is ever reached; only the filters given can be called; numbers stay within 64
bits and texts are not multiplied; loops run over given lists. A template is parsed to a tree, in which
constant parts are folded, and every node of it becomes one closure.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

Filter = Callable[..., Any]
MOST_NESTED = 50
MOST_NUMBER = 1 << 63


class TemplateError(ValueError):
    """The template cannot be compiled, or not rendered for what it is given."""


# The syntax tree.


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Lookup:
    of: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    op: str
    value: Any


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Choice:
    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Items:
    values: tuple


@dataclass(frozen=True)
class Apply:
    name: str
    arguments: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: Any
    body: tuple
    otherwise: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# Reading.

_TAG = re.compile(r"\{\{(-?)|\{%(-?)|\{#(-?)")
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<sign>==|!=|<=|>=|//|[-+*%<>~|.,()\[\]=]))""",
    re.DOTALL,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_RESERVED = {"or", "and", "not", "in", "if", "else", "is", "for", "set", "elif", "endif", "endfor", "generation", "endgeneration"} | set(_WORDS)


def _tokens(source: str) -> list[tuple[str, str]]:
    found, place = [], 0
    while source[place:].strip():
        match = _TOKEN.match(source, place)
        if not match:
            raise TemplateError(f"cannot read {source[place:].strip()[:20]!r}")
        found.append((match.lastgroup, match[match.lastgroup]))
        place = match.end()
    return found


def _tags(source: str) -> Iterator[tuple[str, str]]:
    """``text``, ``output`` and ``block`` parts of a template in order."""
    place, strip = 0, False
    while match := _TAG.search(source, place):
        before = source[place : match.start()]
        before = before.lstrip() if strip else before
        before = before.rstrip() if any(match.groups()) else before
        if before:
            yield "text", before
        kind = source[match.start() + 1]
        end = {"{": "}}", "%": "%}", "#": "#}"}[kind]
        close = _close(source, match.end(), end) if kind != "#" else source.find(end, match.end())
        if close < 0:
            raise TemplateError(f"a tag is not closed: {source[match.start():][:30]!r}")
        inside = source[match.end() : close]
        strip = inside.endswith("-")
        if kind != "#":
            yield ("output" if kind == "{" else "block"), inside[:-1] if strip else inside
        place = close + 2
    rest = source[place:].lstrip() if strip else source[place:]
    if rest:
        yield "text", rest


def _close(source: str, place: int, end: str) -> int:
    """Where a tag closes, strings inside it skipped."""
    pattern = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|""" + re.escape(end), re.DOTALL)
    for match in pattern.finditer(source, place):
        if match[0] == end:
            return match.start()
    return -1


class _Expressions:
    """Reads one expression by descent, a method for each strength of binding."""

    def __init__(self, source: str, filters: Mapping[str, Filter]):
        self._found, self._place, self._filters, self._depth = _tokens(source), 0, filters, 0

    def peek(self, *signs: str) -> bool:
        return self._place < len(self._found) and self._found[self._place][1] in signs and self._found[self._place][0] != "string"

    def take(self, sign: str | None = None) -> str:
        if self._place >= len(self._found) or (sign and not self.peek(sign)):
            raise TemplateError(f"expected {sign or 'an expression'} after {' '.join(t for _, t in self._found[: self._place])!r}")
        self._place += 1
        return self._found[self._place - 1][1]

    def name(self) -> str:
        kind = self._found[self._place][0] if self._place < len(self._found) else ""
        word = self.take()
        if kind != "name" or word in _RESERVED:
            raise TemplateError(f"{word!r} is no name")
        return word

    def whole(self):
        tree = self.choice()
        if self._place < len(self._found):
            raise TemplateError(f"unexpected {self._found[self._place][1]!r}")
        return tree

    def choice(self):
        self._depth += 1
        if self._depth > MOST_NESTED:
            raise TemplateError("nested too deep")
        value = self._left(0)
        if self.peek("if"):
            self.take()
            test = self._left(0)
            self.take("else")
            value = Choice(test, value, self.choice())
        self._depth -= 1
        return value

    _STRENGTHS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in", "is"), ("~",), ("+", "-"), ("*", "//", "%"))

    def _left(self, strength: int):
        if strength == len(self._STRENGTHS):
            return self._unary()
        signs = self._STRENGTHS[strength]
        if signs == ("not",):
            if self.peek("not"):
                self.take()
                self._depth += 1
                if self._depth > MOST_NESTED:
                    raise TemplateError("nested too deep")
                value = Unary("not", self._left(strength))
                self._depth -= 1
                return value
            return self._left(strength + 1)
        value = self._left(strength + 1)
        while self.peek(*signs) or (signs[0] == "==" and self.peek("not")):
            sign = self.take()
            if sign == "not":
                self.take("in")
                value = Unary("not", Binary("in", value, self._left(strength + 1)))
            elif sign == "is":
                turned = self.peek("not") and self.take() == "not"
                if self.peek("none", "None"):
                    self.take()
                    value = Binary("==", value, Const(None))
                else:
                    self.take("defined")
                    value = Unary("defined", value)
                value = Unary("not", value) if turned else value
            else:
                value = Binary(sign, value, self._left(strength + 1))
        return value

    def _unary(self):
        if self.peek("-"):
            self.take()
            return Unary("-", self._after(self._atom()))
        return self._after(self._atom())

    def _after(self, value):
        while self.peek(".", "[", "|"):
            sign = self.take()
            if sign == ".":
                value = Lookup(value, Const(self.take()))
            elif sign == "[":
                value = Lookup(value, self.choice())
                self.take("]")
            else:
                name = self.name()
                if name not in self._filters:
                    raise TemplateError(f"there is no filter {name!r}")
                arguments = [value]
                if self.peek("("):
                    self.take()
                    arguments += self._listed(")")
                value = Apply(name, tuple(arguments))
        return value

    def _listed(self, end: str) -> list:
        values = []
        while not self.peek(end):
            values.append(self.choice())
            if not self.peek(end):
                self.take(",")
        self.take(end)
        return values

    def _atom(self):
        kind = self._found[self._place][0] if self._place < len(self._found) else ""
        word = self.take()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.DOTALL))
        if kind == "number":
            return Const(_number(int(word)))
        if kind == "name" and word in _WORDS:
            return Const(_WORDS[word])
        if kind == "name" and word not in _RESERVED:
            return Name(word)
        if word == "(":
            value = self.choice()
            self.take(")")
            return value
        if word == "[":
            return Items(tuple(self._listed("]")))
        raise TemplateError(f"unexpected {word!r}")


class _Blocks:
    """Reads the parts of a template into statements."""

    def __init__(self, source: str, filters: Mapping[str, Filter]):
        self._parts, self._filters, self._depth = list(_tags(source)), filters, 0
        self._place = 0

    def expression(self, source: str):
        return _Expressions(source, self._filters).whole()

    def until(self, *ends: str) -> tuple[tuple, str, str]:
        """Statements up to a block of one of ``ends``, that block's word and its rest."""
        self._depth += 1
        if self._depth > MOST_NESTED:
            raise TemplateError("nested too deep")
        body = []
        while self._place < len(self._parts):
            kind, inside = self._parts[self._place]
            self._place += 1
            if kind == "text":
                body.append(Text(inside))
            elif kind == "output":
                body.append(Output(self.expression(inside)))
            else:
                word, _, rest = inside.strip().partition(" ")
                if word in ends:
                    self._depth -= 1
                    return tuple(body), word, rest
                body.append(self._statement(word, rest))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        self._depth -= 1
        return tuple(body), "", ""

    def _statement(self, word: str, rest: str):
        if word == "if":
            return self._if(rest)
        if word == "for":
            head = _Expressions(rest, self._filters)
            name = head.name()
            head.take("in")
            items = head.whole()
            body, end, _ = self.until("else", "endfor")
            otherwise = self.until("endfor")[0] if end == "else" else ()
            return For(name, items, body, otherwise)
        if word == "set":
            head = _Expressions(rest, self._filters)
            name = head.name()
            head.take("=")
            return Assign(name, head.whole())
        if word == "generation":
            return Generation(self.until("endgeneration")[0])
        raise TemplateError(f"there is no block {word!r}")

    def _if(self, test: str) -> If:
        body, end, rest = self.until("elif", "else", "endif")
        if end == "elif":
            return If(self.expression(test), body, (self._if(rest),))
        return If(self.expression(test), body, self.until("endif")[0] if end == "else" else ())


# What the signs do, for folding and for running.


class _Missing:
    """What a name or key that is not there stands for: empty, false and not equal to anything else."""

    def __bool__(self) -> bool:
        return False


MISSING = _Missing()


def _number(value: int) -> int:
    if not -MOST_NUMBER <= value < MOST_NUMBER:
        raise TemplateError("a number passes 64 bits")
    return value


def written(value: Any) -> str:
    """A value as it is put out."""
    if value is None or value is MISSING:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError("only texts and numbers can be put out")


def look_up(of: Any, key: Any) -> Any:
    if isinstance(of, Mapping):
        return of.get(key, MISSING) if isinstance(key, (str, int)) else MISSING
    if isinstance(of, Sequence) and not isinstance(of, (str, bytes)) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else MISSING
    return MISSING


def _whole(value: Any) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise TemplateError("a number was expected")
    return value


def _ordered(compare: Callable[[Any, Any], bool]) -> Callable[[Any, Any], bool]:
    def checked(a: Any, b: Any) -> bool:
        if not (isinstance(a, str) and isinstance(b, str)):
            a, b = _whole(a), _whole(b)
        return compare(a, b)

    return checked


def _contains(a: Any, b: Any) -> bool:
    if isinstance(b, str):
        return isinstance(a, str) and a in b
    return isinstance(b, (Mapping, Sequence)) and a in b


def _divided(a: Any, b: Any) -> tuple[int, int]:
    if _whole(b) == 0:
        raise TemplateError("division by zero")
    return divmod(_whole(a), b)


_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _ordered(lambda a, b: a < b),
    "<=": _ordered(lambda a, b: a <= b),
    ">": _ordered(lambda a, b: a > b),
    ">=": _ordered(lambda a, b: a >= b),
    "in": _contains,
    "~": lambda a, b: written(a) + written(b),
    "+": lambda a, b: a + b if isinstance(a, str) and isinstance(b, str) else _number(_whole(a) + _whole(b)),
    "-": lambda a, b: _number(_whole(a) - _whole(b)),
    "*": lambda a, b: _number(_whole(a) * _whole(b)),
    "//": lambda a, b: _number(_divided(a, b)[0]),
    "%": lambda a, b: _divided(a, b)[1],
}

FILTERS: dict[str, Filter] = {
    "trim": lambda a: written(a).strip(),
    "upper": lambda a: written(a).upper(),
    "lower": lambda a: written(a).lower(),
    "length": lambda a: len(a) if isinstance(a, (str, Sequence, Mapping)) else 0,
    "default": lambda a, b="": b if a is MISSING or a is None else a,
    "replace": lambda a, b, c: written(a).replace(written(b), written(c)),
    "join": lambda a, b="": written(b).join(map(written, a)) if not isinstance(a, str) else a,
    "first": lambda a: a[0] if a else MISSING,
    "last": lambda a: a[-1] if a else MISSING,
}


# Folding.


def fold(node: Any, filters: Mapping[str, Filter]) -> Any:
    """An expression with its constant parts worked out. What would fail is left to fail when it is reached."""
    if isinstance(node, (Const, Name)):
        return node
    if isinstance(node, Choice):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no, filters)
        return Choice(test, fold(node.yes, filters), fold(node.no, filters))
    if isinstance(node, Binary):
        node = replace(node, left=fold(node.left, filters), right=fold(node.right, filters))
        if node.op in ("and", "or") and isinstance(node.left, Const):
            return node.right if bool(node.left.value) == (node.op == "and") else node.left
        parts = (node.left, node.right)
    elif isinstance(node, Unary):
        node = replace(node, value=fold(node.value, filters))
        parts = (node.value,)
    elif isinstance(node, Lookup):
        node = replace(node, of=fold(node.of, filters), key=fold(node.key, filters))
        parts = (node.of, node.key)
    elif isinstance(node, Items):
        parts = tuple(fold(value, filters) for value in node.values)
        node = Items(parts)
    else:
        parts = tuple(fold(value, filters) for value in node.arguments)
        node = replace(node, arguments=parts)
    if all(isinstance(part, Const) for part in parts):
        try:
            return Const(_expression(node, filters)({}))
        except Exception:
            return node
    return node


def fold_body(body: tuple, filters: Mapping[str, Filter]) -> tuple:
    """Statements with constant expressions, tests and neighbouring texts worked out."""
    found: list = []
    for node in body:
        if isinstance(node, Output):
            value = fold(node.value, filters)
            try:
                node = Text(written(value.value)) if isinstance(value, Const) else Output(value)
            except TemplateError:
                node = Output(value)
        elif isinstance(node, If):
            test = fold(node.test, filters)
            if isinstance(test, Const):
                found.extend(fold_body(node.yes if test.value else node.no, filters))
                continue
            node = If(test, fold_body(node.yes, filters), fold_body(node.no, filters))
        elif isinstance(node, For):
            items = fold(node.items, filters)
            if isinstance(items, Const) and not items.value:
                found.extend(fold_body(node.otherwise, filters))
                continue
            node = For(node.name, items, fold_body(node.body, filters), fold_body(node.otherwise, filters))
        elif isinstance(node, Assign):
            node = Assign(node.name, fold(node.value, filters))
        elif isinstance(node, Generation):
            node = Generation(fold_body(node.body, filters))
        found.append(node)
    merged: list = []
    for node in found:
        if isinstance(node, Text) and merged and isinstance(merged[-1], Text):
            node = Text(merged.pop().text + node.text)
        if not isinstance(node, Text) or node.text:
            merged.append(node)
    return tuple(merged)


# Closures.


class Writer:
    """The rendered text, and which stretches of it were generated, in code points."""

    def __init__(self):
        self.parts: list[str] = []
        self.place = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.place += len(text)

    def text(self) -> str:
        return "".join(self.parts)


def _expression(node: Any, filters: Mapping[str, Filter]) -> Callable[[Mapping], Any]:
    """A closure from the names in scope to the expression's value."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name, MISSING)
    if isinstance(node, Lookup):
        of, key = _expression(node.of, filters), _expression(node.key, filters)
        return lambda scope: look_up(of(scope), key(scope))
    if isinstance(node, Unary):
        value = _expression(node.value, filters)
        if node.op == "not":
            return lambda scope: not value(scope)
        if node.op == "defined":
            return lambda scope: value(scope) is not MISSING
        return lambda scope: _number(-_whole(value(scope)))
    if isinstance(node, Binary):
        left, right = _expression(node.left, filters), _expression(node.right, filters)
        if node.op == "and":
            return lambda scope: left(scope) and right(scope)
        if node.op == "or":
            return lambda scope: left(scope) or right(scope)
        run = _BINARY[node.op]
        return lambda scope: run(left(scope), right(scope))
    if isinstance(node, Choice):
        test, yes, no = (_expression(part, filters) for part in (node.test, node.yes, node.no))
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if isinstance(node, Items):
        values = [_expression(value, filters) for value in node.values]
        return lambda scope: [value(scope) for value in values]
    call, arguments = filters[node.name], [_expression(value, filters) for value in node.arguments]

    def apply(scope: Mapping) -> Any:
        try:
            return call(*[argument(scope) for argument in arguments])
        except TemplateError:
            raise
        except Exception as wrong:
            raise TemplateError(f"filter {node.name!r}: {wrong}") from None

    return apply


Statement = Callable[[dict, Writer], None]


def _statement(node: Any, filters: Mapping[str, Filter]) -> Statement:
    """A closure that writes what the statement puts out."""
    if isinstance(node, Text):
        text = node.text
        return lambda scope, out: out.write(text)
    if isinstance(node, Output):
        value = _expression(node.value, filters)
        return lambda scope, out: out.write(written(value(scope)))
    if isinstance(node, If):
        test, yes, no = _expression(node.test, filters), _body(node.yes, filters), _body(node.no, filters)
        return lambda scope, out: (yes if test(scope) else no)(scope, out)
    if isinstance(node, Assign):
        name, value = node.name, _expression(node.value, filters)

        def assign(scope: dict, out: Writer) -> None:
            scope[name] = value(scope)

        return assign
    if isinstance(node, Generation):
        body = _body(node.body, filters)

        def generation(scope: dict, out: Writer) -> None:
            start = out.place
            body(scope, out)
            out.spans.append((start, out.place))

        return generation
    name, items = node.name, _expression(node.items, filters)
    body, otherwise = _body(node.body, filters), _body(node.otherwise, filters)

    def loop(scope: dict, out: Writer) -> None:
        values = items(scope)
        if values is MISSING or values is None:
            values = ()
        if isinstance(values, str) or not isinstance(values, Sequence):
            raise TemplateError("loops run over lists")
        for i, value in enumerate(values):
            # What the body sets is gone after each turn.
            body({**scope, name: value, "loop": turn_of(i) | {"last": i == len(values) - 1, "length": len(values)}}, out)
        if not values:
            otherwise(scope, out)

    return loop


def turn_of(i: int) -> dict[str, Any]:
    """What a loop's body knows of its turn, but for what comes after it."""
    return {"index0": i, "index": i + 1, "first": i == 0}


# What is known of a turn without its whole loop.
BY_ITSELF = {"index0", "index", "first", "last"}


def _body(nodes: tuple, filters: Mapping[str, Filter]) -> Statement:
    steps = [_statement(node, filters) for node in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(scope: dict, out: Writer) -> None:
        for step in steps:
            step(scope, out)

    return run


def names_in(node: Any) -> set[str]:
    """All names that a part of the tree reads."""
    if isinstance(node, Name):
        return {node.name}
    if isinstance(node, tuple):
        return set().union(*map(names_in, node)) if node else set()
    if not hasattr(node, "__dataclass_fields__"):
        return set()
    return set().union(*(names_in(getattr(node, field)) for field in node.__dataclass_fields__))


def loop_keys(node: Any) -> set[Any]:
    """What a part of the tree asks of ``loop``; None if that is not known beforehand."""
    if isinstance(node, Lookup) and node.of == Name("loop"):
        return {node.key.value if isinstance(node.key, Const) else None}
    if node == Name("loop"):
        return {None}
    if isinstance(node, tuple):
        return set().union(*map(loop_keys, node)) if node else set()
    fields = getattr(node, "__dataclass_fields__", ())
    return set().union(*(loop_keys(getattr(node, field)) for field in fields)) if fields else set()


@dataclass(frozen=True)
class Turns:
    """A template taken apart at its loop over the turns, so that stretches of turns are rendered by themselves."""

    head: Statement
    turn: Statement
    tail: Statement
    name: str


class Template:
    """A compiled template; ``tree`` is its folded syntax tree."""

    def __init__(self, source: str, filters: Mapping[str, Filter] = FILTERS):
        self.tree = fold_body(_Blocks(source, filters).until()[0], filters)
        self._run = _body(self.tree, filters)
        self._filters = filters

    def render(self, **names: Any) -> Writer:
        out = Writer()
        self._run(names, out)
        return out

    def by_turns(self, turns: str) -> Turns | None:
        """The three parts of a template that has one loop over ``turns``, which is not read elsewhere.

        None if it reads them in another way; such a template needs all turns of a conversation at once.
        """
        loops = [i for i, node in enumerate(self.tree) if isinstance(node, For) and node.items == Name(turns)]
        if len(loops) != 1:
            return None
        (i,) = loops
        head, loop, tail = self.tree[:i], self.tree[i], self.tree[i + 1 :]
        changed = any(isinstance(node, Assign) for node in (*head, *tail))
        read = names_in((*head, *loop.body, *tail))
        if changed or loop.otherwise or turns in read or not loop_keys(loop.body) <= BY_ITSELF:
            return None
        return Turns(_body(head, self._filters), _body(loop.body, self._filters), _body(tail, self._filters), loop.name)
