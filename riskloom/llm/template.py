"""A small sandboxed template language, compiled to Python closures.

``{{ expression }}`` emits a value, ``{% ... %}`` holds statements, ``{# ... #}`` a comment; a ``-`` beside the braces strips the white
space next to it. Statements: ``for NAME in messages`` / ``endfor``, ``if`` / ``elif`` / ``else`` / ``endif``, ``set NAME = expression``,
``generation`` / ``endgeneration``. Expressions: strings, integers, true, false, none, names, ``a.key``, ``a['key']``, ``|filter``,
``~`` (join as text), ``+ - %``, comparisons, ``in``, ``not``, ``and``, ``or`` and parentheses. Inside a loop, ``loop`` has ``first``,
``last``, ``index`` and ``index0``.

Three steps: a parser makes a tree of tuples, :func:`fold` computes what is constant (and drops branches that can't be taken), and
:func:`compiled` turns every node into a closure. There are no calls, no attributes of Python objects and no names but those given, so
a template reaches nothing beyond its input. Messages are consumed as they come, once and with one message of foresight, so a
conversation of any length is rendered in bounded memory; a value that grows beyond LONGEST characters is an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

LONGEST = 1 << 28

_PARTS = re.compile(r"""\{\{-?(?:'[^']*'|"[^"]*"|[^'"])*?-?\}\}|\{%-?(?:'[^']*'|"[^"]*"|[^'"])*?-?%\}|\{\#.*?\#\}""", re.S)
_TOKENS = re.compile(r"""\s*(?:('[^']*'|"[^"]*")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>~+\-%|.()\[\]=]))""")
_ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template can't be parsed, asks for what it may not see, or made a value that is too long."""


def _string(quoted: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1])


def _tokens(code: str) -> list[tuple[str, object]]:
    out, at = [], 0
    code = code.rstrip()
    while at < len(code):
        m = _TOKENS.match(code, at)
        if not m:
            raise TemplateError(f"unexpected text: {code[at:at + 20]!r}")
        quoted, digits, name, sign = m.groups()
        out.append(("string", _string(quoted)) if quoted else ("int", int(digits)) if digits else ("name", name) if name else ("sign", sign))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression; the loosest binding comes first."""

    WORDS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
    COMPARE = ("==", "!=", "<", "<=", ">", ">=")

    def __init__(self, tokens: list[tuple[str, object]], names: frozenset[str], filters: frozenset[str]):
        self.tokens, self.at, self.names, self.filters = tokens, 0, names, filters

    def peek(self) -> tuple[str, object]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *values: object) -> bool:
        if self.peek()[0] in ("sign", "name") and self.peek()[1] in values:
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected, found {self.peek()[1]!r}")

    def whole(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return tree

    def either(self) -> tuple:
        left = self.both()
        while self.take("or"):
            left = ("or", left, self.both())
        return left

    def both(self) -> tuple:
        left = self.negation()
        while self.take("and"):
            left = ("and", left, self.negation())
        return left

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> tuple:
        left = self.sum()
        for sign in self.COMPARE:
            if self.take(sign):
                return ("op", sign, left, self.sum())
        if self.take("in"):
            return ("op", "in", left, self.sum())
        if self.peek() == ("name", "not"):
            self.at += 1
            self.need("in")
            return ("not", ("op", "in", left, self.sum()))
        return left

    def sum(self) -> tuple:
        left = self.filtered()
        while self.peek()[0] == "sign" and self.peek()[1] in ("+", "-", "~", "%"):
            sign = self.peek()[1]
            self.at += 1
            left = ("op", sign, left, self.filtered())
        return left

    def filtered(self) -> tuple:
        tree = self.member()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            self.at += 1
            tree = ("filter", name, tree)
        return tree

    def member(self) -> tuple:
        tree = self.primary()
        while True:
            if self.take("."):
                kind, name = self.peek()
                if kind != "name" or name.startswith("_"):
                    raise TemplateError(f"{name!r} can't be read")
                self.at += 1
                tree = ("get", tree, ("const", name))
            elif self.take("["):
                tree = ("get", tree, self.either())
                self.need("]")
            else:
                return tree

    def primary(self) -> tuple:
        kind, value = self.peek()
        self.at += 1
        if kind in ("string", "int"):
            return ("const", value)
        if kind == "name" and value in self.WORDS:
            return ("const", self.WORDS[value])
        if kind == "name":
            if value not in self.names:
                raise TemplateError(f"unknown name {value!r}")
            return ("name", value)
        if (kind, value) == ("sign", "("):
            tree = self.either()
            self.need(")")
            return tree
        raise TemplateError(f"a value expected, found {value!r}")


class _Parser:
    def __init__(self, source: str, names: Iterable[str], filters: Iterable[str]):
        self.filters = frozenset(filters)
        self.parts = list(self._split(source))
        self.at = 0
        self.names = set(names)
        self.in_loop = self.in_generation = False

    @staticmethod
    def _split(source: str) -> Iterator[tuple[str, str]]:
        last, strip_next = 0, False
        for m in [*_PARTS.finditer(source), None]:
            text = source[last:m.start() if m else len(source)]
            text = text.lstrip() if strip_next else text
            part = m[0] if m else ""
            if part[2:3] == "-" and part[1:2] != "#":
                text = text.rstrip()
            if text:
                yield "text", text
            if not m:
                return
            last, strip_next = m.end(), part[-3:-2] == "-" and part[1] != "#"
            if part[1] != "#":
                yield "emit" if part[1] == "{" else "tag", part[2:-2].removeprefix("-").removesuffix("-").strip()

    def expression(self, tokens: list[tuple[str, object]]) -> tuple:
        return _Expression(tokens, frozenset(self.names), self.filters).whole()

    def whole(self) -> list[tuple]:
        body, end = self.block()
        if end:
            raise TemplateError(f"{end[0]!r} without a beginning")
        return body

    def block(self) -> tuple[list[tuple], tuple]:
        """Statements up to a tag that ends or parts a block, and this tag's word and further tokens."""
        out: list[tuple] = []
        while self.at < len(self.parts):
            kind, text = self.parts[self.at]
            self.at += 1
            if kind == "text":
                out.append(("text", text))
            elif kind == "emit":
                out.append(("emit", self.expression(_tokens(text))))
            else:
                (_, word), *rest = _tokens(text) or [("end", "")]
                if word in ("endfor", "endif", "elif", "else", "endgeneration"):
                    return out, (word, rest)
                out.append(self.statement(word, rest))
        return out, ()

    def body(self, *ends: str) -> tuple[list[tuple], tuple]:
        body, end = self.block()
        if not end or end[0] not in ends:
            raise TemplateError(f"{ends[-1]!r} expected")
        return body, end

    def statement(self, word: object, rest: list) -> tuple:
        if word == "if":
            arms, other = [], []
            test = self.expression(rest)
            while True:
                body, (end, more) = self.body("elif", "else", "endif")
                arms.append((test, body))
                if end == "elif":
                    test = self.expression(more)
                    continue
                if end == "else":
                    other, _ = self.body("endif")
                return ("if", arms, other)
        if word == "for":
            if self.in_loop or len(rest) != 3 or rest[0][0] != "name" or rest[1:] != [("name", "in"), ("name", "messages")]:
                raise TemplateError("a loop is 'for NAME in messages', and not inside another one")
            before = set(self.names)
            self.names |= {rest[0][1], "loop"}
            self.in_loop = True
            body, _ = self.body("endfor")
            # What a loop sets is its own: a template can't tell how many messages it has seen by other means than ``loop``.
            self.names, self.in_loop = before, False
            return ("for", rest[0][1], body)
        if word == "set":
            if len(rest) < 3 or rest[0][0] != "name" or rest[1] != ("sign", "="):
                raise TemplateError("an assignment is 'set NAME = expression'")
            tree = self.expression(rest[2:])
            self.names.add(rest[0][1])
            return ("set", rest[0][1], tree)
        if word == "generation" and not self.in_generation:
            self.in_generation = True
            body, _ = self.body("endgeneration")
            self.in_generation = False
            return ("generation", body)
        raise TemplateError(f"unknown statement {word!r}")


def _as_text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _joined(a: object, b: object) -> str:
    return _checked(_as_text(a) + _as_text(b))


def _checked(value: str) -> str:
    if len(value) > LONGEST:
        raise TemplateError(f"a value has more than {LONGEST} characters")
    return value


def _plus(a: object, b: object) -> object:
    return _joined(a, b) if isinstance(a, str) or isinstance(b, str) else a + b


_OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "~": _joined, "+": _plus,
    "-": lambda a, b: a - b, "%": lambda a, b: a % b,
}


def _operate(sign: str, a: object, b: object) -> object:
    if sign == "%" and not isinstance(a, int):
        raise TemplateError("% takes integers")
    try:
        return _OPERATIONS[sign](a, b)
    except (TypeError, ZeroDivisionError) as e:
        raise TemplateError(f"{sign}: {e}") from e


def _get(value: object, key: object) -> object:
    """An entry of a mapping; anything else has no entries."""
    if isinstance(value, dict):
        return value.get(key)
    raise TemplateError(f"{key!r} of a value that is no mapping")


def fold(tree: tuple, filters: dict[str, Callable[[str], str]]) -> tuple:
    """An expression with its constant parts computed. What would fail stays, and fails if it is reached."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    if kind in ("and", "or"):
        a, b = fold(tree[1], filters), fold(tree[2], filters)
        if a[0] == "const":
            return b if bool(a[1]) == (kind == "and") else a
        return (kind, a, b)
    own = tuple(fold(t, filters) if isinstance(t, tuple) else t for t in tree[1:])
    folded = (kind, *own)
    if all(t[0] == "const" for t in own if isinstance(t, tuple)):
        try:
            return ("const", _expression(folded, filters)({}))
        except TemplateError:
            return folded
    return folded


def fold_body(body: list[tuple], filters: dict[str, Callable[[str], str]]) -> list[tuple]:
    """Statements with constants folded: constant values become text, neighbouring texts one, and dead branches go."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        if node[0] == "emit":
            tree = fold(node[1], filters)
            add(("text", _as_text(tree[1])) if tree[0] == "const" else ("emit", tree))
        elif node[0] == "set":
            add(("set", node[1], fold(node[2], filters)))
        elif node[0] in ("for", "generation"):
            inner = fold_body(node[-1], filters)
            if inner or node[0] == "for":
                add((*node[:-1], inner))
        elif node[0] == "if":
            arms, other = [], fold_body(node[2], filters)
            for test, inner in node[1]:
                test, inner = fold(test, filters), fold_body(inner, filters)
                if test[0] != "const":
                    arms.append((test, inner))
                elif test[1]:
                    other = inner
                    break
            for part in [("if", arms, other)] if arms else other:
                add(part)
        else:
            add(node)
    return out


def _expression(tree: tuple, filters: dict[str, Callable[[str], str]]) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda scope: value
    if kind == "name":
        name = tree[1]
        return lambda scope: scope.get(name)
    inner = [_expression(t, filters) for t in tree[1:] if isinstance(t, tuple)]
    if kind == "get":
        (a, b), key = inner, tree[2][1] if tree[2][0] == "const" else None
        return (lambda scope: _get(a(scope), key)) if tree[2][0] == "const" else (lambda scope: _get(a(scope), b(scope)))
    if kind == "filter":
        f, (a,) = filters[tree[1]], inner
        return lambda scope: _checked(f(_as_text(a(scope))))
    if kind == "not":
        (a,) = inner
        return lambda scope: not a(scope)
    a, b = inner
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    sign = tree[1]
    return lambda scope: _operate(sign, a(scope), b(scope))


#: Renders a scope: pieces of text, each with whether it lies between generation markers.
Piece = tuple[str, bool]


def _body(body: list[tuple], filters: dict[str, Callable[[str], str]], marked: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_statement(node, filters, marked) for node in body]

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def _statement(node: tuple, filters: dict[str, Callable[[str], str]], marked: bool) -> Callable[[dict], Iterable[Piece]]:
    kind = node[0]
    if kind == "text":
        piece = ((node[1], marked),)
        return lambda scope: piece
    if kind == "emit":
        value = _expression(node[1], filters)
        return lambda scope: ((_as_text(value(scope)), marked),)
    if kind == "set":
        name, value = node[1], _expression(node[2], filters)

        def assign(scope: dict) -> Iterable[Piece]:
            scope[name] = value(scope)
            return ()

        return assign
    if kind == "generation":
        return _body(node[1], filters, True)
    if kind == "if":
        arms = [(_expression(test, filters), _body(body, filters, marked)) for test, body in node[1]]
        other = _body(node[2], filters, marked)

        def choose(scope: dict) -> Iterable[Piece]:
            for test, body in arms:
                if test(scope):
                    return body(scope)
            return other(scope)

        return choose
    name, body = node[1], _body(node[2], filters, marked)

    def each(scope: dict) -> Iterator[Piece]:
        rest = iter(scope["messages"])
        ahead = next(rest, None)
        at = 0
        while ahead is not None:
            message, ahead = ahead, next(rest, None)
            inner = scope | {name: message, "loop": {"first": at == 0, "last": ahead is None, "index": at + 1, "index0": at}}
            yield from body(inner)
            at += 1

    return each


def parse(source: str, names: Iterable[str] = (), filters: Iterable[str] = ()) -> list[tuple]:
    """The syntax tree of a template: a list of statements."""
    return _Parser(source, [*names, "messages"], filters).whole()


def compiled(source: str, filters: dict[str, Callable[[str], str]], names: Iterable[str] = ()) -> Callable[..., Iterator[Piece]]:
    """A renderer: called with an iterable of messages (mappings) and values for ``names``, it yields pieces of the result.

    Every piece comes with whether it lies between generation markers. Unknown names, filters and statements are errors here, before
    anything is rendered; ``messages`` itself can only be looped over, once in a run of a template.
    """
    tree = parse(source, names, filters)
    loops = [n for n in _walk(tree) if n[0] == "for"]
    if len(loops) > 1 or ("name", "messages") in list(_walk(tree)):
        raise TemplateError("messages can be looped over, once")
    run = _body(fold_body(tree, filters), filters, False)
    known = frozenset(names)

    def render(messages: Iterable[dict], **values: object) -> Iterator[Piece]:
        if set(values) - known:
            raise TemplateError(f"unknown values {sorted(set(values) - known)}")
        return run(dict(values) | {"messages": messages})

    return render


def _walk(node: object) -> Iterator[tuple]:
    if isinstance(node, tuple):
        yield node
    if isinstance(node, (tuple, list)):
        for part in node:
            yield from _walk(part)
