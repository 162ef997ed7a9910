"""A small template language for conversations, compiled to Python closures.

``{{ expression }}``, ``{% for name in expression %} .. {% endfor %}``, ``{% if %} .. {% elif %} .. {% else %} ..
{% endif %}``, ``{% set name = expression %}``, ``{% generation %} .. {% endgeneration %}`` and ``{# comments #}``;
a dash inside a tag (``{%-``, ``-%}``) trims the white space next to it. Expressions have strings, whole numbers,
``true``, ``false``, ``none``, names, ``a.key`` and ``a['key']``, ``+``, ``~``, ``==``, ``!=``, ``in``, ``not``,
``and``, ``or``, parentheses and ``value | filter``.

It is a sandbox: a template reaches only the values it is given, by the keys of dicts, and the filters named
here. There are no attributes, calls, imports or arithmetic that could grow without bound.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

START, END = "<|im_start|>", "<|im_end|>"


def quote(text: Any) -> str:
    """Takes control strings apart: a backslash goes into every ``<|``, also where there are some already."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", str(text))


def unquote(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def one_line(text: Any) -> str:
    return quote(str(text).replace("\\", "\\\\").replace("\n", "\\n"))


def from_one_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unquote(text))


FILTERS: dict[str, Callable[[Any], Any]] = {
    "quote": quote, "one_line": one_line, "trim": lambda v: str(v).strip(), "upper": lambda v: str(v).upper(),
    "lower": lambda v: str(v).lower(), "length": len, "string": str,
}


class TemplateError(ValueError):
    pass


# The syntax tree.


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Apply:
    """An operation, by name, on the values of its operands."""

    operation: str
    operands: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _get(value: Any, key: Any) -> Any:
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple)) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    raise TemplateError(f"{key!r} of a {type(value).__name__}")


_OPERATIONS: dict[str, Callable[..., Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b, "get": _get,
    "+": lambda a, b: a + b, "~": lambda a, b: f"{a}{b}", "not": lambda a: not a,
}

_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|.()\[\]+~=]))", re.S)
_CONSTANTS = {"true": True, "false": False, "none": None}
_TAG = re.compile(r"\{#.*?#\}|\{(-?)\{(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}", re.S)


class _Expression:
    """A recursive-descent parser of one expression."""

    def __init__(self, text: str):
        self.text, self.tokens, at = text, [], 0
        while text[at:].strip():
            if not (m := _TOKEN.match(text, at)):
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((("str", "int", "name", "op")[m.lastindex - 1], m[m.lastindex]))
            at = m.end()

    def take(self, *values: str) -> str | None:
        return self.tokens.pop(0)[1] if self.tokens and self.tokens[0][1] in values and self.tokens[0][0] != "str" else None

    def need(self, kind: str) -> str:
        if not self.tokens or self.tokens[0][0] != kind:
            raise TemplateError(f"{kind} expected in {self.text!r}")
        return self.tokens.pop(0)[1]

    def whole(self) -> Any:
        found = self.disjunction()
        if self.tokens:
            raise TemplateError(f"{self.tokens[0][1]!r} not expected in {self.text!r}")
        return found

    def _chain(self, part: Callable[[], Any], *operators: str) -> Any:
        left = part()
        while op := self.take(*operators):
            left = Apply(op, (left, part()))
        return left

    def disjunction(self) -> Any:
        return self._chain(lambda: self._chain(self.negation, "and"), "or")

    def negation(self) -> Any:
        return Apply("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Any:
        left = self._chain(self.postfix, "+", "~")
        op = self.take("==", "!=", "in")
        return Apply(op, (left, self._chain(self.postfix, "+", "~"))) if op else left

    def postfix(self) -> Any:
        value = self.atom()
        while op := self.take(".", "[", "|"):
            if op == ".":
                value = Apply("get", (value, Const(self.need("name"))))
            elif op == "[":
                value = Apply("get", (value, self.disjunction()))
                if not self.take("]"):
                    raise TemplateError(f"']' expected in {self.text!r}")
            elif (name := self.need("name")) in FILTERS:
                value = Apply(f"|{name}", (value,))
            else:
                raise TemplateError(f"no filter {name!r}; there are {sorted(FILTERS)}")
        return value

    def atom(self) -> Any:
        if self.take("("):
            value = self.disjunction()
            if not self.take(")"):
                raise TemplateError(f"')' expected in {self.text!r}")
            return value
        if not self.tokens:
            raise TemplateError(f"{self.text!r} ends too soon")
        kind, text = self.tokens.pop(0)
        if kind == "str":
            return Const(ast.literal_eval("u" + text if "\n" not in text else f'"""{text[1:-1]}"""'))
        if kind == "int":
            return Const(int(text))
        if kind == "name":
            return Const(_CONSTANTS[text]) if text in _CONSTANTS else Name(text)
        raise TemplateError(f"{text!r} not expected in {self.text!r}")


def parse(template: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    pieces, at, trim = [], 0, False
    for m in _TAG.finditer(template):
        before = template[at : m.start()]
        before = before.lstrip() if trim else before
        pieces.append(("text", before.rstrip() if m[1] or m[4] else before))
        if m[2] is not None:
            pieces.append(("value", m[2]))
        elif m[5] is not None:
            pieces.append(("tag", m[5].strip()))
        at, trim = m.end(), bool(m[3] or m[6])
    pieces.append(("text", template[at:].lstrip() if trim else template[at:]))

    def block(*ends: str) -> tuple[tuple, str]:
        body: list[Any] = []
        while pieces:
            kind, text = pieces.pop(0)
            if kind == "text":
                body += [Output(Const(text))] if text else []
                continue
            if kind == "value":
                body.append(Output(_Expression(text).whole()))
                continue
            word, _, rest = text.partition(" ")
            if word in ends:
                return tuple(body), text
            if word == "for" and (m := re.fullmatch(r"(\w+)\s+in\s+(.+)", rest.strip(), re.S)):
                body.append(For(m[1], _Expression(m[2]).whole(), block("endfor")[0]))
            elif word == "if":
                body.append(branch(rest))
            elif word == "set" and (m := re.fullmatch(r"(\w+)\s*=(?!=)(.+)", rest.strip(), re.S)):
                body.append(Set(m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                body.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {text!r}")
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return tuple(body), ""

    def branch(test: str) -> If:
        then, end = block("elif", "else", "endif")
        other: tuple = ()
        if end.startswith("elif"):
            other = (branch(end[4:]),)
        elif end == "else":
            other, _ = block("endif")
        return If(_Expression(test).whole(), then, other)

    return block()[0]


def fold(node: Any) -> Any:
    """Constant parts evaluated once, branches that never run dropped, neighbouring texts joined."""
    if isinstance(node, tuple):
        body: list[Any] = []
        for part in map(fold, node):
            for x in part if isinstance(part, tuple) else (part,):
                last = body[-1] if body else None
                if isinstance(x, Output) and isinstance(x.value, Const) and isinstance(last, Output) and isinstance(last.value, Const):
                    body[-1] = Output(Const(f"{last.value.value}{x.value.value}"))
                else:
                    body.append(x)
        return tuple(body)
    if isinstance(node, Apply):
        operands = tuple(map(fold, node.operands))
        if node.operation in ("and", "or") and isinstance(operands[0], Const):
            return operands[1] if bool(operands[0].value) == (node.operation == "and") else operands[0]
        folded = Apply(node.operation, operands)
        return Const(_value(folded)({})) if all(isinstance(x, Const) for x in operands) else folded
    if isinstance(node, (Output, Set)):
        return replace(node, value=fold(node.value))
    if isinstance(node, If):
        test, then, other = fold(node.test), fold(node.then), fold(node.other)
        return (then if test.value else other) if isinstance(test, Const) else If(test, then, other)
    if isinstance(node, For):
        return For(node.name, fold(node.items), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _value(node: Any) -> Callable[[dict], Any]:
    """A closure that gives an expression's value in an environment."""
    if isinstance(node, Const):
        return lambda env, value=node.value: value
    if isinstance(node, Name):
        def look(env: dict, name: str = node.name) -> Any:
            if name not in env:
                raise TemplateError(f"no value named {name!r}")
            return env[name]

        return look
    first, *rest = map(_value, node.operands)
    if node.operation == "and":
        return lambda env: first(env) and rest[0](env)
    if node.operation == "or":
        return lambda env: first(env) or rest[0](env)
    operation = FILTERS[node.operation[1:]] if node.operation[0] == "|" else _OPERATIONS[node.operation]
    if not rest:
        return lambda env: operation(first(env))
    second = rest[0]
    return lambda env: operation(first(env), second(env))


@dataclass
class _Page:
    """What a run has written so far."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _runner(body: tuple) -> Callable[[dict, _Page], None]:
    """A closure that runs statements in an environment."""
    steps = [_step(x) for x in body]

    def run(env: dict, page: _Page) -> None:
        for step in steps:
            step(env, page)

    return run


def _step(node: Any) -> Callable[[dict, _Page], None]:
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            return lambda env, page, text=str(node.value.value): page.write(text)
        value = _value(node.value)
        return lambda env, page: page.write(str(value(env)))
    if isinstance(node, Set):
        value = _value(node.value)
        return lambda env, page: env.__setitem__(node.name, value(env))
    if isinstance(node, If):
        test, then, other = _value(node.test), _runner(node.then), _runner(node.other)
        return lambda env, page: then(env, page) if test(env) else other(env, page)
    if isinstance(node, Generation):
        inner = _runner(node.body)

        def generation(env: dict, page: _Page) -> None:
            start = page.length
            inner(env, page)
            page.spans.append((start, page.length))

        return generation
    items, body = _value(node.items), _runner(node.body)

    def loop(env: dict, page: _Page) -> None:
        inner = dict(env)
        values = items(env)
        for i, value in enumerate(values):
            inner[node.name] = value
            inner["loop"] = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(values) - 1}
            body(inner, page)

    return loop


def compile_template(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from the template's values to the text and the spans, in code points, of its generations."""
    run = _runner(fold(parse(template)))

    def render(values: dict) -> tuple[str, list[tuple[int, int]]]:
        page = _Page()
        run(dict(values), page)
        return "".join(page.parts), page.spans

    return render


#: Turns between control strings, the assistant's texts marked as generated.
CHAT = (
    "{% for m in messages %}<|im_start|>{{ m.role | one_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | quote }}{% endgeneration %}"
    "{% else %}{{ m.text | quote }}{% endif %}<|im_end|>\n{% endfor %}"
)

_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def read_back(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of what ``CHAT`` made, as they were before."""
    turns, at = [], 0
    while at < len(text):
        if not (m := _TURN.match(text, at)):
            raise ValueError(f"no turn at {at}: {text[at : at + 80]!r}")
        turns.append((from_one_line(m[1]), unquote(m[2])))
        at = m.end()
    return turns
