"""Prompt templates as one column expression.

A template is text with ``{{ expression }}``, ``{% if %}`` / ``{% elif %}`` / ``{% else %}``,
``{% for x in list %}`` and ``{# remarks #}``; a line that holds only a tag leaves no line behind.
Expressions have dotted names of columns and fields, texts, numbers, ``none``, comparisons,
``is none``, ``and``/``or``/``not``, ``a if c else b``, and filters: ``format``, ``lower``,
``upper``, ``trim``, ``length``, ``join``, ``default``. They are read with Python's own
grammar and become Spark functions, so that rendering stays in generated code.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.expressions import fixed

_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)

#: Filters by name, besides ``format``: a function of the value and the arguments.
FILTERS: dict[str, Callable[..., Column]] = {
    "lower": lambda v: F.lower(v),
    "upper": lambda v: F.upper(v),
    "trim": lambda v: F.trim(v),
    "length": lambda v: F.size(v),
    "join": lambda v, by=None: F.call_function("array_join", F.transform(v, _shown), F.lit("") if by is None else by),
    "default": lambda v, other: F.coalesce(v, other),
}


class TemplateError(ValueError):
    """A template that can't be read, with what is wrong."""


def _shown(value: Column) -> Column:
    """What a value leaves in the text: nulls are ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def _tree(text: str) -> ast.AST:
    """An expression in Python's grammar; words outside of texts that are spelled differently there are respelled."""
    parts = re.split(r"('[^']*'|\"[^\"]*\")", text.strip())
    parts[::2] = [re.sub(r"\b(none|true|false)\b", lambda m: m[0].capitalize(), p) for p in parts[::2]]
    try:
        return ast.parse("".join(parts), mode="eval").body
    except SyntaxError as e:
        raise TemplateError(f"can't read {text.strip()!r}") from e


def _formatted(pattern: str, values: list[Column]) -> Column:
    """A ``%`` pattern with decimals (``%.2f``), whole numbers, texts and percent signs, as Python fills it."""
    parts, values = [], list(values)
    for piece in re.split(r"(%%|%(?:\.\d+)?f|%d|%s)", pattern):
        if piece == "%%":
            parts.append(F.lit("%"))
        elif re.fullmatch(r"%(?:\.\d+)?f|%d|%s", piece):
            if not values:
                raise TemplateError(f"{pattern!r} has more places than values")
            value = values.pop(0)
            if piece.endswith("f"):
                parts.append(fixed(value, int(piece[2:-1]) if "." in piece else 6))
            else:
                parts.append(value.cast("long").cast("string") if piece == "%d" else _shown(value))
        elif "%" in piece:
            raise TemplateError(f"{pattern!r} has a place that isn't known")
        elif piece:
            parts.append(F.lit(piece))
    if values:
        raise TemplateError(f"{pattern!r} has fewer places than values")
    return _joined(parts)


class _Expression:
    """Columns from an expression's tree; ``names`` are loop variables, all others are columns."""

    def __init__(self, names: dict[str, Column]):
        self.names = names

    def read(self, text: str) -> Column:
        return self.of(_tree(text))

    def of(self, node: ast.AST) -> Column:
        match node:
            case ast.Constant(value=v):
                return F.lit(v)
            case ast.Name(id=name):
                return self.names[name] if name in self.names else F.col(f"`{name}`")
            case ast.Attribute(value=of, attr=name):
                return self.of(of)[name]
            case ast.Subscript(value=of, slice=ast.Constant(value=at)):
                return F.get(self.of(of), at) if isinstance(at, int) else self.of(of)[at]
            case ast.IfExp(test=c, body=yes, orelse=no):
                return F.when(self.truth(c), _shown(self.of(yes))).otherwise(_shown(self.of(no)))
            case ast.BinOp(left=value, op=ast.BitOr(), right=right):
                return self.filtered(value, right)
            case ast.BinOp(left=a, op=ast.Add() | ast.Sub() | ast.Mult() as op, right=b):
                return {ast.Add: lambda x, y: x + y, ast.Sub: lambda x, y: x - y, ast.Mult: lambda x, y: x * y}[type(op)](self.of(a), self.of(b))
            case ast.Compare() | ast.BoolOp() | ast.UnaryOp(op=ast.Not()):
                return self.truth(node)
        raise TemplateError(f"{ast.unparse(node)!r} isn't an expression of templates")

    def filtered(self, value: ast.AST, by: ast.AST) -> Column:
        name, arguments = (by.func, by.args) if isinstance(by, ast.Call) else (by, [])
        if not isinstance(name, ast.Name) or name.id not in {*FILTERS, "format"}:
            raise TemplateError(f"{ast.unparse(by)!r} isn't a filter")
        if name.id == "format":
            if not isinstance(value, ast.Constant):
                raise TemplateError("format needs its pattern as a text")
            return _formatted(value.value, list(map(self.of, arguments)))
        return FILTERS[name.id](self.of(value), *map(self.of, arguments))

    def truth(self, node: ast.AST) -> Column:
        """Whether the expression holds; null doesn't, nor do empty texts and zeros that stand alone."""
        match node:
            case ast.BoolOp(op=op, values=values):
                out = self.truth(values[0])
                for v in values[1:]:
                    out = out & self.truth(v) if isinstance(op, ast.And) else out | self.truth(v)
                return out
            case ast.UnaryOp(op=ast.Not(), operand=v):
                return ~self.truth(v)
            case ast.Compare(left=a, ops=[op], comparators=[b]):
                x, none = self.of(a), isinstance(b, ast.Constant) and b.value is None
                if none:
                    return x.isNull() if isinstance(op, ast.Is | ast.Eq) else x.isNotNull()
                y = self.of(b)
                found = {ast.Eq: lambda: x == y, ast.NotEq: lambda: ~x.eqNullSafe(y), ast.Lt: lambda: x < y, ast.LtE: lambda: x <= y, ast.Gt: lambda: x > y, ast.GtE: lambda: x >= y}.get(type(op))
                if not found:
                    raise TemplateError(f"{ast.unparse(node)!r} isn't a comparison of templates")
                return F.coalesce(found(), F.lit(False))
        shown = self.of(node).cast("string")
        return F.coalesce(~shown.isin("", "0", "0.0", "false", "[]"), F.lit(False))


def _pieces(text: str) -> list[str]:
    """Text and tags in turn; a line with nothing but one block tag or remark goes with its line break."""
    alone = re.sub(r"^[ \t]*(\{[%#](?:(?!\{[%#]).)*?[%#]\})", r"\1", text, flags=re.M | re.S)
    alone = re.sub(r"(\{[%#](?:(?!\{[%#]).)*?[%#]\})\n", r"\1", alone, flags=re.S)
    return _TAG.split(alone)


def rendered(template: str, names: dict[str, Column] | None = None) -> Column:
    """The template as a column, stripped, with one line break at its end.

    Fails for a tag, filter or expression that it doesn't know. ``names`` stand for
    columns under names of the template's own.
    """
    pieces = _pieces(template)
    pieces.reverse()
    out, left = _block(pieces, dict(names or {}), ())
    if left:
        raise TemplateError(f"{left!r} without a beginning")
    return F.concat(F.regexp_replace(out, r"(?U)^\s+|\s+$", ""), F.lit("\n"))


def _block(pieces: list[str], names: dict[str, Column], ends: tuple[str, ...]) -> tuple[Column, str]:
    """The text up to one of the tags ``ends``, and that tag."""
    parts: list[Column] = []
    while pieces:
        piece = pieces.pop()
        if piece.startswith("{{"):
            parts.append(_shown(_Expression(names).read(piece[2:-2])))
        elif piece.startswith("{%"):
            tag = piece[2:-2].strip(" \t\n-")
            if tag.split()[0] in ends:
                return _joined(parts), tag
            parts.append(_tag(tag, pieces, names))
        elif piece and not piece.startswith("{#"):
            parts.append(F.lit(piece))
    if ends:
        raise TemplateError(f"no {ends[-1]!r}")
    return _joined(parts), ""


def _tag(tag: str, pieces: list[str], names: dict[str, Column]) -> Column:
    if loop := re.fullmatch(r"for\s+(\w+)\s+in\s+(.+)", tag, re.S):
        over, mark = _Expression(names).read(loop[2]), len(pieces)
        held = list(pieces)
        _, _ = _block(pieces, {**names, loop[1]: F.lit("")}, ("endfor",))
        body = held[len(pieces) : mark]
        each = F.transform(over, lambda x: _block(list(body), {**names, loop[1]: x}, ("endfor",))[0])
        return F.coalesce(F.array_join(each, ""), F.lit(""))
    if not tag.startswith("if "):
        raise TemplateError(f"{tag!r} isn't a tag of templates")
    tag, cases = tag[3:], []
    while True:
        test = _Expression(names).truth(_tree(tag))
        part, tag = _block(pieces, names, ("elif", "else", "endif"))
        cases.append((test, part))
        if not tag.startswith("elif "):
            break
        tag = tag[5:]
    other = _block(pieces, names, ("endif",))[0] if tag == "else" else F.lit("")
    for test, part in reversed(cases):
        other = F.when(test, part).otherwise(other)
    return other


def _joined(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else F.lit("")
