"""JSON paths that lead to any number of values, compiled to functions on variants.

Steps: ``.name``, ``['name']``, ``.*``, ``[*]``, ``[2]``, ``[-1]``, ``[0,2]``, ``[1:3]`` (either end may be left
out or negative), ``..`` before any of them, and filters ``[?(@.a.b op literal)]`` or ``[?(@.a)]`` with
``==``, ``!=``, ``<``, ``<=``, ``>``, ``>=``, joined by ``&&`` or ``||`` (``&&`` binds closer).

Each step turns the array of values found so far into the next one. What is not there is left out; a null
that is there stays. ``..`` takes every value below a value and the value itself, each before what lies
inside it, in document order of arrays. Members of an object come in the order of their names, as a
variant keeps no other. A filter looks at the elements of an array, or at an object itself; values of
different kinds are unequal and in no order.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFINITE = re.compile(r"""^\$(?:\.[A-Za-z_][\w\-]*|\['[^']+'\]|\["[^"]+"\]|\[\d+\])+$""")

_NAME = r"[A-Za-z_][\w\-]*"
_TOKEN = re.compile(
    rf"""(?P<deep>\.\.)(?=[\w\[*])
    |\.?(?P<any>\*|\[\s*\*\s*\])
    |\.?(?P<name>{_NAME})
    |\[\s*(?P<quoted>'[^']+'|"[^"]+")\s*\]
    |\[\s*(?P<indexes>-?\d+(?:\s*,\s*-?\d+)*)\s*\]
    |\[\s*(?P<slice>-?\d*\s*:\s*-?\d*)\s*\]
    |\[\s*\?\s*\(""",
    re.VERBOSE,
)
_HEAD = re.compile(rf"""^\$(?P<head>(?:\.{_NAME}|\['[^'.]+'\]|\["[^".]+"\]|\[\d+\])+)""")
_TERM = re.compile(
    rf"""^\s*@(?P<path>(?:\.{_NAME}|\['[^']+'\]|\["[^"]+"\]|\[\d+\])+)
    \s*(?:(?P<op>==|!=|<=|>=|<|>)\s*(?P<literal>'[^']*'|"[^"]*"|-?\d+(?:\.\d+)?|true|false|null))?\s*$""",
    re.VERBOSE,
)

Step = Callable[[Column], Column]


@dataclass(frozen=True)
class Term:
    """One comparison of a filter; without an operator, whether the path is there."""

    path: str
    op: str | None = None
    literal: object = None

    def holds(self, value: Column) -> Column:
        held = F.try_variant_get(value, f"${self.path}", "variant")
        if self.op is None:
            return held.isNotNull()
        kind = F.schema_of_variant(held)
        if self.literal is None:
            same = kind == "VOID"
            order = F.lit(False)
        else:
            if isinstance(self.literal, bool):
                own, typed, constant = kind == "BOOLEAN", "boolean", F.lit(self.literal)
            elif isinstance(self.literal, str):
                own, typed, constant = kind == "STRING", "string", F.lit(self.literal)
            else:
                own = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
                typed, constant = "double", F.lit(float(self.literal))
            found = F.when(own, F.try_variant_get(held, "$", typed))
            same = found == constant
            order = {"<": found < constant, "<=": found <= constant, ">": found > constant, ">=": found >= constant}.get(
                self.op, F.lit(False)
            )
            if isinstance(self.literal, bool):
                order = F.lit(False)
        same = F.coalesce(same, F.lit(False))
        if self.op == "==":
            return same
        if self.op == "!=":
            return held.isNotNull() & ~same
        return F.coalesce(order, F.lit(False))


def _split(text: str, mark: str) -> list[str]:
    """Parts of a condition between marks that stand outside of quotes."""
    parts, quote, begin, at = [], "", 0, 0
    while at < len(text):
        c = text[at]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif text.startswith(mark, at):
            parts.append(text[begin:at])
            begin = at = at + len(mark)
            continue
        at += 1
    return [*parts, text[begin:]]


def _literal(text: str) -> object:
    return text[1:-1] if text[0] in "'\"" else json.loads(text)


def parse_condition(text: str) -> list[list[Term]]:
    """Alternatives of terms that must all hold."""
    out = []
    for alternative in _split(text, "||"):
        terms = []
        for part in _split(alternative, "&&"):
            found = _TERM.match(part)
            if not found:
                raise ValueError(f"cannot read JSON path filter {text!r}")
            literal = found["literal"]
            terms.append(Term(found["path"], found["op"], _literal(literal) if literal else None))
        out.append(terms)
    return out


def _elements(value: Column) -> Column:
    return F.coalesce(value.try_cast("array<variant>"), F.array().cast("array<variant>"))


def children(value: Column) -> Column:
    """The elements of an array or the members of an object."""
    members = F.map_values(value.try_cast("map<string,variant>"))
    return F.coalesce(value.try_cast("array<variant>"), members, F.array().cast("array<variant>"))


def _each(step: Callable[[Column], Column]) -> Step:
    """A step that finds one value at most in each value."""
    return lambda values: F.filter(F.transform(values, step), lambda v: v.isNotNull())


def _all(step: Callable[[Column], Column]) -> Step:
    return lambda values: F.flatten(F.transform(values, step))


def _member(path: str) -> Step:
    return _each(lambda v: F.try_variant_get(v, f"${path}", "variant"))


def _indexes(places: Sequence[int]) -> Step:
    def pick(value: Column) -> Column:
        elements = _elements(value)
        found = F.array(*(F.try_element_at(elements, F.lit(p + 1 if p >= 0 else p)) for p in places))
        return F.filter(found, lambda v: v.isNotNull())

    return _all(pick)


def _slice(first: int | None, end: int | None) -> Step:
    def cut(value: Column) -> Column:
        elements = _elements(value)
        size = F.size(elements)

        def place(given: int | None, default: Column) -> Column:
            if given is None:
                return default
            at = F.lit(given) if given >= 0 else size + F.lit(given)
            return F.greatest(F.least(at, size), F.lit(0))

        begin = place(first, F.lit(0))
        length = F.greatest(place(end, size) - begin, F.lit(0))
        return F.slice(elements, begin + 1, length)

    return _all(cut)


def _filter(alternatives: list[list[Term]]) -> Step:
    def holds(value: Column) -> Column:
        any_of = F.lit(False)
        for terms in alternatives:
            all_of = F.lit(True)
            for term in terms:
                all_of = all_of & term.holds(value)
            any_of = any_of | all_of
        return any_of

    def look(value: Column) -> Column:
        object_itself = F.schema_of_variant(value).startswith("OBJECT")
        candidates = F.when(object_itself, F.array(value)).otherwise(_elements(value))
        return F.filter(candidates, holds)

    return _all(look)


def _below(depth: Column) -> Step:
    """Every value that holds others, and all such inside it: the step after ``..`` finds nothing in the rest.
    ``depth`` is how deep values can be nested at most; levels below the deepest cost next to nothing."""

    def holder(value: Column) -> Column:
        return F.struct(value.alias("v"), children(value).alias("inside"))

    def is_open(s: Column) -> Column:
        return F.size(s["inside"]) > 0

    def open_up(s: Column) -> Column:
        """A value and, behind it, the holders that were inside: the list stays in document order."""
        own = F.struct(s["v"].alias("v"), F.array().cast("array<variant>").alias("inside"))
        return F.concat(F.array(own), F.filter(F.transform(s["inside"], holder), is_open))

    def descend(value: Column) -> Column:
        def further(found: Column, _: Column) -> Column:
            return F.when(F.exists(found, is_open), F.flatten(F.transform(found, open_up))).otherwise(found)

        levels = F.sequence(F.lit(1), F.greatest(depth, F.lit(1)))
        start = F.filter(F.array(holder(value)), is_open)
        return F.aggregate(levels, start, further, lambda found: F.transform(found, lambda s: s["v"]))

    return _all(descend)


def split_head(path: str) -> tuple[str, str]:
    """The steps by names and numbers that a path begins with, in one spelling, and a path for the rest: paths that
    begin alike share what the first leads to."""
    found = _HEAD.match(path)
    if not found or found.end() == len(path):
        return "$", path
    return "$" + re.sub(rf"\.({_NAME})", r"['\1']", found["head"]), "$" + path[found.end() :]


def compile_path(path: str) -> Callable[[Column, Column], Column]:
    """``(variant, depth) -> array of variants``; ``depth`` is only looked at by ``..``."""
    if not path.startswith("$") or len(path) < 2:
        raise ValueError(f"cannot read JSON path {path!r}")
    steps: list[Step | None] = []  # None stands for ``..``
    at = 1
    while at < len(path):
        found = _TOKEN.match(path, at)
        after_deep = bool(steps) and steps[-1] is None
        if not found or (found["name"] and not (after_deep or path[at] == ".")):
            raise ValueError(f"cannot read JSON path {path!r} at {path[at:]!r}")
        at = found.end()
        if found["deep"]:
            steps.append(None)
        elif found["any"]:
            steps.append(_all(children))
        elif found["name"]:
            steps.append(_member(f"['{found['name']}']"))
        elif found["quoted"]:
            steps.append(_member(f"[{found['quoted']}]"))
        elif found["indexes"]:
            steps.append(_indexes([int(n) for n in found["indexes"].split(",")]))
        elif found["slice"]:
            ends = [int(e) if e.strip() else None for e in found["slice"].split(":")]
            steps.append(_slice(*ends))
        else:
            end = path.find(")]", at)
            if end < 0:
                raise ValueError(f"no end of filter in JSON path {path!r}")
            steps.append(_filter(parse_condition(path[at:end])))
            at = end + 2
    if steps[-1] is None:
        raise ValueError(f"nothing after .. in JSON path {path!r}")

    def run(value: Column, depth: Column) -> Column:
        values = F.when(value.isNull(), F.array().cast("array<variant>")).otherwise(F.array(value))
        for step in steps:
            values = (step or _below(depth))(values)
        return values

    return run


def depth_of(text: Column) -> Column:
    """A bound on how deep the values of a JSON text are nested: its opening brackets, but at most as many as
    the JSON parser itself lets a document nest."""
    opening = F.lit(0)
    for bracket in "{[":
        opening = opening + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(bracket), F.lit("")))
    return F.least(opening, F.lit(MOST_NESTED))


# Documents nested deeper are no records: the parser refuses them.
MOST_NESTED = 1000
