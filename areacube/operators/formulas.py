"""Indicator formulas as text, evaluated on a wide cube (MET6).

The ``Indicators`` table of a cube gives some indicators a ``Formula``: sums, differences,
products and quotients of other indicators, numbers and brackets, such as
``(A_1/(A_1+A_2))*100``.  An indicator may refer to others with formulas.

Codes may hold signs that are no part of a name elsewhere, so the codes of the cube
and of the table are found in the text first, longest first and at word bounds;
what is left is ordinary arithmetic with the usual precedence, which Python's own
expression grammar reads.  Indicators are ordered by what they refer to and added
level by level, so each is computed once, as plain columns that Catalyst plans.

A quotient is ``try_divide``: a zero or NULL below the line gives NULL, never an
error or NaN; NULL in any part gives NULL.  An unknown name, a formula that
cannot be read, a circle and a code given twice stop the job with the
indicator's name in the message.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Mapping
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of an indicator table (a job parameter) that are read to the plan at most.
MAX_INDICATORS = 10_000

_BINARY = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: F.try_divide}
_UNARY = {ast.USub: lambda a: -a, ast.UAdd: lambda a: a}


class FormulaError(ValueError):
    """A formula that cannot be evaluated."""


def read_formulas(indicators: DataFrame, code: str = "Indicator code", formula: str = "Formula") -> dict[str, str | None]:
    """code -> formula text (None: the indicator is a column of the cube) of an ``Indicators`` table."""
    rows = indicators.select(code, formula).take(MAX_INDICATORS + 1)
    if len(rows) > MAX_INDICATORS:
        raise FormulaError(f"more than {MAX_INDICATORS} indicators")
    out: dict[str, str | None] = {}
    for name, text in rows:
        if name in out:
            raise FormulaError(f"indicator {name!r} is given twice")
        out[name] = text if text and text.strip() else None
    return out


class Formula:
    """One formula: the codes it refers to and its column."""

    def __init__(self, name: str, text: str, codes: list[str]):
        self.name, self.text, self.refers = name, text, []
        self.tree = self._read(codes)
        self._check(self.tree)

    def _read(self, codes: list[str]) -> ast.expr:
        marks: dict[str, str] = {}

        def mark(found: re.Match) -> str:
            code = found[0]
            if code not in marks:
                marks[code] = f"__{len(marks)}__"
                self.refers.append(code)
            return f" {marks[code]} "
        known = "|".join(re.escape(c) for c in sorted(codes, key=len, reverse=True))
        text = re.sub(rf"(?<![\w.])(?:{known})(?!\w)", mark, self.text) if codes else self.text
        self.marks = {m: c for c, m in marks.items()}
        try:
            return ast.parse(text.strip(), mode="eval").body
        except (SyntaxError, ValueError) as e:
            raise FormulaError(f"formula of {self.name!r} cannot be read: {self.text!r}") from e

    def _check(self, node: ast.expr) -> None:
        if isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
            self._check(node.left)
            self._check(node.right)
        elif isinstance(node, ast.UnaryOp) and type(node.op) in _UNARY:
            self._check(node.operand)
        elif isinstance(node, ast.Name):
            if node.id not in self.marks:
                raise FormulaError(f"formula of {self.name!r} names {node.id!r}, which is neither a column nor an indicator")
        elif not (isinstance(node, ast.Constant) and type(node.value) in (int, float)):
            raise FormulaError(f"formula of {self.name!r} holds more than arithmetic: {self.text!r}")

    def column(self) -> Column:
        return self._column(self.tree)

    def _column(self, node: ast.expr) -> Column:
        if isinstance(node, ast.BinOp):
            return _BINARY[type(node.op)](self._column(node.left), self._column(node.right))
        if isinstance(node, ast.UnaryOp):
            return _UNARY[type(node.op)](self._column(node.operand))
        if isinstance(node, ast.Name):
            return F.col("`" + self.marks[node.id].replace("`", "``") + "`").cast("double")
        return F.lit(float(node.value))


def formula_levels(columns: list[str], formulas: Mapping[str, str | None]) -> list[list[Formula]]:
    """The formulas in the order of their evaluation: those of one list refer to
    columns and to formulas of earlier lists only."""
    missing = sorted(c for c, text in formulas.items() if text is None and c not in columns)
    if missing:
        raise FormulaError(f"indicators without a formula that the cube lacks: {missing}")
    codes = list(dict.fromkeys([*columns, *formulas]))
    read = {name: Formula(name, text, codes) for name, text in formulas.items() if text is not None}
    order = TopologicalSorter({name: [r for r in f.refers if r in read] for name, f in read.items()})
    try:
        order.prepare()
    except CycleError as e:
        raise FormulaError("indicators refer to each other in a circle: " + " <- ".join(e.args[1])) from e
    levels = []
    while order.is_active():
        ready = order.get_ready()
        levels.append([read[name] for name in ready])
        order.done(*ready)
    return levels


def evaluate_indicators(cube: DataFrame, indicators: DataFrame | Mapping[str, str | None]) -> DataFrame:
    """MET6: the cube with a column per indicator that has a formula, in the table's order.

    ``indicators`` is the cube's ``Indicators`` table or a mapping code -> text.
    A column of the cube that has a formula too is replaced by its value."""
    formulas = read_formulas(indicators) if isinstance(indicators, DataFrame) else dict(indicators)
    levels = formula_levels(cube.columns, formulas)
    out = reduce(lambda df, level: df.withColumns({f.name: f.column() for f in level}), levels, cube)
    added = [c for c, text in formulas.items() if text is not None and c not in cube.columns]
    return out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in [*cube.columns, *added]])
