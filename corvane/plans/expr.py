"""Row predicates written as Python-style expressions, as null-safe columns.

Missing values compare as they do in the frame queries users write: ``x != v``
is true for a missing x, every other comparison is false. The text is parsed
with Python's own grammar; only names, literals, comparisons, arithmetic,
and/or/not (also ``& | ~``), ``in`` lists and a few text methods are allowed.
"""

from __future__ import annotations

import ast
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


class ExpressionError(ValueError):
    """The expression cannot be understood, or names an unknown column."""


_COMPARE = {
    ast.Eq: lambda a, b: F.coalesce(a == b, F.lit(False)),
    ast.NotEq: lambda a, b: ~a.eqNullSafe(b),
    ast.Lt: lambda a, b: F.coalesce(a < b, F.lit(False)),
    ast.LtE: lambda a, b: F.coalesce(a <= b, F.lit(False)),
    ast.Gt: lambda a, b: F.coalesce(a > b, F.lit(False)),
    ast.GtE: lambda a, b: F.coalesce(a >= b, F.lit(False)),
}
_ARITHMETIC = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: lambda a, b: F.try_divide(a, b), ast.Mod: lambda a, b: F.try_mod(a, b)}


def predicate(text: str, columns: Iterable[str]) -> Column:
    """The expression as a boolean column without nulls; blank: always true."""
    if not text or not text.strip():
        return F.lit(True)
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as e:
        raise ExpressionError(f"cannot parse {text!r}") from e
    return F.coalesce(_build(tree, set(columns)).cast("boolean"), F.lit(False))


def _build(node: ast.AST, names: set[str]) -> Column:
    sub = lambda n: _build(n, names)
    if isinstance(node, ast.Constant):
        return F.lit(node.value)
    if isinstance(node, ast.Name):
        if node.id in ("True", "False", "None"):
            return F.lit({"True": True, "False": False, "None": None}[node.id])
        if node.id not in names:
            raise ExpressionError(f"unknown column {node.id}")
        return F.col(node.id)
    if isinstance(node, ast.UnaryOp):
        if isinstance(node.op, ast.USub):
            return -sub(node.operand)
        if isinstance(node.op, (ast.Not, ast.Invert)):
            return ~F.coalesce(sub(node.operand), F.lit(False))
    if isinstance(node, ast.BoolOp):
        parts = [F.coalesce(sub(v), F.lit(False)) for v in node.values]
        out = parts[0]
        for p in parts[1:]:
            out = (out & p) if isinstance(node.op, ast.And) else (out | p)
        return out
    if isinstance(node, ast.BinOp):
        if isinstance(node.op, ast.BitAnd):
            return F.coalesce(sub(node.left), F.lit(False)) & F.coalesce(sub(node.right), F.lit(False))
        if isinstance(node.op, ast.BitOr):
            return F.coalesce(sub(node.left), F.lit(False)) | F.coalesce(sub(node.right), F.lit(False))
        if type(node.op) in _ARITHMETIC:
            return _ARITHMETIC[type(node.op)](sub(node.left), sub(node.right))
    if isinstance(node, ast.Compare):
        out, left = None, node.left
        for op, right in zip(node.ops, node.comparators):
            if isinstance(op, (ast.In, ast.NotIn)):
                if not isinstance(right, (ast.List, ast.Tuple, ast.Set)):
                    raise ExpressionError("'in' needs a list of literals")
                one = F.coalesce(sub(left).isin([ast.literal_eval(x) for x in right.elts]), F.lit(False))
                one = ~one if isinstance(op, ast.NotIn) else one
            elif type(op) in _COMPARE:
                one = _COMPARE[type(op)](sub(left), sub(right))
            else:
                raise ExpressionError("comparison not allowed")
            out, left = one if out is None else out & one, right
        return out
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute):
        base, how = node.func.value, node.func.attr
        base = base.value if isinstance(base, ast.Attribute) and base.attr == "str" else base
        args = [ast.literal_eval(a) for a in node.args]
        text = sub(base)
        made = {
            "isna": lambda: text.isNull(), "isnull": lambda: text.isNull(), "notna": lambda: text.isNotNull(), "notnull": lambda: text.isNotNull(),
            "contains": lambda: F.coalesce(text.rlike(args[0]), F.lit(False)), "startswith": lambda: F.coalesce(F.startswith(text, F.lit(args[0])), F.lit(False)),
            "endswith": lambda: F.coalesce(F.endswith(text, F.lit(args[0])), F.lit(False)), "len": lambda: F.length(text), "lower": lambda: F.lower(text), "isin": lambda: F.coalesce(text.isin(args[0]), F.lit(False)),
        }.get(how)
        if made:
            return made()
    raise ExpressionError(f"not allowed: {ast.dump(node)[:80]}")
