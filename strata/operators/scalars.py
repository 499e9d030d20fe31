"""Attaching one-row aggregates (scalars) to every row of a frame.

The only cross products in the library go through ``attach``: its right side must be a
global aggregate (no grouping keys), i.e. exactly one row, which is checked on the analysed
plan before it is broadcast. Nothing is paired; each row just gains the scalar columns.
This keeps the bound explicit and lets Spark reuse the exchanges the aggregate shares with
the main plan (a scalar subquery would recompute them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PASS_THROUGH = {"Project", "SubqueryAlias", "Filter", "ResolvedHint", "UnresolvedHint"}


def _one_row(node) -> bool:
    name = node.nodeName()
    if name in _PASS_THROUGH:
        return _one_row(node.child())
    if name == "Aggregate":
        return node.groupingExpressions().isEmpty()
    if name == "Join":  # a product of one-row frames has one row
        return _one_row(node.left()) and _one_row(node.right())
    return False


def is_one_row(df: DataFrame) -> bool:
    """True when the analysed plan is a global aggregate (or a product of them)."""
    return _one_row(df._jdf.queryExecution().analyzed())


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with the columns of the one-row ``one_row`` added to every row (broadcast)."""
    if not is_one_row(one_row):
        raise ValueError("attach() needs a global aggregate (exactly one row) on the right")
    return df.crossJoin(F.broadcast(one_row))


def product(*one_rows: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row aggregates."""
    out = one_rows[0]
    for o in one_rows[1:]:
        out = attach(out, o)
    return out
