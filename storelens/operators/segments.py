"""Segmentation: threshold ladders, ordered scoring rules, two-way splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def step_ladder(value, steps: Sequence[tuple[float, object]], default,
                strict: bool = True) -> Column:
    """First ``label`` whose threshold the value exceeds (``>`` if strict,
    else ``>=``), checked in the given order; ``default`` otherwise
    (including NULL)."""
    v = _c(value)
    out = None
    for bound, label in steps:
        cond = (v > bound) if strict else (v >= bound)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def score_rules(rules: Sequence[tuple[Column, object]], default) -> Column:
    """CASE WHEN rule1 THEN s1 WHEN rule2 THEN s2 ... ELSE default."""
    out = None
    for cond, label in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def split_at(value, threshold, above=1, below=2, other=0) -> Column:
    """``above`` if value > threshold, ``below`` if value < threshold, else
    ``other`` (exactly equal, or NULL)."""
    v = _c(value)
    return (F.when(v > threshold, F.lit(above))
            .when(v < threshold, F.lit(below))
            .otherwise(F.lit(other)))
