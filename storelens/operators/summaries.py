"""Summaries: top-k with tie-breaks, min/mean/max profiles, key profiles,
scalar attachment of one-row aggregates.

Everything here is a partial (map-side combined) aggregate, a
TakeOrderedAndProject or a scalar subquery, so a hot key never lands whole in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.numeric import exact_mean


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str] = (),
          descending: bool = True) -> DataFrame:
    """The ``k`` first rows by ``by`` (desc by default, NULLs last), ties broken
    by ``tie_break`` ascending so the answer is deterministic.  Plans as
    TakeOrderedAndProject: each task keeps k rows, the driver merges."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
    return df.orderBy(first, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)


def min_mean_max(df: DataFrame, value: str, names: tuple[str, str, str],
                 mean_scale: int, unit_scale: int = 0) -> DataFrame:
    """One-row MIN / exact half-up rounded AVG / MAX of an integral column
    (or decimal money with ``unit_scale`` fraction digits)."""
    v = F.col(value)
    units = (v * (10 ** unit_scale)).cast("bigint") if unit_scale else v
    lo, mid, hi = names
    mn, mx = F.min(v), F.max(v)
    return df.agg(mn.alias(lo),
                  exact_mean(F.sum(units), F.count(v), mean_scale, unit_scale).alias(mid),
                  mx.alias(hi))


def key_profile(df: DataFrame, row_count_name: str,
                distinct: dict[str, Sequence[str]]) -> DataFrame:
    """Row count plus exact distinct counts of column sets (one row).

    Rows with a NULL in any column of a set are not counted for that set,
    the same rows a CONCAT-built key would skip.

    One aggregate over one scan: Spark expands each row to its key sets and
    de-duplicates (set, key) map-side before a single shuffle on the whole key, so
    neither a hot order nor a hot product meets one task.
    """
    return df.agg(F.count(F.lit(1)).alias(row_count_name),
                  *[F.count_distinct(*cols).alias(name) for name, cols in distinct.items()])


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row relation (a global aggregate) to every
    row, each as a scalar subquery (``DataFrame.scalar()``): computed once,
    then used as a value; no join."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])
