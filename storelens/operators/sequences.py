"""Per-entity sequence features: order number, first value, previous row.

For every row of an entity (e.g. every sold item of a product), ordered by a
total sort key, this adds

* ``row_number``  1, 2, ... within the entity (bigint),
* ``first``       the value of a column at the entity's first row,
* ``lag``         the value of a column at the previous row (NULL on the first),
* ``prev_count``  COUNT(col) over exactly the previous row (0 or 1),
* ``prev_sums``   SUM(expr) over exactly the previous row (its value, or NULL).

With ``frame="all_previous"`` the count and sums run over every earlier row
of the entity instead (running totals).

There is one plan for every size.  Rows are windowed per (entity, bucket).  Buckets
are ranges of (entity, whole sort key): the caller's columns, then every other
column, so null or equal dates part as well as distinct ones, and only rows alike in
every column stay together.  The ranges are cut at rows drawn by a hash of the row
from the entities of more than ``rows_per_bucket`` rows; where no entity is that
large there is no cut, and the rows are read and shuffled once.  The cuts are drawn
OVER times as densely as buckets need to be, so that no bucket comes near twice its
size by chance.  What a bucket needs from the ones before it (rows, totals, the
entity's first row, the last row before) is a small aggregate per bucket.

A row finds its bucket by binary search in the sorted cuts, which are one scalar
subquery and so a value that no row copies.  There are about
OVER * MAX_BUCKETS cuts at most (16 MB of 80-byte sort keys), since buckets grow with
the rows once large entities would need more than MAX_BUCKETS; the tables of large
entities (fewer than rows / rows_per_bucket) and of buckets are broadcast with
these bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 4_000_000
MAX_BUCKETS = 20_000
OVER = 10

_KEY, _BUCKET, _CARRY = "_seq_key", "_seq_bucket", "_seq_carry"
_CUTS, _AT, _SOME = "_seq_cuts", "_seq_at", "_seq_some"


@dataclass
class SequenceSpec:
    """What to compute and how to name it."""

    partition_by: str
    order_by: Sequence[str]
    first_of: str
    lag_of: str
    prev_count_of: str
    prev_sums: dict[str, Column] = field(default_factory=dict)
    row_number_name: str = "row_number"
    first_name: str = "first_value"
    lag_name: str = "previous_value"
    prev_count_name: str = "previous_count"
    # "previous_row": COUNT/SUM over exactly the previous row (ROWS 1 PRECEDING
    # AND 1 PRECEDING); "all_previous": over every earlier row of the entity.
    frame: str = "previous_row"


def _large_entities(df: DataFrame, key: str, rows_per_bucket: int) -> DataFrame:
    """(_seq_key, _n) of the entities with more rows than a bucket should hold."""
    return df.groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_bucket)


def _of(df: DataFrame, key: str, large: DataFrame) -> DataFrame:
    return df.join(F.broadcast(large.select(_KEY)), F.col(key).eqNullSafe(F.col(_KEY)), "left_semi")


def _cuts(df: DataFrame, key: str, order: Sequence[str], large: DataFrame, rows_per_bucket: int) -> DataFrame:
    """(_seq_at): the sort keys at which buckets of the large entities start.

    A row is a cut by the hash of all its columns: which rows are depends on the data alone.
    """
    size = F.greatest(F.lit(rows_per_bucket).cast("double"), large.agg(F.sum("_n")).scalar() / MAX_BUCKETS)
    draw = F.xxhash64(key, *order).bitwiseAND((1 << 63) - 1) / float(1 << 63)
    return _of(df, key, large).where(draw < OVER / size).select(F.struct(key, *order).alias(_AT)).distinct()


def _bucketed(df: DataFrame, key: str, order: Sequence[str], cuts: DataFrame, large: DataFrame) -> DataFrame:
    """The rows with _seq_bucket: how many cuts are at or below (entity, whole sort key), by binary search."""
    listed = cuts.agg(F.sort_array(F.collect_list(_AT)).alias(_CUTS)).scalar()
    some = large.agg(F.count(F.lit(1))).scalar() > 0
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((2 * OVER * MAX_BUCKETS).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda seen, step: F.when(
        F.get(_CUTS, seen + step - 1) <= F.col(_AT), seen + step).otherwise(seen))
    # A lambda function takes a subquery by way of a column only.  The optimizer folds that column into the
    # function, so no row carries the cuts, as each of the columns here is used once above the sort key's
    # projection (tests/test_sequences.py looks at the plan).
    keyed = df.select("*", F.struct(key, *order).alias(_AT))
    return keyed.select("*", listed.alias(_CUTS), some.alias(_SOME)).select(
        *[F.col(f"`{c}`") for c in df.columns], F.when(F.col(_SOME), found).otherwise(0).alias(_BUCKET))


def _local(s: SequenceSpec, order: Sequence[str], values: dict[str, str], *within: str) -> dict[str, Column]:
    """The features of a row among the rows of ``within``."""
    w = Window.partitionBy(*within).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = {"_rn": F.row_number().over(w).cast("bigint"), "_first": F.first(s.first_of).over(w),
             "_lag": F.lag(s.lag_of).over(w)}
    if s.frame == "all_previous":
        prev = w.rowsBetween(Window.unboundedPreceding, -1)
        local["_n"] = F.count(s.prev_count_of).over(prev)
        local.update({f"_s{v}": F.sum(v).over(prev) for v in values.values()})
    else:
        # COUNT / SUM over exactly the previous row are that row's values: LAG
        # gives them without a sliding aggregation buffer
        local["_n"] = F.lag(F.col(s.prev_count_of).isNotNull().cast("bigint"), 1, 0).over(w)
        local.update({f"_s{v}": F.lag(v).over(w) for v in values.values()})
    return local


def sequence_features(df: DataFrame, spec: SequenceSpec,
                      rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """All columns of ``df`` plus the sequence features of ``spec``."""
    s = spec
    if s.frame not in ("previous_row", "all_previous"):
        raise ValueError(f"frame must be previous_row|all_previous, got {s.frame!r}")
    values = {name: f"_seq_v{i}" for i, name in enumerate(s.prev_sums)}
    sum_types = dict(df.select(*[F.sum(e).alias(n) for n, e in s.prev_sums.items()]).dtypes) if values else {}
    base = df.select("*", *[e.alias(values[n]) for n, e in s.prev_sums.items()])
    order = [*s.order_by, *[c for c in base.columns if c not in s.order_by and c != s.partition_by]]
    running = s.frame == "all_previous"
    large = _large_entities(df, s.partition_by, rows_per_bucket)
    bucketed = _bucketed(base, s.partition_by, order, _cuts(base, s.partition_by, order, large, rows_per_bucket),
                         large)

    # per bucket of a large entity: what the buckets after it need
    ends = F.struct(*[F.col(c) for c in order])
    totals = {"_rows": F.count(F.lit(1)), "_cnt": F.count(s.prev_count_of),
              **{f"_sum{v}": F.sum(v) for v in values.values()}}
    summed = _of(bucketed, s.partition_by, large).groupBy(F.col(s.partition_by).alias(_KEY), _BUCKET).agg(
        F.min(ends).alias("_low"), F.max(ends).alias("_high"), *[e.alias(n) for n, e in totals.items()])
    earlier = Window.partitionBy(_KEY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = summed.select(
        F.col(_KEY).alias("_ck"), F.col(_BUCKET).alias("_cb"),
        F.struct(F.first("_low").over(earlier).alias("low"), F.last("_high").over(earlier).alias("high"),
                 *[F.sum(n).over(earlier).alias(n) for n in totals]).alias(_CARRY))
    carry = before.where(F.col(f"{_CARRY}._rows").isNotNull())       # the first bucket has none before it

    rows = bucketed.select("*", *[e.alias(n) for n, e in _local(s, order, values, s.partition_by, _BUCKET).items()])
    joined = rows.join(F.broadcast(carry), F.col(s.partition_by).eqNullSafe(F.col("_ck"))
                       & (F.col(_BUCKET) == F.col("_cb")), "left")
    carried = F.col(_CARRY).isNotNull()
    starts = carried & (F.col("_rn") == 1)          # first row of a later bucket

    def at(end: str, column: str) -> Column:
        return F.col(f"{_CARRY}.{end}.{column}")

    out = [(F.col("_rn") + F.coalesce(F.col(f"{_CARRY}._rows"), F.lit(0))).alias(s.row_number_name),
           F.when(carried, at("low", s.first_of)).otherwise(F.col("_first")).alias(s.first_name),
           F.when(starts, at("high", s.lag_of)).otherwise(F.col("_lag")).alias(s.lag_name)]
    if running:
        out.append((F.col("_n") + F.coalesce(F.col(f"{_CARRY}._cnt"), F.lit(0))).alias(s.prev_count_name))
    else:
        out.append(F.when(starts, at("high", s.prev_count_of).isNotNull().cast("bigint"))
                   .otherwise(F.col("_n")).alias(s.prev_count_name))
    for name, v in values.items():
        if running:     # NULL only where no earlier row has a value
            ahead = F.col(f"{_CARRY}._sum{v}")
            total = F.coalesce(F.col(f"_s{v}") + ahead, F.col(f"_s{v}"), ahead)
        else:
            total = F.when(starts, at("high", v)).otherwise(F.col(f"_s{v}"))
        out.append(total.cast(sum_types[name]).alias(name))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *out)
