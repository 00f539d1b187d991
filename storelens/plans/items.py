"""Order-item sequence features, review and delivery analyses.

The per-product sequence (order number, first/previous ship date, previous
item's price) comes from ``storelens.operators.sequences``, one plan for products
of any size.  Sort keys get the order id and then all other columns as tie-breaks,
so numbering is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.dates import add_days, calendar_days_between, whole_days_between
from storelens.functions.numeric import cents, exact_mean, wide_sum
from storelens.operators.sequences import SequenceSpec, sequence_features
from storelens.operators.summaries import key_profile

MONEY = "decimal(38,2)"
# Sellers are large next to products: their sequences are cut finer.
SELLER_ROWS_PER_BUCKET = 500_000
ITEM_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id",
                "shipping_limit_date", "price", "freight_value"]


def item_spec() -> SequenceSpec:
    return SequenceSpec(
        partition_by="product_id",
        order_by=["shipping_limit_date", "order_item_id", "order_id"],
        first_of="shipping_limit_date", lag_of="shipping_limit_date",
        prev_count_of="order_id",
        prev_sums={"previous_order_price_sum": F.col("price"),
                   "previous_order_total_price_sum": F.col("freight_value") + F.col("price")},
        row_number_name="order_number", first_name="first_date",
        lag_name="previous_date", prev_count_name="previous_order_count")


def item_sequence(items: DataFrame, frame: str = "previous_row", **kw) -> DataFrame:
    """Items plus all sequence features (money sums as decimal(38,2)).

    ``frame="all_previous"`` counts and sums over all earlier items of the
    product (what the source's comment describes) instead of exactly the
    previous one (what its SQL does).
    """
    spec = item_spec()
    spec.frame = frame
    f = sequence_features(items, spec, **kw)
    return f.withColumns({c: F.col(c).cast(MONEY) for c in
                          ("previous_order_price_sum", "previous_order_total_price_sum")})


def _days(kind: str):
    if kind == "calendar":
        return calendar_days_between
    if kind == "whole":
        return whole_days_between
    raise ValueError("day semantics must be calendar|whole")


def key_uniqueness_profile(items: DataFrame) -> DataFrame:
    """Row count and exact distinct counts of candidate keys."""
    return key_profile(items, "order_items_coun", {
        "distinct_order_count": ["order_id"],
        "distinct_product_count": ["product_id"],
        "distinct_order_product_count": ["order_id", "product_id"],
        "distinct_item_count": ["order_item_id"],
        "distinct_order_item_count": ["order_id", "order_item_id"],
    })


def _preview(df: DataFrame, limit: int | None) -> DataFrame:
    """Any ``limit`` rows (the source's bare LIMIT), or all of them."""
    return df if limit is None else df.limit(limit)


def item_order_number(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Every item with its order number within its product."""
    return _preview(item_sequence(items).select(*ITEM_COLUMNS, "order_number"), limit)


def item_first_prev_date(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Items + order number, product's first ship date, previous ship date."""
    return _preview(item_sequence(items).select(
        *ITEM_COLUMNS, "order_number", "first_date", "previous_date"), limit)


def item_prev_frame_stats(items: DataFrame, frame: str = "previous_row",
                          limit: int | None = None) -> DataFrame:
    """... + count and price sum over exactly the previous item."""
    return _preview(item_sequence(items, frame).select(
        *ITEM_COLUMNS, "order_number", "first_date", "previous_date",
        "previous_order_count", "previous_order_price_sum"), limit)


def seller_item_order_number(items: DataFrame) -> DataFrame:
    """Every item with its order number within its seller: few, large entities."""
    spec = item_spec()
    spec.partition_by = "seller_id"
    return sequence_features(items, spec, rows_per_bucket=SELLER_ROWS_PER_BUCKET).select(
        *ITEM_COLUMNS, "order_number", "first_date", "previous_date")


def item_feature_summary(items: DataFrame, first_midpoint_days: int | None = None,
                         previous_midpoint_days: int | None = None,
                         previous_anchor: str = "first_date_min",
                         days: str = "calendar") -> DataFrame:
    """Midpoint and maximum of first/previous dates; mean and extremes of the
    previous-item count and price.

    Midpoints default to floor(span / 2) days (the source pasted the numbers
    it saw).  The previous-date midpoint is anchored at the minimum *first*
    date, as in the source; ``previous_anchor="previous_date_min"`` anchors it
    at the minimum previous date instead.
    """
    f = item_sequence(items)
    dd = _days(days)
    a = f.agg(
        F.max("first_date").alias("first_date_MAX"), F.min("first_date").alias("first_date_MIN"),
        F.max("previous_date").alias("previous_date_MAX"),
        F.min("previous_date").alias("previous_date_MIN"),
        F.max("previous_order_count").alias("previous_order_count_MAX"),
        exact_mean(F.sum("previous_order_count"), F.count("previous_order_count"), 2)
        .alias("previous_order_count_AVG"),
        F.max("previous_order_price_sum").alias("previous_order_price_sum_MAX"),
        F.min("previous_order_price_sum").alias("previous_order_price_sum_MIN"),
        exact_mean(wide_sum(cents("previous_order_price_sum")),
                   F.count("previous_order_price_sum"), 2, unit_scale=2).alias("previous_order_price_sum_AVG"))
    half = lambda c: F.call_function("div", c, F.lit(2))
    m1 = F.lit(first_midpoint_days) if first_midpoint_days is not None else \
        half(dd("first_date_MAX", "first_date_MIN"))
    m2 = F.lit(previous_midpoint_days) if previous_midpoint_days is not None else \
        half(dd("previous_date_MAX", "previous_date_MIN"))
    anchor2 = "first_date_MIN" if previous_anchor == "first_date_min" else "previous_date_MIN"
    return a.select(add_days("first_date_MIN", m1.cast("int")).alias("average_first_date"),
                    "first_date_MAX",
                    add_days(anchor2, m2.cast("int")).alias("average_previous_date"),
                    "previous_date_MAX", "previous_order_count_AVG", "previous_order_count_MAX",
                    "previous_order_price_sum_MIN", "previous_order_price_sum_AVG",
                    "previous_order_price_sum_MAX")


def item_derived_features(items: DataFrame, days: str = "calendar") -> DataFrame:
    """Per item: order number, previous count/price sum, total price, days
    since the product's first and previous ship date, previous total."""
    f = item_sequence(items)
    dd = _days(days)
    return f.select(
        "order_id", "order_number", "previous_order_count", "previous_order_price_sum",
        F.round(F.col("price") + F.col("freight_value"), 2).cast(MONEY).alias("total_price"),
        dd("shipping_limit_date", "first_date").alias("days_since_first_date"),
        dd("shipping_limit_date", "previous_date").alias("days_since_previous_date"),
        F.round("previous_order_total_price_sum", 2).cast(MONEY)
        .alias("previous_order_total_price_sum"))


def order_review_score(reviews: DataFrame) -> DataFrame:
    """Per order: mean review score rounded half-up to a whole number."""
    return reviews.groupBy("order_id").agg(
        exact_mean(F.sum("review_score"), F.count("review_score"), 0).alias("review_score"))


def review_vs_item_features(items: DataFrame, reviews: DataFrame,
                            days: str = "calendar") -> DataFrame:
    """Mean item features per (rounded) order review score.

    Items with any NULL feature (each product's first item) are dropped; the
    NULL-score group (orders without reviews) is kept and sorts first.
    Features roll up per order before meeting the per-order scores, so the
    join is order-to-order, one row each.
    """
    feats = ["total_price", "order_number", "previous_order_count", "previous_order_price_sum",
             "previous_order_total_price_sum", "days_since_first_date", "days_since_previous_date"]
    f = item_derived_features(items, days)
    f = f.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in feats]))
    money = {"total_price", "previous_order_price_sum", "previous_order_total_price_sum"}
    per_order = f.groupBy("order_id").agg(
        F.count("order_id").alias("n_oid"), F.count(F.lit(1)).alias("n"),
        *[F.sum(cents(c) if c in money else F.col(c)).alias(c) for c in feats])
    j = per_order.join(order_review_score(reviews), "order_id", "left")
    n = F.sum("n")
    out = j.groupBy("review_score").agg(
        F.sum("n_oid").cast("bigint").alias("order_count"),
        exact_mean(wide_sum("total_price"), n, 0, unit_scale=2).alias("avg_total_price"),
        exact_mean(wide_sum("order_number"), n, 0).alias("avg_order_number"),
        exact_mean(wide_sum("previous_order_count"), n, 2).alias("avg_previous_order_number_count"),
        exact_mean(wide_sum("previous_order_price_sum"), n, 0, unit_scale=2)
        .alias("avg_previous_order_price_sum"),
        exact_mean(wide_sum("previous_order_total_price_sum"), n, 0, unit_scale=2)
        .alias("avg_previous_order_total_price_sum"),
        exact_mean(wide_sum("days_since_first_date"), n, 0).alias("avg_days_since_first_date"),
        exact_mean(wide_sum("days_since_previous_date"), n, 0).alias("avg_days_since_previous_date"))
    return out.orderBy(F.col("review_score").asc_nulls_first())


def review_vs_delivery_delay(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean calendar days purchase->delivery and estimate->delivery (negative:
    early) per rounded order review score.

    Delivered orders are de-duplicated per order id: the row that is first
    both by purchase time and by estimated date survives (ties broken by the
    remaining dates), so an id whose two orderings disagree disappears.  The
    two "first" rows come from min-of-struct aggregates, which combine
    map-side; no per-order window task.
    """
    p, e, d = "order_purchase_timestamp", "order_estimated_delivery_date", \
        "order_delivered_customer_date"
    dl = orders.where(F.col(d).isNotNull())
    per = dl.groupBy("order_id").agg(F.min(F.struct(p, e, d)).alias("a"),
                                     F.min(F.struct(e, p, d)).alias("b"))
    same = (F.col(f"a.{p}").eqNullSafe(F.col(f"b.{p}")) & F.col(f"a.{e}").eqNullSafe(F.col(f"b.{e}"))
            & F.col(f"a.{d}").eqNullSafe(F.col(f"b.{d}")))
    days = per.where(same).select(
        "order_id",
        calendar_days_between(F.col(f"a.{d}"), F.col(f"a.{p}")).alias("dp"),
        calendar_days_between(F.col(f"a.{d}"), F.col(f"a.{e}")).alias("de"))
    j = days.join(order_review_score(reviews), "order_id", "left")
    return (j.groupBy("review_score").agg(
        exact_mean(F.sum("dp"), F.count("dp"), 0).alias("days_difference_purchase"),
        exact_mean(F.sum("de"), F.count("de"), 0).alias("days_difference_estimated"))
        .orderBy(F.col("review_score").asc_nulls_first()))
