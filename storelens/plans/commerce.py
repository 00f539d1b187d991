"""Orders, customers and revenue analyses (e-commerce store).

Inputs are the store-shaped DataFrames of ``storelens.sources.commerce``.
Scale notes shared by all of them:

* Facts are aggregated on their own key *before* they meet a dimension
  (orders per customer id, payments per order), so every join sees at most
  one row per key on the fact side and a hot customer or order costs one
  row per map task instead of a third of the shuffle.
* Dimension joins are left to Catalyst/AQE: they become broadcast joins
  when the runtime size is under ``spark.sql.autoBroadcastJoinThreshold``
  and sort-merge joins otherwise.  One-row global aggregates are used as
  scalar subqueries, not joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.dates import month_label, whole_days_between
from storelens.functions.numeric import (exact_mean, from_cents, half_up_ratio, money_sum,
                                         percent)
from storelens.operators.summaries import attach_scalar, top_k

CANCELED, DELIVERED = "canceled", "delivered"


def _person(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Attach ``customer_unique_id`` to per-customer-id rows (LEFT JOIN, so
    ids without a customer row land in the NULL person)."""
    return per_customer.join(customers.select("customer_id", "customer_unique_id"),
                             "customer_id", "left")


def top_customer_by_orders(orders: DataFrame, customers: DataFrame, k: int = 1) -> DataFrame:
    """Person with the most non-canceled orders -> customer_unique_id, order_count.

    Ties on the count go to the smallest person id (the source leaves them open).
    """
    per_id = (orders.where(F.col("order_status") != CANCELED)
              .groupBy("customer_id").agg(F.count("order_id").alias("n")))
    per_person = (_person(per_id, customers).groupBy("customer_unique_id")
                  .agg(F.sum("n").cast("bigint").alias("order_count")))
    return top_k(per_person, "order_count", k, tie_break=["customer_unique_id"])


def canceled_handed_to_carrier_share(orders: DataFrame, handed: DataFrame | None = None) -> DataFrame:
    """All orders, canceled orders, canceled orders handed to a carrier, and
    the share (0 when nothing is canceled).

    ``handed`` lists order ids given to a carrier (repeats allowed); only canceled
    orders meet it.  Without it, orders with an ``order_delivered_carrier_date`` are.
    """
    canceled = F.col("order_status") == CANCELED
    counts = orders.agg(F.count(F.lit(1)).alias("order_count"), F.count_if(canceled).alias("canceled_order_count"))
    if handed is None:
        handed = orders.where(F.col("order_delivered_carrier_date").isNotNull())
    met = orders.where(canceled).select("order_id").join(handed.select("order_id"), "order_id", "left_semi")
    both = attach_scalar(counts, met.agg(F.count(F.lit(1)).alias("n")))
    # SUM over zero canceled rows is NULL, as in the source
    given = F.when(F.col("canceled_order_count") > 0, F.col("n"))
    return both.select("order_count", "canceled_order_count",
                       given.alias("canceled_and_delivered_carrier_order_count"),
                       F.coalesce(given / F.col("canceled_order_count") * 100, F.lit(0.0))
                       .alias("canceled_and_delivered_carrier_order_percentage"))


def returning_customer_share(orders: DataFrame, customers: DataFrame,
                             count: str = "orders") -> DataFrame:
    """Distinct persons; delivered orders of persons with more than one
    delivered order; their percentage of the person count.

    The numerator counts *orders* of returning persons, as the source does;
    ``count="persons"`` counts the returning persons themselves (the intent
    stated by the column name).
    """
    all_people = customers.agg(
        F.countDistinct("customer_unique_id").alias("customer_count"))
    per_id = (orders.where(F.col("order_status") == DELIVERED)
              .groupBy("customer_id").agg(F.count("order_id").alias("n")))
    per_person = (per_id.join(customers.select("customer_id", "customer_unique_id"),
                              "customer_id", "inner")
                  .where(F.col("customer_unique_id").isNotNull())
                  .groupBy("customer_unique_id").agg(F.sum("n").alias("c"))
                  .where(F.col("c") > 1))
    num = F.sum("c") if count == "orders" else F.count(F.lit(1))
    returning = per_person.agg(num.cast("bigint").alias("returning_customer_count"))
    both = attach_scalar(all_people, returning)
    return both.select(
        "customer_count", "returning_customer_count",
        percent("returning_customer_count", "customer_count", 2, on_zero="error")
        .alias("returning_customer_percentage"))


def _gap_profile(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Per person: first to last purchase in whole days, number of non-delivered orders
    with a purchase time.  Aggregated per customer id first (map-side combined)."""
    ts = F.col("order_purchase_timestamp")
    nd = F.col("order_status") != DELIVERED
    per_id = orders.groupBy("customer_id").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.when(nd, ts)).alias("nd_ts"))
    return (_person(per_id, customers).groupBy("customer_unique_id").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("nd_ts").alias("nd_ts"))
        .withColumn("gap", whole_days_between("last_ts", "first_ts")))


def long_gap_nondelivered_share(orders: DataFrame, customers: DataFrame,
                                gap_days: int = 30) -> DataFrame:
    """Persons whose first-to-last purchase gap exceeds ``gap_days`` whole
    days; how many of them have a non-delivered order; percentage (fails on
    an empty cohort, like the unguarded source division)."""
    g = _gap_profile(orders, customers)
    long_gap = F.col("gap") > gap_days
    # the NULL person never matches the non-delivered side of the source join
    matched = (F.col("customer_unique_id").isNotNull() & (F.col("nd_ts") > 0))
    a = g.agg(F.count_if(long_gap).alias("returning_30d_customer_count"),
              F.count_if(long_gap & matched).alias("returning_30d_non_delivered_customer_count"))
    return a.select("*", percent("returning_30d_non_delivered_customer_count",
                                 "returning_30d_customer_count", 2, on_zero="error")
                    .alias("returning_30d_non_delivered_customer_percentage"))


def long_gap_nondelivered_share_v2(orders: DataFrame, customers: DataFrame,
                                   gap_days: int = 30) -> DataFrame:
    """Second formulation, by membership: the customer ids that stand among those with a
    non-delivered order are marked by a join, and a person with a marked id counts among
    the persons whose purchases lie further apart; percentage 0 when there is none."""
    undelivered = (orders.where(F.col("order_status") != DELIVERED).select("customer_id").distinct()
                   .withColumn("waits", F.lit(True)))
    spans = orders.groupBy("customer_id").agg(F.min("order_purchase_timestamp").alias("t0"),
                                              F.max("order_purchase_timestamp").alias("t1"))
    away = (_person(spans.join(undelivered, "customer_id", "left"), customers).groupBy("customer_unique_id")
            .agg(F.min("t0").alias("t0"), F.max("t1").alias("t1"), F.max("waits").alias("waits"))
            .where(whole_days_between("t1", "t0") > gap_days))
    num, den = "returning_30d_non_delivered_customer_count", "returning_30d_customer_count"
    # the NULL person is a member of nothing
    both = away.agg(F.count(F.lit(1)).alias(den),
                    F.count_if(F.col("waits") & F.col("customer_unique_id").isNotNull()).alias(num))
    pct = F.when(F.col(num) > 0, percent(num, den, 2, on_zero="error")).otherwise(F.lit(0.0))
    return both.select("*", pct.alias("returning_30d_percentage"))


def monthly_canceled_revenue_share(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Per purchase month: revenue, revenue of canceled orders (both rounded
    to cents first) and the lost percentage; months in calendar order."""
    # money is summed as bigint cents (exact, primitive); sums are already whole cents
    pay = payments.groupBy("order_id").agg(money_sum("payment_value").alias("paid"))
    j = (orders.select("order_id", "order_status", "order_purchase_timestamp")
         .join(pay, "order_id", "left"))
    ts = F.col("order_purchase_timestamp")
    g = j.groupBy(F.year(ts).alias("y"), F.month(ts).alias("m")).agg(
        F.sum("paid").alias("total_c"),
        F.sum(F.when(F.col("order_status") == CANCELED, F.col("paid"))
              .otherwise(F.lit(0).cast("decimal(38,0)")))
        .alias("lost_c"))
    total, lost = F.col("total_c"), F.col("lost_c")
    pct = F.when(total > 0, percent(lost, total, 2)).otherwise(F.lit(0.0))
    return (g.orderBy(F.col("y").asc_nulls_first(), F.col("m").asc_nulls_first())
            .select(month_label("y", "m").alias("order_month"),
                    from_cents(total).alias("order_payment_amount"),
                    from_cents(lost).alias("canceled_order_payment_amount"),
                    pct.alias("canceled_order_payment_percentage")))


def avg_review_by_status(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per order status: number of reviews and their mean score (2 digits)."""
    r = reviews.groupBy("order_id").agg(F.count("review_score").alias("c"),
                                        F.sum("review_score").alias("s"))
    j = orders.select("order_id", "order_status").join(r, "order_id", "left")
    return j.groupBy("order_status").agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("review_score_count"),
        exact_mean(F.sum("s"), F.coalesce(F.sum("c"), F.lit(0)), 2).alias("review_score_avg"))


def top_cities_by_avg_payment(orders: DataFrame, payments: DataFrame,
                              customers: DataFrame, k: int = 3, per: str = "payment") -> DataFrame:
    """Cities by mean payment row: payment rows, their sum, their mean; top k.

    ``per="order"`` divides by paid orders instead of payment rows (the
    "average order value" the source's comment names).  Payments roll up per
    order, then per customer id, before the city join.
    """
    pay = payments.groupBy("order_id").agg(F.count("payment_value").alias("c"),
                                           money_sum("payment_value").alias("s"))
    if per == "order":
        pay = pay.select("order_id", F.when(F.col("c") > 0, 1).otherwise(0).alias("c"), "s")
    per_id = (orders.select("order_id", "customer_id").join(pay, "order_id", "left")
              .groupBy("customer_id").agg(F.sum("c").alias("c"), F.sum("s").alias("s")))
    j = per_id.join(customers.select("customer_id", "customer_city"), "customer_id", "left")
    g = j.groupBy("customer_city").agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n"),
                                       F.sum("s").alias("s"))
    out = g.select("customer_city",
                   F.col("n").alias("order_payment_amount_coun"),
                   from_cents("s").alias("order_payment_amount_sum"),
                   half_up_ratio("s", F.col("n") * 100, 2).alias("order_payment_amount_avg"))
    return top_k(out, "order_payment_amount_avg", k, tie_break=["customer_city"])
