"""E-commerce store views (orders, customers, payments, reviews, items).

The analyses read a store schema; these adapters derive it from the
TPC-H-style test tables.  The mapping rules are fixed values shared with the
SQL oracle (``storelens.plans.oracle``) and documented in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.sources.tables import Tables

# Order status codes of the test tables and their store names.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "canceled"}
# Fixed value: days from purchase to the estimated delivery date.
ESTIMATED_DELIVERY_DAYS = 30

PRICE_TYPE = "decimal(12,2)"
FREIGHT_TYPE = "decimal(14,2)"


def _status(code: Column) -> Column:
    expr = None
    for k, v in STATUS_BY_CODE.items():
        expr = (F.when(code == k, v) if expr is None else expr.when(code == k, v))
    return expr


def order_shipping(t: Tables) -> DataFrame:
    """Per order: first ship date of finished lines, last ship date overall.

    A partial (map-side) aggregate on the order key, so a hot order costs one
    row per map task in the shuffle.
    """
    li = t.lineitem
    return li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min(F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")))
        .alias("order_delivered_carrier_date"),
        F.max("l_shipdate").alias("order_delivered_customer_date"),
    )


def orders(t: Tables, with_delivery: bool = True) -> DataFrame:
    """orders(order_id, customer_id, order_status, order_purchase_timestamp,
    order_delivered_carrier_date, order_delivered_customer_date,
    order_estimated_delivery_date).

    ``with_delivery=False`` skips the line-item aggregate for analyses that do
    not read the two delivery dates.
    """
    o = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _status(F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )
    est = F.timestamp_add("DAY", F.lit(ESTIMATED_DELIVERY_DAYS),
                          F.col("order_purchase_timestamp"))
    if not with_delivery:
        return o.withColumn("order_estimated_delivery_date", est)
    return (o.join(order_shipping(t), "order_id", "left")
            .select("order_id", "customer_id", "order_status",
                    "order_purchase_timestamp", "order_delivered_carrier_date",
                    "order_delivered_customer_date",
                    est.alias("order_estimated_delivery_date")))


def handed_orders(t: Tables) -> DataFrame:
    """order_id of every finished line: orders given to a carrier (repeats)."""
    finished = (F.col("l_linestatus") == "F") & F.col("l_shipdate").isNotNull()
    return t.lineitem.where(finished).select(F.col("l_orderkey").alias("order_id"))


def customers(t: Tables) -> DataFrame:
    """customers(customer_id, customer_unique_id, customer_city).

    Two customer ids map to one person (unique id), so analyses that group
    by person exercise the many-to-one mapping.
    """
    c = t.customer
    n = t.nation.select(F.col("n_nationkey"), F.col("n_name").alias("customer_city"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"),
                    "customer_city"))


def persons(t: Tables) -> DataFrame:
    """customers without their city, for analyses that don't read it (no join with the nations)."""
    return t.customer.select(F.col("c_custkey").alias("customer_id"),
                             (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"))


def order_payments(t: Tables) -> DataFrame:
    """order_payments(order_id, payment_value): several payments per order."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast(PRICE_TYPE).alias("payment_value"))


def order_reviews(t: Tables) -> DataFrame:
    """order_reviews(order_id, review_score 1..5)."""
    return t.lineitem.select(F.col("l_orderkey").alias("order_id"),
                             F.ceil(F.col("l_quantity") / 10).cast("int").alias("review_score"))


def order_items(t: Tables) -> DataFrame:
    """order_items(order_id, order_item_id, product_id, seller_id,
    shipping_limit_date, price, freight_value)."""
    price = F.col("l_extendedprice").cast(PRICE_TYPE)
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast(FREIGHT_TYPE).alias("freight_value"),
    )
