"""Film-rental store views (rental, payment, film, inventory, categories,
actors), derived from the test tables.

Two rental views exist because the analyses read rentals from two sides:
``customer_rentals`` (one row per rental with its dates, for customer
loyalty) and ``film_rentals`` (one row per rented copy, for film popularity).
The mapping rules are fixed values shared with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.sources.tables import Tables

# Fixed values of the film-side adapter (FIXTURES.md section 3).
RENTAL_LINE_FACTOR = 10              # rental_id = order * factor + line number
STAFF_BY_LINESTATUS = {"F": 1, "O": 2}
AMOUNT_TYPE = "decimal(18,2)"


def customer_rentals(t: Tables) -> DataFrame:
    """rental(rental_id, customer_id, rental_date, return_date); return_date
    is NULL for rentals not yet returned."""
    back = t.lineitem.groupBy(F.col("l_orderkey").alias("rental_id")).agg(
        F.max("l_shipdate").alias("return_date"))
    o = t.orders.select(F.col("o_orderkey").alias("rental_id"),
                        F.col("o_custkey").alias("customer_id"),
                        F.col("o_orderdate").alias("rental_date"))
    return o.join(back, "rental_id", "left")


def payments(t: Tables) -> DataFrame:
    """payment(customer_id, amount)."""
    return t.orders.select(F.col("o_custkey").alias("customer_id"),
                           F.col("o_totalprice").cast(AMOUNT_TYPE).alias("amount"))


def films(t: Tables) -> DataFrame:
    """film(film_id, rental_rate, length, replacement_cost, rating)."""
    return t.part.select(F.col("p_partkey").alias("film_id"),
                         F.col("p_retailprice").alias("rental_rate"),
                         F.col("p_size").alias("length"),
                         F.col("p_retailprice").alias("replacement_cost"),
                         F.col("p_brand").alias("rating"))


def _inventory_id():
    # two keys in one struct: no packing that larger ids could make collide
    return F.struct(F.col("l_partkey").alias("film"), F.col("l_suppkey").alias("seller"))


def _copies(t: Tables) -> DataFrame:
    """Line items that name a copy: a film and a seller."""
    return t.lineitem.where("l_partkey is not null and l_suppkey is not null")


def inventory(t: Tables) -> DataFrame:
    """inventory(inventory_id, film_id): one row per stocked copy."""
    return _copies(t).select(_inventory_id().alias("inventory_id"),
                             F.col("l_partkey").alias("film_id")).distinct()


def stock(t: Tables) -> DataFrame:
    """stock(inventory_id, film_id, actor_id, rental_count): inventory, the rentals of each copy and
    the actor of its film in one aggregate of the line items.

    A plan that reads it in several roles has the same aggregate and shuffle several
    times, which Spark runs once: the condition below is always true, but keeps the
    count in every role, so column pruning can't make them differ.
    """
    line = F.col("l_orderkey") * RENTAL_LINE_FACTOR + F.col("l_linenumber")
    copies = _copies(t).groupBy("l_partkey", "l_suppkey").agg(F.count(line).alias("rental_count"))
    return copies.where("rental_count >= 0").select(
        _inventory_id().alias("inventory_id"), F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("actor_id"), "rental_count")


def film_rentals(t: Tables) -> DataFrame:
    """rental(rental_id, inventory_id, staff_id) as seen from the film side."""
    staff = None
    for k, v in STAFF_BY_LINESTATUS.items():
        c = F.col("l_linestatus") == k
        staff = F.when(c, F.lit(v)) if staff is None else staff.when(c, F.lit(v))
    return _copies(t).select(
        (F.col("l_orderkey") * RENTAL_LINE_FACTOR + F.col("l_linenumber")).alias("rental_id"),
        _inventory_id().alias("inventory_id"),
        staff.cast("int").alias("staff_id"))


def film_category(t: Tables) -> DataFrame:
    """film_category(film_id, category_id)."""
    return t.part.select(F.col("p_partkey").alias("film_id"),
                         F.col("p_type").alias("category_id"))


def category(t: Tables) -> DataFrame:
    """category(category_id, name)."""
    return t.part.select(F.col("p_type").alias("category_id"),
                         F.col("p_type").alias("name")).distinct()


def film_actor(t: Tables) -> DataFrame:
    """film_actor(actor_id, film_id)."""
    return _copies(t).select(F.col("l_suppkey").alias("actor_id"),
                              F.col("l_partkey").alias("film_id")).distinct()
