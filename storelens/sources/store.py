"""Store-shaped tables, as the analyses read them, from a folder or a catalog schema.

``Store(spark, root="/data/shop")`` reads ``/data/shop/orders.parquet`` and so on;
``Store(spark, schema="shop")`` reads ``spark.table("shop.orders")``.  ``run`` feeds
them to a plan function by the names of its parameters.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelens.plans import films as fm
from storelens.sources.tables import data_files

# A plan function's parameter and the table it names.
TABLE_OF = {
    "orders": "orders", "customers": "customers", "reviews": "order_reviews", "items": "order_items",
    "rentals": "rental", "films": "film", "inventory": "inventory", "film_actor": "film_actor",
    "film_category": "film_category", "category": "category",
}
# The two datasets name their payments differently.
PAYMENTS = ("order_payments", "payment")


class Store:
    """Tables of one store-shaped dataset, read lazily."""

    def __init__(self, spark: SparkSession, root: str | None = None, schema: str | None = None,
                 suffix: str = ".parquet"):
        if (root is None) == (schema is None):
            raise ValueError("give a folder (root) or a catalog schema, not both")
        self.spark, self.root, self.schema, self.suffix = spark, root, schema, suffix

    def has(self, name: str) -> bool:
        if self.schema is not None:
            return self.spark.catalog.tableExists(f"{self.schema}.{name}")
        return bool(data_files(self.spark, f"{self.root}/{name}{self.suffix}"))

    def table(self, name: str) -> DataFrame:
        if self.schema is not None:
            return self.spark.table(f"{self.schema}.{name}")
        return self.spark.read.parquet(f"{self.root}/{name}{self.suffix}")

    def run(self, plan: Callable[..., DataFrame], **options) -> DataFrame:
        """Call a plan function with the tables its parameters name."""
        given = {}
        for name in inspect.signature(plan).parameters:
            if name in options:
                continue
            if name == "spark":
                given[name] = self.spark
            elif name == "payments":
                given[name] = self.table(next((p for p in PAYMENTS if self.has(p)), PAYMENTS[0]))
            elif name in TABLE_OF:
                given[name] = self.table(TABLE_OF[name])
        return plan(**given, **options)


# The view names later statements read, and the analysis behind each.  The source
# first creates film_rental with two columns, then replaces it by the form with the rental group
# and goes on reading that one, which has the columns of both.
VIEWS: dict[str, Callable[..., DataFrame]] = {
    "film_rental": fm.film_rental_grouped,
    "film_rental_grouped": fm.film_rental_grouped,
    "film_category_name": fm.film_category_view,
    "rental_calculation": fm.rental_calculation_view,
}


def register_views(store: Store, names: dict[str, str] | None = None) -> None:
    """Create (or replace) the film views as temporary views of the session.

    ``names`` maps a view of VIEWS to the name to register it under.
    """
    for view, plan in VIEWS.items():
        store.run(plan).createOrReplaceTempView((names or {}).get(view, view))
