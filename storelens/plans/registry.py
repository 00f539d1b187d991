"""Registry of the statement-level analyses: key -> (spark, data_dir) -> DataFrame.

source hard-coded from its own data are set to the values that fit the
test tables (FIXTURES.md section 4); the library defaults keep the source's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelens.plans import commerce as cm
from storelens.plans import films as fm
from storelens.plans import items as it
from storelens.plans import loyalty as ly
from storelens.sources import commerce as sc
from storelens.sources import rental as sr
from storelens.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters for the test tables (FIXTURES.md section 4).
SELECTIVE_GAP_DAYS = 2000
TEST_COST_THRESHOLD = 950.0
TEST_LENGTH_THRESHOLD = 26
TEST_FAVOURED_CATEGORY = "PROMO"
TEST_EXCLUDED_CATEGORY = "LARGE"
# The test tables' suppliers stand for actors, with some 500 films each at SF 0.01.
TEST_POPULARITY_FLOORS = (514, 516, 518, 520)
TEST_LIKELIHOOD_HIGH, TEST_LIKELIHOOD_LOW = 518, 514
# Category lists for the intended (IN / NOT IN) reading of S34.
TEST_FAVOURED_CATEGORIES = ("PROMO", "SMALL", "MEDIUM")
TEST_EXCLUDED_CATEGORIES = ("LARGE", "ECONOMY", "STANDARD")


def _commerce(fn, *views, **kw) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        t = Tables(spark, root)
        return fn(*[v(t) for v in views], **kw)
    return run


def _orders_light(t):
    return sc.orders(t, with_delivery=False)


def _film_side(fn, **kw) -> Query:
    """Views for analyses over the film / rental-copy side."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        t = Tables(spark, root)
        return fn(sr.films(t), sr.inventory(t), sr.film_rentals(t), **kw)
    return run


def _film_dims(fn, **kw) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        t = Tables(spark, root)
        return fn(sr.film_rentals(t), sr.inventory(t), sr.films(t),
                  sr.film_category(t), sr.category(t), **kw)
    return run


def _having(spark: SparkSession, root: str) -> DataFrame:
    return ly.above_average_payers_having(spark, sr.payments(Tables(spark, root)))


def _likelihood(spark: SparkSession, root: str) -> DataFrame:
    t = Tables(spark, root)
    return fm.rental_likelihood_by_category(
        sr.films(t), sr.stock(t), None, sr.stock(t), sr.film_category(t), sr.category(t),
        favoured=TEST_FAVOURED_CATEGORY, excluded=TEST_EXCLUDED_CATEGORY,
        high=TEST_LIKELIHOOD_HIGH, low=TEST_LIKELIHOOD_LOW)


def _likelihood_intended(spark: SparkSession, root: str) -> DataFrame:
    t = Tables(spark, root)
    return fm.rental_likelihood_by_category(
        sr.films(t), sr.stock(t), None, sr.stock(t), sr.film_category(t), sr.category(t),
        favoured=list(TEST_FAVOURED_CATEGORIES), excluded=list(TEST_EXCLUDED_CATEGORIES),
        high=TEST_LIKELIHOOD_HIGH, low=TEST_LIKELIHOOD_LOW, key_on_rental_side=True)


def _category_popularity(spark: SparkSession, root: str) -> DataFrame:
    t = Tables(spark, root)
    return fm.category_popularity(sr.films(t), sr.stock(t), None, sr.film_category(t), sr.category(t))


def _bands(spark: SparkSession, root: str) -> DataFrame:
    t = Tables(spark, root)
    return fm.rentals_by_actor_popularity_band(sr.films(t), sr.stock(t), None, sr.stock(t),
                                               floors=TEST_POPULARITY_FLOORS)


def _category_view(spark: SparkSession, root: str) -> DataFrame:
    t = Tables(spark, root)
    return fm.film_category_view(sr.films(t), sr.film_category(t), sr.category(t))


QUERIES: dict[str, Query] = {
    # orders, customers and revenue
    "top_customer_by_orders": _commerce(cm.top_customer_by_orders, _orders_light, sc.persons),
    "canceled_handed_to_carrier_share": _commerce(cm.canceled_handed_to_carrier_share,
                                                  _orders_light, sc.handed_orders),
    "returning_customer_share": _commerce(cm.returning_customer_share, _orders_light,
                                          sc.persons),
    "long_gap_nondelivered_share": _commerce(cm.long_gap_nondelivered_share, _orders_light,
                                             sc.persons),
    "long_gap_nondelivered_share_v2": _commerce(cm.long_gap_nondelivered_share_v2,
                                                _orders_light, sc.persons),
    "long_gap_nondelivered_share_gap2000": _commerce(
        cm.long_gap_nondelivered_share, _orders_light, sc.persons,
        gap_days=SELECTIVE_GAP_DAYS),
    "long_gap_nondelivered_share_v2_gap2000": _commerce(
        cm.long_gap_nondelivered_share_v2, _orders_light, sc.persons,
        gap_days=SELECTIVE_GAP_DAYS),
    "monthly_canceled_revenue_share": _commerce(cm.monthly_canceled_revenue_share,
                                                _orders_light, sc.order_payments),
    "avg_review_by_status": _commerce(cm.avg_review_by_status, _orders_light, sc.order_reviews),
    "top_cities_by_avg_payment": _commerce(cm.top_cities_by_avg_payment, _orders_light,
                                           sc.order_payments, sc.customers),
    # order-item sequences, reviews and delivery
    "key_uniqueness_profile": _commerce(it.key_uniqueness_profile, sc.order_items),
    "item_order_number": _commerce(it.item_order_number, sc.order_items),
    "item_first_prev_date": _commerce(it.item_first_prev_date, sc.order_items),
    "item_prev_frame_stats": _commerce(it.item_prev_frame_stats, sc.order_items),
    "seller_item_order_number": _commerce(it.seller_item_order_number, sc.order_items),
    "item_feature_summary": _commerce(it.item_feature_summary, sc.order_items),
    "item_derived_features": _commerce(it.item_derived_features, sc.order_items),
    "review_vs_item_features": _commerce(it.review_vs_item_features, sc.order_items,
                                         sc.order_reviews),
    "review_vs_delivery_delay": _commerce(it.review_vs_delivery_delay, sc.orders,
                                          sc.order_reviews),
    # rental customers
    "rentals_per_customer_summary": _commerce(ly.rentals_per_customer_summary,
                                              sr.customer_rentals),
    "rentals_and_payments_summary": _commerce(ly.rentals_and_payments_summary,
                                              sr.customer_rentals, sr.payments),
    "above_average_payers": _commerce(ly.above_average_payers, sr.payments),
    "above_average_payers_having": _having,
    "avg_rental_days": _commerce(ly.avg_rental_days, sr.customer_rentals),
    "loyal_long_renters": _commerce(ly.loyal_long_renters, sr.payments, sr.customer_rentals),
    "low_pay_long_renters": _commerce(ly.low_pay_long_renters, sr.payments,
                                      sr.customer_rentals),
    "duration_distribution": _commerce(ly.duration_distribution, sr.payments,
                                       sr.customer_rentals),
    # film popularity
    "film_rental_view": _film_side(fm.rentals_per_film),
    "film_rental_summary": _film_side(fm.film_rental_summary),
    "film_rental_grouped_view": _film_side(fm.film_rental_grouped),
    "film_count_by_rental_group": _film_side(fm.film_count_by_rental_group),
    "film_category_view": _category_view,
    "category_popularity": _category_popularity,
    "actor_film_count": _commerce(fm.actor_film_count, sr.film_actor),
    "avg_actor_popularity": _commerce(fm.avg_actor_popularity, sr.film_actor),
    "rentals_by_actor_popularity_band": _bands,
    "rental_likelihood_by_category": _likelihood,
    "rental_calculation_view": _film_dims(fm.rental_calculation_view),
    "rating_ratio": _film_dims(fm.rating_ratio),
    "cost_group_rentals": _film_dims(fm.cost_group_rentals, threshold=TEST_COST_THRESHOLD),
    "length_group_rentals": _film_dims(fm.length_group_rentals,
                                       threshold=TEST_LENGTH_THRESHOLD),
    "rentals_per_staff": _film_dims(fm.rentals_per_staff),
    "returning_customer_share_persons": _commerce(cm.returning_customer_share, _orders_light,
                                                  sc.persons, count="persons"),
    "top_cities_by_avg_order": _commerce(cm.top_cities_by_avg_payment, _orders_light,
                                         sc.order_payments, sc.customers, per="order"),
    "item_prev_frame_stats_all_previous": _commerce(it.item_prev_frame_stats, sc.order_items,
                                                    frame="all_previous"),
    "rental_likelihood_by_category_intended": _likelihood_intended,
}


def _money_as_double(fn: Query) -> Query:
    """Registered results present exact decimal money as DOUBLE, so that every client
    that compares them reads one type; the library functions keep decimals, which
    stay exact to the cent where a double (above 2^53 cents) does not."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def run(spark: SparkSession, root: str) -> DataFrame:
        df = fn(spark, root)
        return df.select(*[F.col(f.name).cast("double").alias(f.name)
                           if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                           for f in df.schema.fields])
    return run


# the analyses as registered for the driver (library functions keep decimals)
LIBRARY_QUERIES = QUERIES
QUERIES = {k: _money_as_double(fn) for k, fn in LIBRARY_QUERIES.items()}
