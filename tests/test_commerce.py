"""E-commerce analyses on micro-fixtures (traps T1, T2, T12) and metamorphic pairs."""

from datetime import datetime as dt
from decimal import Decimal

import pytest

from storelens.plans import commerce as cm
from storelens.plans.registry import QUERIES

from conftest import SF_ORACLE, rows

ORD = ("order_id long, customer_id long, order_status string, order_purchase_timestamp "
       "timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
       "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
CUS = "customer_id long, customer_unique_id long, customer_city string"


def o(oid, cid, status, ts, carrier=None):
    return (oid, cid, status, ts, carrier, None, None)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([(1, 10, "Kyiv"), (2, 10, "Kyiv"), (3, 30, "Lviv"),
                                  (4, 40, "Odesa")], CUS)


def test_top_customer_tie_break_and_null_person(spark, customers):
    orders = spark.createDataFrame([
        o(1, 1, "delivered", dt(2020, 1, 1)), o(2, 2, "shipped", dt(2020, 1, 2)),
        o(3, 3, "delivered", dt(2020, 1, 3)), o(4, 3, "delivered", dt(2020, 1, 4)),
        o(5, 99, "delivered", dt(2020, 1, 5)), o(6, 99, "delivered", dt(2020, 1, 5)),
        o(7, 3, "canceled", dt(2020, 1, 6))], ORD)
    # persons 10 and 30 tie at 2, the orphan id 99 forms a NULL person with 2 (T2)
    assert rows(cm.top_customer_by_orders(orders, customers, k=3)) == \
        [(10, 2), (30, 2), (None, 2)]
    assert rows(cm.top_customer_by_orders(orders, customers)) == [(None, 2)]


def test_canceled_share_without_canceled_orders(spark):
    # mf_no_canceled: ratio 0, and the carrier count is NULL (SUM over no rows)
    orders = spark.createDataFrame([o(1, 1, "delivered", dt(2020, 1, 1), dt(2020, 1, 2))], ORD)
    r = cm.canceled_handed_to_carrier_share(orders).first()
    assert (r[0], r[1], r[2], r[3]) == (1, 0, None, 0.0)
    orders = spark.createDataFrame([o(1, 1, "canceled", dt(2020, 1, 1), dt(2020, 1, 2)),
                                    o(2, 1, "canceled", dt(2020, 1, 1)),
                                    o(3, 1, "canceled", dt(2020, 1, 1))], ORD)
    r = cm.canceled_handed_to_carrier_share(orders).first()
    assert (r[0], r[1], r[2]) == (3, 3, 1) and r[3] == pytest.approx(100 / 3)


def test_returning_share_counts_orders(spark, customers):
    orders = spark.createDataFrame([
        o(1, 1, "delivered", dt(2020, 1, 1)), o(2, 2, "delivered", dt(2020, 2, 1)),
        o(3, 3, "delivered", dt(2020, 1, 1)), o(4, 99, "delivered", dt(2020, 1, 1)),
        o(5, 99, "delivered", dt(2020, 1, 1))], ORD)
    # person 10 has 2 delivered orders (two ids); the NULL person is excluded (T3)
    assert rows(cm.returning_customer_share(orders, customers)) == [(3, 2, 66.67)]


def test_monthly_share_zero_and_null_months(spark):
    pay = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("30.00")),
                                 (2, Decimal("0.005"))], "order_id long, payment_value decimal(12,2)")
    orders = spark.createDataFrame([
        o(1, 1, "canceled", dt(2020, 1, 5)), o(2, 1, "delivered", dt(2020, 1, 6)),
        o(3, 1, "canceled", dt(2020, 2, 1)),            # mf_zero_month: no payment at all
        o(4, 1, "delivered", None)], ORD)
    got = [tuple(r) for r in cm.monthly_canceled_revenue_share(orders, pay).collect()]
    assert got[0] == (None, None, Decimal("0.00"), 0.0)
    assert got[1] == ("2020-01", Decimal("40.01"), Decimal("10.00"), 24.99)
    assert got[2] == ("2020-02", None, None, 0.0)


def test_gap_variants_agree_on_counts(spark):
    for gap in ("", "_gap2000"):
        a = QUERIES[f"long_gap_nondelivered_share{gap}"](spark, SF_ORACLE).first()
        b = QUERIES[f"long_gap_nondelivered_share_v2{gap}"](spark, SF_ORACLE).first()
        assert (a[0], a[1]) == (b[0], b[1])
        if b[1]:
            assert a[2] == b[2]


def test_gap_uses_whole_days(spark, customers):
    # 30 days and 23 hours: 30 whole days (not > 30), 31 calendar days
    orders = spark.createDataFrame([o(1, 3, "delivered", dt(2020, 1, 1, 0)),
                                    o(2, 3, "shipped", dt(2020, 1, 31, 23))], ORD)
    assert cm.long_gap_nondelivered_share_v2(orders, customers).first()[0] == 0
    orders = spark.createDataFrame([o(1, 3, "delivered", dt(2020, 1, 1, 0)),
                                    o(2, 3, "shipped", dt(2020, 2, 1, 0))], ORD)
    assert tuple(cm.long_gap_nondelivered_share_v2(orders, customers).first()) == (1, 1, 100.0)


def test_unguarded_percentage_fails_on_empty_cohort(spark, customers):
    orders = spark.createDataFrame([o(1, 3, "delivered", dt(2020, 1, 1))], ORD)
    with pytest.raises(Exception, match="(?i)division by zero|DIVIDE_BY_ZERO"):
        cm.long_gap_nondelivered_share(orders, customers).collect()
    assert tuple(cm.long_gap_nondelivered_share_v2(orders, customers).first()) == (0, 0, 0.0)


def test_top_cities_payment_row_mean(spark, customers):
    orders = spark.createDataFrame([o(1, 1, "delivered", dt(2020, 1, 1)),
                                    o(2, 3, "delivered", dt(2020, 1, 1)),
                                    o(3, 4, "delivered", dt(2020, 1, 1))], ORD)
    pay = spark.createDataFrame([(1, Decimal("1.00")), (1, Decimal("2.00")), (2, Decimal("2.50"))],
                                "order_id long, payment_value decimal(12,2)")
    got = [tuple(r) for r in cm.top_cities_by_avg_payment(orders, pay, customers).collect()]
    assert got == [("Lviv", 1, Decimal("2.50"), 2.5), ("Kyiv", 2, Decimal("3.00"), 1.5),
                   ("Odesa", 0, None, None)]


def test_intent_variants_differ_as_predicted(spark, customers):
    orders = spark.createDataFrame([
        o(1, 1, "delivered", dt(2020, 1, 1)), o(2, 2, "delivered", dt(2020, 2, 1)),
        o(3, 1, "delivered", dt(2020, 3, 1)), o(4, 3, "delivered", dt(2020, 1, 1))], ORD)
    # person 10 has three delivered orders: 3 orders, but 1 person
    assert rows(cm.returning_customer_share(orders, customers))[0][1] == 3
    assert rows(cm.returning_customer_share(orders, customers, count="persons"))[0][1] == 1
    pay = spark.createDataFrame([(1, Decimal("1.00")), (1, Decimal("2.00")), (4, Decimal("2.50"))],
                                "order_id long, payment_value decimal(12,2)")
    by_row = dict((r[0], r[3]) for r in cm.top_cities_by_avg_payment(orders, pay, customers).collect())
    by_order = dict((r[0], r[3]) for r in
                    cm.top_cities_by_avg_payment(orders, pay, customers, per="order").collect())
    assert by_row["Kyiv"] == 1.5 and by_order["Kyiv"] == 3.0 and by_order["Lviv"] == 2.5
