"""Rental-customer analyses: metamorphic pair S19/S20, traps T8 and T9."""

from datetime import datetime as dt
from decimal import Decimal

from storelens.plans import loyalty as ly
from storelens.plans.registry import QUERIES

from conftest import SF_ORACLE, rows

RENT = "rental_id long, customer_id long, rental_date timestamp_ntz, return_date timestamp_ntz"
PAY = "customer_id long, amount decimal(18,2)"


def test_having_and_derived_table_forms_agree(spark):
    a = QUERIES["above_average_payers"](spark, SF_ORACLE)
    b = QUERIES["above_average_payers_having"](spark, SF_ORACLE)
    assert rows(a) == rows(b) and a.count() > 0


def test_unreturned_rentals_stay_in_denominator(spark):
    # mf_unreturned: customer 1 has one 4-day rental and one open rental
    rentals = spark.createDataFrame([(1, 1, dt(2020, 1, 1, 23), dt(2020, 1, 5, 1)),
                                     (2, 1, dt(2020, 1, 1), None)], RENT)
    assert ly.avg_rental_days(rentals).first()[0] == 2.0


def test_payers_without_rentals_keep_null_duration(spark):
    rentals = spark.createDataFrame([(1, 1, dt(2020, 1, 1), dt(2020, 1, 8))], RENT)
    pay = spark.createDataFrame([(1, Decimal("10.70")), (1, Decimal("5.00")),
                                 (2, Decimal("99.99"))], PAY)
    prof = rows(ly.customer_rental_profile(pay, rentals))
    assert prof == [(1, 7.0, 15), (2, None, 99)]
    loyal = ly.loyal_long_renters(pay, rentals, payment_threshold=10, duration_threshold=5)
    assert rows(loyal) == [(1, 7.0, 15)]
    low = ly.low_pay_long_renters(pay, rentals, payment_threshold=20, duration_threshold=5)
    assert rows(low) == [(1, 7.0, 15)]
    dist = rows(ly.duration_distribution(pay, rentals))
    assert dist == [(1, 7.0, 15.0), (1, None, 99.0)]


def test_summary_joins_after_aggregating(spark):
    rentals = spark.createDataFrame([(1, 1, dt(2020, 1, 1), None), (2, 1, dt(2020, 1, 1), None),
                                     (3, 2, dt(2020, 1, 1), None)], RENT)
    pay = spark.createDataFrame([(1, Decimal("1.00")), (1, Decimal("2.00")),
                                 (3, Decimal("5.00"))], PAY)
    r = ly.rentals_and_payments_summary(rentals, pay).first()
    assert tuple(r) == (2, 2.0, 2, Decimal("3.00"), Decimal("3.00"), Decimal("3.00"))


def test_floor_of_negative_payment_sums(spark):
    rentals = spark.createDataFrame([], RENT)
    pay = spark.createDataFrame([(1, Decimal("-10.25")), (2, Decimal("-3.00")), (3, Decimal("7.99"))],
                                PAY)
    got = rows(ly.customer_rental_profile(pay, rentals).select("customer_id", "payment_amount_sum"))
    assert got == [(1, -11), (2, -3), (3, 7)]
