"""Rental-customer loyalty analyses (rental counts, payment sums, durations).

Per-customer facts (rental counts, payment sums, rental durations) are each
aggregated on ``customer_id`` first; their joins are then one row per
customer on both sides and need no further shuffle.  Thresholds computed
from the data are global aggregates used as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.dates import calendar_days_between
from storelens.functions.numeric import (exact_mean, from_cents, half_up_ratio, money_sum,
                                         wide_sum)
from storelens.operators.summaries import min_mean_max

MONEY = "decimal(38,2)"


def rentals_per_customer_summary(rentals: DataFrame) -> DataFrame:
    """Min / rounded mean / max number of rentals per customer."""
    per = rentals.groupBy("customer_id").agg(F.count(F.lit(1)).alias("rental_count"))
    return min_mean_max(per, "rental_count",
                        ("rentals_count_min", "rentals_count_avg", "rentals_count_max"), 0)


def _whole_cents(money: Column) -> Column:
    """Sums of money in cents, wide enough to be summed again."""
    return (money * 100).cast("decimal(38,0)")


def payment_sums(payments: DataFrame) -> DataFrame:
    """customer_id, payment_amount_sum (exact decimal)."""
    return payments.groupBy("customer_id").agg(
        from_cents(money_sum("amount")).alias("payment_amount_sum"))


def rentals_and_payments_summary(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Rental-count and payment-sum profiles over customers present in both."""
    r = rentals.groupBy("customer_id").agg(F.count("rental_id").alias("rental_count"))
    j = r.join(payment_sums(payments), "customer_id", "inner")
    pas = F.col("payment_amount_sum")
    return j.agg(
        F.min("rental_count").alias("rentals_count_min"),
        exact_mean(F.sum("rental_count"), F.count("rental_count"), 0).alias("rentals_count_avg"),
        F.max("rental_count").alias("rentals_count_max"),
        F.min(pas).alias("payment_amount_sum_min"),
        exact_mean(F.sum(_whole_cents(pas)), F.count(pas), 2, unit_scale=2, as_decimal=True)
        .alias("payment_amount_sum_avg"),
        F.max(pas).alias("rpayment_amount_sum_max"))


def mean_payment_sum(payments: DataFrame) -> DataFrame:
    """One row: the per-customer payment sum averaged and rounded to cents."""
    s = payment_sums(payments)
    return s.agg(exact_mean(F.sum(_whole_cents(F.col("payment_amount_sum"))),
                            F.count("payment_amount_sum"),
                            2, unit_scale=2, as_decimal=True).alias("avg_payment_sum_per_customer"))


def above_average_payers(payments: DataFrame) -> DataFrame:
    """Customers whose payment sum exceeds the rounded mean payment sum,
    largest first (ties by customer id)."""
    s = payment_sums(payments)
    return (s.where(F.col("payment_amount_sum") > mean_payment_sum(payments).scalar())
            .select("customer_id", "payment_amount_sum")
            .orderBy(F.col("payment_amount_sum").desc(), F.col("customer_id").asc_nulls_first()))


def above_average_payers_having(spark: SparkSession, payments: DataFrame) -> DataFrame:
    """The same answer written as GROUP BY ... HAVING alias > (scalar
    subquery) in Spark SQL; kept as an independent formulation."""
    # mean of the sums in cents, rounded half away from zero, back to money
    mean = ("CAST(CAST(CASE WHEN SUM(c) < 0 THEN -1 ELSE 1 END * "
            "(CAST(ABS(SUM(c)) * 2 + COUNT(c) AS DECIMAL(38,0)) div CAST(2 * COUNT(c) AS DECIMAL(38,0))) "
            "AS DECIMAL(38,2)) / 100 AS DECIMAL(38,2))")
    return spark.sql(f"""
        SELECT customer_id, CAST(SUM(amount) AS DECIMAL(38,2)) AS payment_amount_sum
        FROM {{payment}}
        GROUP BY customer_id
        HAVING payment_amount_sum > (
            SELECT {mean}
            FROM (SELECT customer_id, CAST(SUM(amount) * 100 AS DECIMAL(28,0)) AS c
                  FROM {{payment}} GROUP BY customer_id) AS p)
        ORDER BY payment_amount_sum DESC, customer_id""", payment=payments)


def avg_rental_days(rentals: DataFrame) -> DataFrame:
    """Rounded SUM(calendar days rented) / COUNT(rentals); unreturned rentals
    add nothing to the sum but stay in the count."""
    d = calendar_days_between("return_date", "rental_date")
    return rentals.agg(half_up_ratio(F.sum(d), F.count("rental_id"), 0)
                       .alias("avg_avg_rental_duration"))


def _customer_facts(payments: DataFrame, rentals: DataFrame) -> DataFrame:
    """Per customer of either table: paid (cents), days rented and number of rentals."""
    d = calendar_days_between("return_date", "rental_date")
    pay = payments.groupBy("customer_id").agg(money_sum("amount").alias("paid"))
    dur = rentals.groupBy("customer_id").agg(F.sum(d).alias("days"), F.count("rental_id").alias("n"))
    # one table's NULL customer never meets the other's, as in a join of the two
    pay = pay.select("customer_id", "paid", F.lit(True).alias("pays"))
    return pay.join(dur, "customer_id", "full")


def _floor_money(c: Column) -> Column:
    """FLOOR of a sum in cents, by exact integer division."""
    return F.call_function("div", c - F.pmod(c, F.lit(100).cast("decimal(38,0)")), F.lit(100).cast("decimal(38,0)"))


def customer_rental_profile(payments: DataFrame, rentals: DataFrame) -> DataFrame:
    """Per paying customer: FLOOR(payment sum) and their rounded mean rental
    duration (NULL for customers without rentals)."""
    return _customer_facts(payments, rentals).where("pays").select(
        "customer_id", half_up_ratio("days", "n", 0).alias("avg_rental_duration"),
        _floor_money(F.col("paid")).alias("payment_amount_sum"))


def long_renters(payments: DataFrame, rentals: DataFrame, payment_side: str = "above",
                 payment_threshold: float | None = None,
                 duration_threshold: float | None = None) -> DataFrame:
    """Customers with payment sum above (or below) a threshold and mean
    rental duration above another, largest payers first.

    Thresholds default to the data's own means (rounded mean payment sum; rounded
    overall mean duration); pass numbers to pin them.  Both means follow from the
    per-customer facts, so one aggregate of each table gives rows and thresholds.
    """
    facts = _customer_facts(payments, rentals)
    means = facts.agg(
        exact_mean(F.sum("paid"), F.count("paid"), 2, unit_scale=2, as_decimal=True).alias("pt"),
        half_up_ratio(F.sum("days"), F.sum("n"), 0).alias("dt"))
    pt = means.select("pt").scalar() if payment_threshold is None else F.lit(payment_threshold).cast(MONEY)
    dt = means.select("dt").scalar() if duration_threshold is None else F.lit(float(duration_threshold))
    prof = facts.where("pays").select(
        "customer_id", half_up_ratio("days", "n", 0).alias("avg_rental_duration"),
        _floor_money(F.col("paid")).alias("payment_amount_sum"))
    pay = F.col("payment_amount_sum")
    pay_ok = pay > pt if payment_side == "above" else pay < pt
    return (prof.where(pay_ok & (F.col("avg_rental_duration") > dt))
            .select("customer_id", "avg_rental_duration", "payment_amount_sum")
            .orderBy(pay.desc(), F.col("customer_id").asc_nulls_first()))


def loyal_long_renters(payments: DataFrame, rentals: DataFrame, **kw) -> DataFrame:
    return long_renters(payments, rentals, "above", **kw)


def low_pay_long_renters(payments: DataFrame, rentals: DataFrame, **kw) -> DataFrame:
    return long_renters(payments, rentals, "below", **kw)


def duration_distribution(payments: DataFrame, rentals: DataFrame) -> DataFrame:
    """Customers and rounded mean FLOOR(payment sum) per rounded mean rental
    duration (NULL duration first)."""
    prof = customer_rental_profile(payments, rentals)
    return (prof.groupBy("avg_rental_duration").agg(
        F.count("customer_id").alias("customer_count"),
        exact_mean(wide_sum("payment_amount_sum"), F.count("payment_amount_sum"), 0)
        .alias("avg_payment_sum_per_customer"))
        .orderBy(F.col("avg_rental_duration").asc_nulls_first())
        .select("customer_count", "avg_rental_duration", "avg_payment_sum_per_customer"))
