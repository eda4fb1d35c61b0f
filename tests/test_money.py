"""Monthly values with gaps filled by the last earlier month."""

import datetime as dt

from pyspark.sql import functions as F

from dossier.operators.money import period_dimension, to_base_currency


def day(m, d=1):
    return dt.date(2024, m, d)


def test_a_month_without_a_row_has_the_last_earlier_one(spark):
    rates = spark.createDataFrame([("USD", day(1), 0.5), ("USD", day(4), 0.25), ("GBP", day(6), 0.0), ("CHF", day(9), 2.0)],
                                  "currency string, month date, rate double")
    dim = period_dimension(rates, "currency", "month", F.lit(day(6)))
    got = sorted((r.currency, r.month.month, r.rate) for r in dim.collect())
    assert got == [("CHF", 9, 2.0), ("GBP", 6, 0.0)] + [("USD", m, 0.5 if m < 4 else 0.25) for m in range(1, 7)]
    facts = spark.createDataFrame([(1, "USD", day(3), 10.0), (2, "USD", day(5), 10.0), (3, "EUR", day(1), 7.0), (4, "GBP", day(6), 1.0),
                                   (5, "GBP", day(2), 1.0), (6, "CHF", day(6), 1.0)], "id int, currency string, month date, amount double")
    out = {r.id: r.amount_base for r in to_base_currency(facts, dim, "amount", "currency", "EUR", keys=["month"]).collect()}
    assert {k: None if v is None else float(v) for k, v in out.items()} == {1: 20.0, 2: 40.0, 3: 7.0, 4: None, 5: None, 6: None}


def test_no_values(spark):
    none = spark.createDataFrame([], "currency string, month date, rate double")
    assert period_dimension(none, "currency", "month", F.lit(day(6))).isEmpty()
