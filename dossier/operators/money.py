"""Money: currency conversion, limit breaches, transaction roll-ups, in/out counts (M-01..M-04)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def period_dimension(values: DataFrame, code: str, month: str, last: Column) -> DataFrame:
    """Values by (code, month) with the gaps filled: a month without a row has the last earlier one.

    ``values`` has one row per code and month (first of the month); ``last`` is the last month
    needed.  The result has at most codes x months rows, whatever the facts, so facts meet it by a
    plain equi join on (code, month).  Months before a code's first row have none.
    """
    until = F.coalesce(F.lead(month).over(Window.partitionBy(code).orderBy(month)), F.add_months(last, 1))
    held = values.withColumn("__until", F.greatest(F.add_months(F.col(month), 1), until))
    months = F.sequence(F.col(month), F.add_months("__until", -1), F.expr("INTERVAL 1 MONTH"))
    return held.select(*[c for c in values.columns if c != month], F.explode(months).alias(month))


def to_base_currency(df: DataFrame, rates: DataFrame, amount: str, currency: str, base: str,
                     keys: Sequence[str] = (), rate_col: str = "rate", out: str = "amount_base",
                     scale: int | None = 2) -> DataFrame:
    """M-01: base currency passes through; else amount / rate (NULL when the rate is 0 or missing).

    ``rates`` holds ``currency`` (+ ``keys`` such as the month) and the rate.
    The rate table is small per period; the planner/AQE decides the join
    strategy from its measured size.
    """
    r = rates.select(F.col("currency").alias("__cur"), *[F.col(k).alias(f"__r_{k}") for k in keys],
                     F.col(rate_col).alias("__rate"))
    cond = F.col(currency) == F.col("__cur")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__r_{k}"))
    j = df.join(r, cond, "left")
    conv = F.try_divide(F.col(amount), F.nullif(F.col("__rate"), F.lit(0)))
    val = F.when(F.col(currency) == base, F.col(amount)).otherwise(conv)
    if scale is not None:
        val = val.cast(f"decimal(20,{scale})")
    return j.withColumn(out, val).drop("__cur", "__rate", *[f"__r_{k}" for k in keys])


def limit_breach(effective: Column, unavailable: Column, utilisation: Column, intraday: Column,
                 available: Column) -> dict[str, Column]:
    """M-02: three breach flags and the new available amount, all in DECIMAL(20,2).

    The room is the effective limit less its unavailable part.  With room, the effective limit is
    breached when utilisation exceeds it; without room, the intraday limit is breached when
    utilisation exceeds that.  The available amount is breached below 0.  Where the effective
    limit itself is 0 the intraday limit is added to the available amount.
    """
    effective, unavailable, utilisation, intraday, available = (
        c.cast("decimal(20,2)") for c in (effective, unavailable, utilisation, intraday, available))
    room = effective - unavailable
    return {
        "effective_breach": (room != 0) & (room - utilisation < 0),
        "intraday_breach": (room == 0) & (intraday - utilisation < 0),
        "available_breach": available < 0,
        "new_available": F.when(effective == 0, available + intraday).when(effective != 0, available)
        .cast("decimal(20,2)"),
    }


def counterparty_country(iban: Column, bic: Column, field: Column) -> Column:
    """M-03 fallback: IBAN country prefix, else the BIC country (chars 5-6), else the free field."""
    from_iban = F.when(iban.rlike("^[A-Z]{2}[0-9]{2}"), F.substring(iban, 1, 2))
    from_bic = F.when(F.length(bic) >= 6, F.substring(bic, 5, 2))
    return F.coalesce(from_iban, from_bic, field)


def in_out_counts(expected: DataFrame, inbound: DataFrame, outbound: DataFrame, key: str) -> DataFrame:
    """M-04: inbound and outbound counts per branch, zero-filled, with the total.

    Both sides are stacked and counted in one conditional aggregate, then
    joined to the branch dimension.
    """
    u = inbound.select(F.col(key), F.lit(1).alias("__in")).unionByName(
        outbound.select(F.col(key), F.lit(0).alias("__in")))
    c = u.groupBy(key).agg(F.sum("__in").alias("n_in"), F.sum(1 - F.col("__in")).alias("n_out"))
    j = expected.join(c, key, "left")
    n_in = F.coalesce("n_in", F.lit(0)).cast("bigint")
    n_out = F.coalesce("n_out", F.lit(0)).cast("bigint")
    return j.select(*expected.columns, n_in.alias("n_in"), n_out.alias("n_out"), (n_in + n_out).alias("n_total"))
