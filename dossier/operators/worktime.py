"""Working time and timeliness (T-01..T-11).

Working days are Monday to Friday.  The enumerated definition (T-01) is
the specification; the closed form (T-04) must equal its size, and is
what the aggregates use, so no per-day explosion is needed at scale.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.operators.ordered import CHUNK, add_chunks, ordered_scan
from dossier.operators.pick import with_key_aggregates


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def workdays(start, end) -> Column:
    """T-01: array of Mon-Fri dates in [start, end]; empty when either is NULL or end < start."""
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    seq = F.sequence(s, e, F.expr("INTERVAL 1 DAY"))
    days = F.filter(seq, lambda d: F.weekday(d) < 5)
    return F.when(s.isNull() | e.isNull() | (e < s), F.array().cast("array<date>")).otherwise(days)


def workday_count(start, end) -> Column:
    """T-04: number of Mon-Fri dates in [start, end] without enumerating them (0 if empty)."""
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    n = F.datediff(e, s) + 1
    weeks = F.floor(n / 7).cast("int")
    rem = (n - weeks * 7).cast("int")
    w = F.weekday(s)  # 0 = Monday
    last = w + rem - 1
    first_week = F.greatest(F.lit(0), F.least(last, F.lit(4)) - w + 1)
    wrap = F.greatest(F.lit(0), F.least(last, F.lit(11)) - F.greatest(w, F.lit(7)) + 1)
    out = weeks * 5 + first_week + wrap
    return F.when(s.isNull() | e.isNull() | (e < s), F.lit(0)).otherwise(out)


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, tasks: int | None = None,
                    near: Sequence[str] | None = None) -> DataFrame:
    """Union of [start, end] day intervals per key (overlapping or touching intervals merge).

    Two ordered scans (running max of earlier ends, running count of
    island starts), so a key with a large share of the rows is split over tasks.
    With ``tasks`` the rows are dealt into that many tasks, so that a task's memory does not grow with
    the input, and the result is partitioned by ``near`` (some of the keys, all by default).
    """
    order, near = [start, end], list(near or keys)
    x = add_chunks(df, keys, order)
    if tasks:
        x = x.repartition(tasks, *near, CHUNK)  # both scans and the first aggregate use this partitioning
    x = ordered_scan(x, keys, order, {"__pe": ("max_before", end)}, chunk_col=CHUNK)
    new = F.when(F.col("__pe").isNull() | (F.datediff(F.col(start), F.col("__pe")) > 1), 1).otherwise(0)
    # identical intervals tie; the pass-1 flag orders them so both passes agree
    isl = ordered_scan(x.withColumn("__new", new), keys, [*order, ("__new", False)],
                       {"__isl": ("sum", "__new")}, chunk_col=CHUNK)
    if tasks:
        isl = (isl.groupBy(*keys, CHUNK, "__isl").agg(F.min(start).alias(start), F.max(end).alias(end))
               .repartition(tasks, *near))
    return isl.groupBy(*keys, "__isl").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__isl")


def days_in_status(items: DataFrame, keys: Sequence[str], status: str, start: str, end: str,
                   statuses: Sequence[str], prefix: str = "days_", tasks: int | None = None) -> DataFrame:
    """T-02: distinct working days per key and status, one column per status.

    Overlapping items count a day once: intervals are merged per
    (key, status) first, then each merged interval is counted with the
    closed form — no row per day is ever produced.  ``tasks``: as in ``merge_intervals``.
    """
    it = items.select(*keys, status, F.to_date(start).alias("__s"), F.to_date(end).alias("__e")) \
        .where(F.col("__s").isNotNull() & F.col("__e").isNotNull() & (F.col("__e") >= F.col("__s")))
    merged = merge_intervals(it, [*keys, status], "__s", "__e", tasks, keys)
    counted = merged.withColumn("__n", workday_count("__s", "__e"))
    wide = counted.groupBy(*keys).pivot(status, list(statuses)).agg(F.sum("__n"))
    return wide.select(*keys, *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(f"{prefix}{s}")
                                for s in statuses])


def days_in_rebound(events: DataFrame, keys: Sequence[str], status: str, ts: str, order: Sequence[str],
                    in_status: str, after_status: str, tasks: int | None = None) -> DataFrame:
    """T-03: working days spent in ``in_status`` on or after the first ``after_status``.

    Each event's status lasts from its day to the day of the key's next
    event.  Intervals are clipped at the first ``after_status`` day (a
    per-key ``min(when)`` window), merged and counted in closed form.
    """
    e = events.select(*keys, status, *[c for c in order if c not in (*keys, status)])
    e = ordered_scan(e, keys, list(order), {"__next_ts": ("lead", ts)})
    e = with_key_aggregates(e, keys, [F.min(F.when(F.col(status) == after_status, F.to_date(ts))).alias("__first")])
    e = (e.withColumn("__s", F.to_date(ts))
         .withColumn("__e", F.coalesce(F.to_date("__next_ts"), F.to_date(ts))))
    x = (e.where((F.col(status) == in_status) & F.col("__first").isNotNull())
         .withColumn("__s", F.greatest("__s", "__first"))
         .where(F.col("__e") >= F.col("__s")))
    merged = merge_intervals(x.select(*keys, "__s", "__e"), keys, "__s", "__e", tasks)
    days = merged.groupBy(*keys).agg(F.sum(workday_count("__s", "__e")).cast("bigint").alias("rebound_days"))
    all_keys = events.select(*keys).distinct()
    return all_keys.join(days, list(keys), "left").select(
        *keys, F.coalesce("rebound_days", F.lit(0)).cast("bigint").alias("rebound_days"))


def shift_to_monday(d, days_back: int = 90) -> Column:
    """T-05: date minus ``days_back`` days, moved back to the Monday of that week."""
    x = F.date_sub(F.to_date(_c(d)), days_back)
    return F.date_sub(x, F.weekday(x))


def valid_planned_date(planned, review, max_days: int = 300, default_offset: int = 69) -> Column:
    """T-06: keep the planned date if it is before the review date and less than
    ``max_days`` before it; otherwise review date minus ``default_offset`` days."""
    p, r = F.to_date(_c(planned)), F.to_date(_c(review))
    ok = p.isNotNull() & (F.datediff(r, p) < max_days) & (p < r)
    return F.when(ok, p).otherwise(F.date_sub(r, default_offset))


def utc_to_local(ts, zone: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> tuple[Column, Column]:
    """T-11: UTC wall-clock (timestamp_ntz) to local text and local date; session-zone independent."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts))
    return F.date_format(local, fmt), F.to_date(local)


def nearest_snapshot_value(df: DataFrame, keys: Sequence[str], date_col: str, load_date: dt.date,
                           value: str, tie: str) -> DataFrame:
    """T-09: per key the value at the greatest signed day difference to the load date."""
    diff = F.datediff(F.lit(load_date.isoformat()).cast("date"), F.to_date(date_col))
    return df.groupBy(*keys).agg(
        F.max_by(F.col(value), F.struct(diff, -F.col(tie))).alias(value), F.max(diff).alias("days_diff"))


def completed_on_time(cases: DataFrame, client: str, case_id: str, review_type: str, signoff: str,
                      next_review: str, duration: str, as_of: dt.date) -> DataFrame:
    """T-07: per case its next sign-off and 1 / 0 / NULL for completed on time.

    1. A client with a case whose next-review date equals that of its previous case is out of
       scope as a whole, unless the repeating case is an offboarding.  Previous cases count
       follow-up reviews ('QC EDR') too.
    2. Follow-up reviews are then left out; the next case is the next of those that remain.
    3. An event-driven review is on time if its own duration is at most 90 days.
    4. Otherwise the next case must be signed off by the next-review date; without a next case it
       is 0 when that date is before ``as_of``, else NULL.

    Equal sign-off dates are ordered by ``case_id``.
    """
    base = cases.select(client, case_id, F.col(review_type).alias("__type"), F.to_date(signoff).alias("signoff"),
                        F.to_date(next_review).alias("nrd"), F.col(duration).alias("__days"))
    order = ["signoff", case_id]
    former = ordered_scan(base, [client], order, {"__former": ("lag", "nrd")})
    out = former.where((F.col("nrd") == F.col("__former")) & (F.col("__type") != "Offboarding")).select(client).distinct()
    scope = base.join(out, client, "left_anti").where(F.col("__type") != "QC EDR")
    s = ordered_scan(scope, [client], order, {"next_signoff": ("lead", "signoff")})
    event = F.col("__type") == "Event Driven Review"
    on_time = (F.when(event & (F.col("__days") <= 90), 1).when(event & (F.col("__days") > 90), 0)
               .when(F.col("next_signoff") <= F.col("nrd"), 1).when(F.col("next_signoff") > F.col("nrd"), 0)
               .when(F.col("next_signoff").isNull() & (F.col("nrd") < F.lit(as_of.isoformat()).cast("date")), 0))
    return s.select(client, case_id, "signoff", "next_signoff", "nrd", on_time.cast("int").alias("completed_on_time"))


def stage_milestones(df: DataFrame, keys: Sequence[str], status: str, ts: str, id_col: str,
                     stage: str, next_stage: str) -> DataFrame:
    """T-10: first and last time in ``stage`` before the first ``next_stage``, and the id
    (e.g. assignee) of that last row.  Two aggregates joined on the key, no window."""
    first_next = df.groupBy(*keys).agg(
        F.min(F.when(F.col(status) == next_stage, F.col(ts))).alias(f"first_{next_stage}"))
    j = df.join(first_next, list(keys))
    before = (F.col(status) == stage) & (F.col(f"first_{next_stage}").isNull()
                                         | (F.col(ts) < F.col(f"first_{next_stage}")))
    return j.groupBy(*keys).agg(
        F.min(F.col(f"first_{next_stage}")).alias(f"first_{next_stage}"),
        F.min(F.when(before, F.col(ts))).alias(f"first_{stage}"),
        F.max(F.when(before, F.col(ts))).alias(f"last_{stage}"),
        F.max_by(F.col(id_col), F.when(before, F.struct(F.col(ts), F.col(id_col)))).alias(f"last_{stage}_{id_col}"))


def plan_vs_actual(history: DataFrame, key: str, date_col: str, plan_date: dt.date, actual_date: dt.date,
                   status: str, done_status: str) -> DataFrame:
    """T-08: compare the plan snapshot with a later one: On time / Not on time / Offboarding.

    One self join of the dated history on the key, each side pruned to one
    snapshot date (a partition filter when the history is partitioned).
    """
    p = history.where(F.col(date_col) == F.lit(plan_date.isoformat()).cast("date")).select(key)
    a = history.where(F.col(date_col) == F.lit(actual_date.isoformat()).cast("date")) \
        .select(F.col(key).alias("__k"), F.col(status).alias("__st"))
    j = p.join(a, F.col(key) == F.col("__k"), "left")
    outcome = (F.when(F.col("__k").isNull(), "Offboarding").when(F.col("__st") == done_status, "On time")
               .otherwise("Not on time"))
    return j.select(key, outcome.alias("outcome"))
