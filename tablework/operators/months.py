"""Monthly activity of records that have a start and an optional end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "yyyy-MM"


def month_of(c: str | Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(F.col(c).cast("date") if isinstance(c, str) else c.cast("date"), "month")


def month_spine(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month from ``first`` to ``last``, both inclusive, as ``yyyy-MM``."""
    spark = df.sparkSession
    months = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("m")).select(F.date_format("m", MONTH).alias("month"))


def monthly_activity(
    postings: DataFrame, first: str, last: str, *, start: str = "post_date", end: str = "remove_date",
    amount: str = "salary", as_of: str | None = None,
) -> DataFrame:
    """Counts, averages and sums of new, active and removed records for each month.

    A record is new in its start month, removed in its end month and active in both and all months between; a
    record without an end is active up to the ``as_of`` month (default: ``last``). The records are first counted
    per (start month, end month); only those few pairs are spread over months.
    """
    pairs = (
        postings.groupBy(month_of(start).alias("s"), month_of(end).alias("e"))
        .agg(F.count("*").alias("n"), F.count(amount).alias("n_amount"), F.sum(amount).alias("total"))
    )
    until = F.coalesce("e", month_of(F.lit(as_of or last)))
    active = F.when(F.col("s") <= until, F.sequence("s", until, F.expr("interval 1 month")))
    kinds = F.array(
        F.struct(F.lit("new").alias("kind"), F.array("s").alias("months")),
        F.struct(F.lit("removed").alias("kind"), F.array("e").alias("months")),
        F.struct(F.lit("active").alias("kind"), active.alias("months")),
    )
    spread = (
        pairs.select("n", "n_amount", "total", F.inline(kinds))
        .select("kind", F.explode("months").alias("m"), "n", "n_amount", "total")
        .filter("m is not null")
    )
    picked = []
    for kind in ("new", "active", "removed"):
        is_kind = F.col("kind") == kind
        n = F.coalesce(F.sum(F.when(is_kind, F.col("n"))), F.lit(0))
        n_amount = F.sum(F.when(is_kind, F.col("n_amount")))
        total = F.coalesce(F.sum(F.when(is_kind, F.col("total"))).cast("double"), F.lit(0.0))
        picked += [
            n.cast("long").alias(f"count_{kind}"),
            F.coalesce(F.try_divide(total, n_amount.cast("double")), F.lit(0.0)).alias(f"salary_{kind}"),
            total.alias(f"salary_sum_{kind}"),
        ]
    counted = spread.groupBy(F.date_format("m", MONTH).alias("month")).agg(*picked)
    zeros = {c: 0 for c in counted.columns if c != "month"}
    return month_spine(postings, first, last).join(counted, "month", "left").fillna(zeros)


def expected_deliveries(df: DataFrame, first: str, until: str, days: int = 7) -> DataFrame:
    """Delivery names ``yyyyMMdd`` from ``first`` every ``days`` days, ``until`` excluded."""
    week = F.sequence(
        F.lit(first).cast("date"), F.date_sub(F.lit(until).cast("date"), 1), F.expr(f"interval {days} days")
    )
    return (
        df.sparkSession.range(1)
        .select(F.explode(week).alias("d"))
        .select(F.date_format("d", "yyyyMMdd").alias("delivery"))
    )


def missing_deliveries(present: DataFrame, first: str, until: str, days: int = 7) -> DataFrame:
    """Expected deliveries that are not in ``present`` (column ``delivery``)."""
    return expected_deliveries(present, first, until, days).join(present.distinct(), "delivery", "left_anti")
