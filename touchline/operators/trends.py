"""Ranking, change over time and cumulative analysis (RNK-1…8, COT-1…6,
CUM-1/2).

Rankings run after aggregation (rows = entities), trends over monthly
aggregates; the running windows are global but their input is one row per
month, which is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import RATIO_SCALE


def top_n(df: DataFrame, keys: list[str], value: Column, alias: str, n: int, descending: bool = True) -> DataFrame:
    """RNK-1/3/4/5/6/7/8: ``TOP n … ORDER BY agg`` (TakeOrderedAndProject);
    ties broken by the keys so the result set is deterministic."""
    agg = df.groupBy(*keys).agg(value.alias(alias))
    o = F.col(alias).desc() if descending else F.col(alias).asc()
    return agg.orderBy(o, *[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def rank_top(df: DataFrame, keys: list[str], value: Column, alias: str, n: int) -> DataFrame:
    """RNK-2: ``RANK() OVER (ORDER BY agg DESC) <= n`` — ties kept.  The
    window is global but runs over one row per entity after aggregation."""
    agg = df.groupBy(*keys).agg(value.alias(alias))
    return (agg.withColumn("rank", F.rank().over(Window.orderBy(F.col(alias).desc())))
            .filter(F.col("rank") <= n))


def monthly_purchases(purchases: DataFrame, dim_date: DataFrame, label: str = "calendar",
                      weekend: int | None = None) -> DataFrame:
    """COT-1…5: revenue, distinct purchases and customers per month.

    label: ``calendar`` (year, month, month_name via the date dimension),
    ``trunc`` (first day of the month), ``format`` (``yyyy-MMM`` text + month).
    ``weekend``: 0/1 keeps weekdays / weekend days only."""
    aggs = [F.sum("revenue").alias("total_revenue"), F.countDistinct("purchase_id").alias("total_purchases"),
            F.countDistinct("user_id").alias("total_customers")]
    if label == "trunc":
        return purchases.groupBy(F.trunc("purchase_date", "MM").alias("performance_month")).agg(*aggs)
    d = F.broadcast(dim_date.select(F.col("date_key").alias("_dk"), "year", "month", "month_name", "is_weekend"))
    f = purchases.join(d, F.col("date_key") == F.col("_dk"), "left")
    if weekend is not None:
        f = f.filter(F.col("is_weekend") == weekend)
    if label == "format":
        return f.groupBy(F.date_format("purchase_date", "yyyy-MMM").alias("performance_month"), "month").agg(*aggs)
    return f.groupBy("year", "month", "month_name").agg(*aggs)


def monthly_spend(spend: DataFrame, dim_date: DataFrame) -> DataFrame:
    """COT-6."""
    d = F.broadcast(dim_date.select(F.col("date_key").alias("_dk"), "year", "month", "month_name"))
    return (spend.join(d, F.col("date_key") == F.col("_dk"), "left")
            .groupBy("year", "month", "month_name").agg(F.sum("spend").alias("total_ad_spend")))


def cumulative(fact: DataFrame, dim_date: DataFrame, value: str, total_alias: str, avg_alias: str,
               running_alias: str, moving_alias: str) -> DataFrame:
    """CUM-1/2: monthly total and mean, running total and the cumulative mean
    of the monthly means (the reference's "moving average")."""
    d = F.broadcast(dim_date.select(F.col("date_key").alias("_dk"), "year", "month", "month_name"))
    m = (fact.join(d, F.col("date_key") == F.col("_dk"), "left")
         .groupBy("year", "month", "month_name")
         .agg(F.sum(value).alias(total_alias), F.round(F.avg(value), RATIO_SCALE).alias(avg_alias)))
    w = Window.orderBy("year", "month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ym = F.concat_ws("", F.col("year").cast("string"), F.lit(" - "), F.col("month_name"))
    return m.select(ym.alias("year_month"), total_alias,
                    F.sum(total_alias).over(w).alias(running_alias),
                    F.round(F.sum(avg_alias).over(w) / F.count(avg_alias).over(w), RATIO_SCALE).alias(moving_alias))
