"""LTV and cohorts (LTV-1 … LTV-6).

Cohort rows come from an equi join on the user with the residual
``acquisition_month <= purchase_month`` followed by a partial aggregate per
(cohort, purchase month[, key]); the spend side is restricted with
``left_semi`` joins (the reference's ``IN`` subqueries) — no NOT IN, no
cross product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import exact_ratio, month_diff, scalar


def ltv_overall(purchases: DataFrame, dim_user: DataFrame) -> DataFrame:
    """LTV-1: Σ revenue / number of users."""
    rev = purchases.agg(F.sum("revenue").alias("_rev"))
    users = scalar(dim_user, F.count(F.lit(1)))
    return rev.select(exact_ratio("_rev", users).alias("ltv"))


def ltv_cac_overall(purchases: DataFrame, dim_user: DataFrame, spend: DataFrame,
                    acquisitions: DataFrame) -> DataFrame:
    """LTV-2: (Σ revenue / users) / (Σ spend / first-touch users)."""
    one = ltv_overall(purchases, dim_user)
    cac = exact_ratio(scalar(spend, F.sum("spend")), scalar(acquisitions, F.countDistinct("user_id")))
    x = one.withColumn("cac", cac)
    return x.select("ltv", "cac", exact_ratio("ltv", "cac", 6).alias("ltv_cac_ratio"))


def cohort_ltv(purchases: DataFrame, acquisitions: DataFrame, spend: DataFrame,
               key: str | None = None, campaigns: DataFrame | None = None) -> DataFrame:
    """LTV-3/4/5: cohort by acquisition month [and channel | campaign].

    key: None, ``"channel"`` or ``"campaign"``.  users_in_cohort counts users
    with a purchase in that purchase month; CAC divides acquisition spend by
    all users acquired in the month (both as in the reference)."""
    akey = {"channel": "acquisition_channel", "campaign": "acquisition_campaign"}.get(key)
    skey = {"channel": "channel", "campaign": "campaign_id"}.get(key)
    acq = acquisitions.select(F.trunc("acquisition_date", "MM").alias("acquisition_month"),
                              F.col("user_id").alias("_a_user"), *([akey] if akey else []))
    rev = purchases.select(F.trunc("purchase_date", "MM").alias("purchase_month"),
                           F.col("user_id").alias("_r_user"), "revenue")
    j = acq.join(rev, (F.col("_a_user") == F.col("_r_user"))
                 & (F.col("acquisition_month") <= F.col("purchase_month")), "left")
    gk = ["acquisition_month", "purchase_month"] + ([akey] if akey else [])
    ltv = (j.groupBy(*gk).agg(F.sum("revenue").alias("total_revenue"),
                              F.countDistinct("_a_user").alias("users_in_cohort"))
           .filter(F.col("purchase_month").isNotNull())
           .withColumn("month_number", month_diff("acquisition_month", "purchase_month"))
           .withColumn("ltv", exact_ratio("total_revenue", "users_in_cohort")))
    counts = (acquisitions.groupBy(F.trunc("acquisition_date", "MM").alias("_c_month"),
                                   *([F.col(akey).alias("_c_key")] if akey else []))
              .agg(F.countDistinct("user_id").alias("_user_count")))
    acq_campaigns = (acquisitions.filter(F.col("acquisition_campaign").isNotNull())
                     .select(F.col("acquisition_campaign").alias("_camp")).distinct())
    s = spend.join(acq_campaigns, F.col("campaign_id") == F.col("_camp"), "left_semi")
    if key == "channel":
        acq_channels = (acquisitions.filter(F.col("acquisition_channel").isNotNull())
                        .select(F.col("acquisition_channel").alias("_chan")).distinct())
        s = s.join(acq_channels, F.col("channel") == F.col("_chan"), "left_semi")
    s = (s.groupBy(F.trunc("spend_date", "MM").alias("_s_month"), *([F.col(skey).alias("_s_key")] if skey else []))
         .agg(F.sum("spend").alias("_spend")))
    cond = F.col("_c_month") == F.col("_s_month")
    if key:
        cond = cond & (F.col("_c_key") == F.col("_s_key"))
    cac = (counts.join(s, cond, "left")
           .select("_c_month", *(["_c_key"] if key else []), exact_ratio("_spend", "_user_count").alias("cac")))
    cond2 = F.col("acquisition_month") == F.col("_c_month")
    if key:
        cond2 = cond2 & (F.col(akey) == F.col("_c_key"))
    out = ltv.join(cac, cond2, "left")
    out = out.withColumn("ltv_cac_ratio", exact_ratio("ltv", "cac", 6)).withColumn(
        "roi", exact_ratio(F.col("ltv") - F.col("cac"), "cac", 6))
    cols = ["acquisition_month", "purchase_month", "month_number"] + ([akey] if akey else [])
    if key == "campaign" and campaigns is not None:
        c = campaigns.select(F.col("campaign_id").alias("_cid"), "campaign_name")
        out = out.join(c, F.col(akey) == F.col("_cid"), "left")
        cols.append("campaign_name")
    return out.select(*cols, "total_revenue", "users_in_cohort", "ltv", "cac", "ltv_cac_ratio", "roi")
