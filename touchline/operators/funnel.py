"""Funnel analysis (FUN-1 … FUN-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import exact_ratio, int_avg, one_row


def path_length_by(last_touch: DataFrame, keys: list, purchases: DataFrame | None = None,
                   campaigns: DataFrame | None = None, name_of: str | None = None,
                   not_null: str | None = None) -> DataFrame:
    """FUN-1…5: integer mean path length (touch number of the last touch)
    per month [and key].  ``purchases`` adds the acquisition columns;
    ``campaigns`` adds the campaign name of ``name_of``."""
    f = last_touch
    if purchases is not None:
        p = purchases.select(F.col("purchase_id").alias("_pid"), "acquisition_channel", "acquisition_campaign")
        f = f.join(p, F.col("purchase_id") == F.col("_pid"), "left")
    if not_null:
        f = f.filter(F.col(not_null).isNotNull())
    extra = []
    if campaigns is not None and name_of:
        c = campaigns.select(F.col("campaign_id").alias("_cid"), "campaign_name")
        f = f.join(c, F.col(name_of) == F.col("_cid"), "left")
        extra = ["campaign_name"]
    return (f.groupBy(F.year("purchase_date").alias("year"), F.month("purchase_date").alias("month"),
                      *keys, *extra)
            .agg(int_avg("touchpoint_number").alias("avg_path_length")))


def drop_off(touchpoints: DataFrame, clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    """FUN-6/7: stage users, drop-off rates ``1 - next/prev`` and the integer
    mean path length of users who never bought (``left_anti``: purchases'
    users are never NULL, so it equals the reference's NOT IN)."""
    i = touchpoints.filter(F.col("interaction_type") == "Impression").agg(F.countDistinct("user_id").alias("users_i"))
    c = clicks.agg(F.countDistinct("user_id").alias("users_c"))
    p = purchases.agg(F.countDistinct("user_id").alias("users_p"))
    buyers = purchases.filter(F.col("user_id").isNotNull()).select(F.col("user_id").alias("_b")).distinct()
    lost = (touchpoints.join(buyers, F.col("user_id") == F.col("_b"), "left_anti")
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("path_length"))
            .agg(int_avg("path_length").alias("avg_path_length_at_drop_off")))
    x = one_row(i, c, p, lost)
    return x.select(exact_ratio(F.col("users_i") - F.col("users_c"), "users_i").alias("drop_off_impressions_to_clicks"),
                    exact_ratio(F.col("users_c") - F.col("users_p"), "users_c").alias("drop_off_clicks_to_conversions"),
                    "avg_path_length_at_drop_off")
